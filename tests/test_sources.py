import fcntl
import os
import tempfile
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from conftest import plan
from docflow.config import ConvertConfig
from docflow.operators import file_rules, has_suffix, validate
from docflow.plans.convert import convert_directory, convert_listing, convert_one, convert_valid
from docflow.schemas import DATED_LISTING_SCHEMA, LISTING_SCHEMA
from docflow.sources import filesystem
from docflow.sources import (
    InputNotFound,
    NoDocuments,
    balance,
    checked_documents,
    documents_from_paths,
    documents_from_table,
    list_documents,
    read_content,
    read_documents,
    with_content,
)
from docflow.sources.datasource import opened_rows
from docflow.sources.dealing import FILE_BYTES, deal_by_size, largest_first, room_below_level
from docflow.sources.listing import compiled, folder_rows
from faulty_converters import opens_path, well_behaved
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

PDFS = {"a.pdf", "b c%20é.pdf", ".hid.pdf", "_u.pdf", "empty.pdf", "dir.pdf"}


def names(df):
    return {row.file_name for row in df.collect()}


def test_listing_loses_nothing(spark, folder):
    rows = {r.file_name: r for r in list_documents(spark, folder).collect()}
    assert set(rows) == PDFS
    assert rows["empty.pdf"].file_size == 0
    assert not rows["dir.pdf"].is_file and rows["a.pdf"].is_file
    assert rows["a.pdf"].document_path == f"file:{folder}/a.pdf"


def test_listing_pattern_and_uri(spark, folder):
    assert names(list_documents(spark, f"file://{folder}", "*.[pP][dD][fF]")) == PDFS | {"UP.PDF"}
    assert names(list_documents(spark, folder, "{n,a}.*")) == {"n.txt", "a.pdf"}
    assert "s.pdf" in names(list_documents(spark, folder, recursive=True))


def test_long_listing_stays_in_tasks(spark, tmp_path):
    for i in range(3000):
        (tmp_path / f"{i}.pdf").touch()
    long = list_documents(spark, str(tmp_path))
    assert long.count() == 3000 and "LocalTableScan" not in plan(long)
    assert long.schema.fieldNames() == LISTING_SCHEMA.fieldNames()


def test_recursive_listing_finds_all_levels(spark, tmp_path):
    deep = tmp_path / "x" / "y" / "z"
    deep.mkdir(parents=True)
    for place in (tmp_path, tmp_path / "x", deep):
        (place / "f.pdf").touch()
    rows = list_documents(spark, str(tmp_path), recursive=True).collect()
    assert len(rows) == 3 and len({r.document_path for r in rows}) == 3


def test_listing_of_a_tree_with_links_and_pipes(spark, tmp_path):
    """A deep tree below one folder, with what real folders have: dead links, circles, pipes."""
    root = tmp_path / "in"
    for i in range(12):
        for j in range(3):
            place = root / "year" / f"m{i}" / f"d{j}"
            place.mkdir(parents=True)
            (place / "f.pdf").write_text("x" * i)
    year = root / "year"
    os.symlink(root / "gone", year / "dead.pdf")
    os.symlink(year / "round.pdf", year / "round.pdf")
    os.symlink(root, year / "m0" / "up")
    os.symlink(year / "m1", year / "again")
    os.symlink(year / "m2" / "d0" / "f.pdf", year / "linked.pdf")
    os.mkfifo(year / "pipe.pdf")
    outside = tmp_path / "outside"
    (outside / "sub").mkdir(parents=True)
    (outside / "sub" / "o.pdf").touch()
    os.symlink(outside, year / "m3" / "out")
    os.symlink(outside / "sub", year / "m4" / "sub")
    found = list_documents(spark, str(root), recursive=True)
    rows = {r.document_path.removeprefix(f"file:{root}/"): r for r in found.collect()}
    assert found.count() == len(rows)
    plain = {f"year/m{i}/d{j}/f.pdf" for i in range(12) for j in range(3)}
    # The folder that two links lead to is listed at the level that reaches it first.
    assert set(rows) == plain | {f"year/{n}.pdf" for n in ("dead", "round", "linked", "pipe")} | {"year/m4/sub/o.pdf"}
    assert [rows[f"year/{n}.pdf"][2:5] for n in ("dead", "round", "pipe", "linked")] == [
        (None, False, False), (None, False, False), (0, False, True), (2, True, True)
    ]
    results = convert_directory(spark, str(root), lambda: lambda p, c: str(len(c)), recursive=True).collect()
    assert len(results) == len(rows) and sum(not r.success for r in results) == 3


def test_a_level_is_listed_by_many_tasks(spark, tmp_path):
    for i in range(40):
        (tmp_path / "one" / f"f{i}").mkdir(parents=True)
        (tmp_path / "one" / f"f{i}" / "x.pdf").touch()
    found = list_documents(spark, str(tmp_path), recursive=True)
    assert found.count() == 40
    folders = {os.path.dirname(f) for f in found.inputFiles()}
    parts = {f: [p for p in found.inputFiles() if os.path.dirname(p) == f] for f in folders}
    assert len(parts) == 3 and max(map(len, parts.values())) > 10


def test_a_listing_is_made_once(spark, tmp_path):
    (tmp_path / "a.pdf").touch()
    found = list_documents(spark, str(tmp_path))
    (tmp_path / "b.pdf").touch()
    assert names(found) == {"a.pdf"} and found.count() == 1
    assert names(list_documents(spark, str(tmp_path))) == {"a.pdf", "b.pdf"}


def test_a_folder_that_cannot_be_read_is_a_row(tmp_path):
    rows = list(folder_rows(f"file:{tmp_path}/secret", compiled("*.pdf").match, True))
    assert rows == [(f"file:{tmp_path}/secret", "secret", 0, False, True, None, True, False, False, None)]
    # Its parent has listed one whose name matches.
    assert list(folder_rows(f"file:{tmp_path}/secret.pdf", compiled("*.pdf").match, True)) == []


def test_missing_and_empty_folder(spark, folder, tmp_path):
    with pytest.raises(InputNotFound):
        list_documents(spark, str(tmp_path / "nope"))
    with pytest.raises(InputNotFound):
        list_documents(spark, folder + "/a.pdf")
    with pytest.raises(NoDocuments):
        list_documents(spark, folder, "*.docx")


def test_paths(spark, folder):
    paths = [f"{folder}/a.pdf", f"{folder}/gone.pdf", f"{folder}/dir.pdf"]
    rows = {r.document_path: r for r in documents_from_paths(spark, iter(paths)).collect()}
    assert set(rows) == set(paths)
    assert rows[paths[0]].exists and rows[paths[0]].file_size == len("bytes of a.pdf")
    assert not rows[paths[1]].exists and rows[paths[1]].file_name == "gone.pdf"
    assert rows[paths[2]].exists and not rows[paths[2]].is_file
    assert documents_from_paths(spark, []).count() == 0


def test_content_has_the_rows_of_the_listing(spark, folder):
    found = read_content(spark, folder)
    rows = {r.file_name: r for r in found.collect()}
    assert set(rows) == PDFS and found.count() == 6
    assert bytes(rows["b c%20é.pdf"].content) == "bytes of b c%20é.pdf".encode()
    assert {n for n, r in rows.items() if r.content is None} == {"dir.pdf"}


def test_bytes_are_not_shuffled(spark, folder):
    text = plan(read_content(spark, folder))
    exchanges = [part for part in text.split("\n\n") if "Exchange" in part.split("\n")[0]]
    assert exchanges and not any("content" in part for part in exchanges)


def test_too_large_a_file_reaches_the_plug_in_by_path(spark, folder):
    read = with_content(list_documents(spark, folder), longest=20)
    rows = {r.file_name: r for r in read.collect()}
    assert rows["b c%20é.pdf"].content is None and rows["a.pdf"].content
    converted = convert_valid(read, file_rules(), lambda: lambda path, data: "by path" if data is None else "bytes")
    found = {os.path.basename(r.document_path): r.content for r in converted.filter("success").collect()}
    assert found.pop("b c%20é.pdf") == "by path" and set(found.values()) == {"bytes"}


def test_directory_one_result_per_entry(spark, folder):
    rows = {
        os.path.basename(r.document_path): r
        for r in convert_directory(spark, folder, lambda: lambda p, c: c.decode()).collect()
    }
    assert set(rows) == PDFS
    assert {n for n, r in rows.items() if r.success} == PDFS - {"dir.pdf"}
    assert {r.error_message for r in rows.values() if not r.success} == {"Invalid file"}
    with pytest.raises(InputNotFound):
        convert_directory(spark, folder + "/none", well_behaved)


def test_pdfs_need_a_converter(spark, folder):
    with pytest.raises(ValueError, match="need a converter"):
        convert_directory(spark, folder)


def test_paths_of_files_keep_their_marks(spark):
    table = spark.createDataFrame([("s3a://b/C# intro.pdf",), ("https://h/x.pdf?a=1#b",)], "p string")
    checked = validate(documents_from_table(table, "p"), [has_suffix(".pdf")])
    assert [r.file_name for r in checked.collect()] == ["C# intro.pdf", "x.pdf"]
    assert checked.filter("is_valid").count() == 2


def test_table_of_paths_is_looked_up_in_tasks(spark, folder):
    table = spark.createDataFrame([(f"{folder}/a.pdf",), (f"{folder}/gone.pdf",), (f"{folder}/dir.pdf",), (None,)], "p string")
    checked = validate(checked_documents(table, "p"), file_rules())
    assert [r.failed_rule for r in checked.collect()] == [None, "exists", "is_file", "exists"]


def test_table_of_paths(spark, folder):
    table = spark.createDataFrame([(f"{folder}/a.pdf",), (f"{folder}/gone.pdf",)], "p string")
    df = convert_valid(documents_from_table(table, "p"), [has_suffix(".pdf")], opens_path)
    rows = {os.path.basename(r.document_path): r for r in df.collect()}
    assert rows["a.pdf"].content == "14"
    assert "No such file" in rows["gone.pdf"].error_message


def test_one_document_by_path(spark, folder):
    row = convert_one(spark, f"{folder}/a.pdf", opens_path).first()
    assert row.success and row.content == "14"
    row = convert_one(spark, f"{folder}/n.txt", opens_path).first()
    assert (row.success, row.error_message) == (False, "Invalid file")


def listed(spark, sizes):
    rows = [(f"f{i}", f"f{i}", s, True, True, None) for i, s in enumerate(sizes)]
    return spark.createDataFrame(rows, DATED_LISTING_SCHEMA).repartition(3)


@pytest.mark.parametrize("kind", ["equal", "few large", "one huge", "spread", "none"])
def test_dealing_by_size_is_even(spark, kind):
    draw = np.random.default_rng(1)
    sizes = {
        "equal": [1000] * 500,
        "few large": [10**8] * 5 + [10**6] * 400,
        "one huge": [10**9] + [10**6] * 300,
        "spread": (10 ** draw.uniform(3, 9, 300)).astype(int).tolist(),
        "none": [None, 0, None],
    }[kind]
    dealt = deal_by_size(listed(spark, sizes), 8)
    assert dealt.rdd.getNumPartitions() == 8 and dealt.columns == DATED_LISTING_SCHEMA.fieldNames()
    parts = [[r.file_size or 0 for r in part] for part in dealt.rdd.glom().collect()]
    assert sorted(s for p in parts for s in p) == sorted(s or 0 for s in sizes)
    loads = [sum(s + FILE_BYTES for s in p) for p in parts]
    share = sum(loads) / 8
    assert max(loads) <= max(1.25 * share + FILE_BYTES, max(s or 0 for s in sizes) + FILE_BYTES)


def test_largest_first_and_levels():
    assert largest_first([5, 9, 3, 3], 2) == ([1, 0, 1, 1], [9, 11])
    for loads, amount in (([0, 0, 0], 10), ([5, 1, 9], 4), ([5, 1, 9], 40), ([7], 3), ([3, 3], 0)):
        room = room_below_level(loads, amount)
        assert sum(room) == amount and min(room) >= 0
        filled = [a + b for a, b in zip(loads, room)]
        assert all(f <= min(filled) + len(loads) for f, r in zip(filled, room) if r)


def test_source_opens_what_passes(spark, folder, monkeypatch):
    found = read_documents(spark, folder)
    assert {r.file_name: r.content and bytes(r.content) for r in found.where("file_name LIKE '%.pdf'").collect()} == {
        n: None if n == "dir.pdf" else b"" if n == "empty.pdf" else f"bytes of {'sub/' if n == 's.pdf' else ''}{n}".encode() for n in PDFS | {"s.pdf"}
    }
    some = found.where("file_name LIKE '%.pdf' AND file_size > 0 AND file_size < 18 AND is_file AND file_name <> 'a.pdf' AND file_name IN ('a.pdf', 'n.txt', '_u.pdf')")
    assert names(some) == {"_u.pdf"}
    assert some.count() == 1 and "content" not in read_documents(spark, folder, content=False).columns
    with pytest.raises(Exception, match="read_documents"):
        spark.read.format("documents").load(folder).count()
    # The reader itself, in this process, to count what it opens.
    from docflow.sources import datasource as source

    paths = []
    monkeypatch.setattr(source, "read_file", lambda path: paths.append(os.path.basename(path)) or b"x")
    where = [ds.StringEndsWith(("file_name",), ".pdf"), ds.GreaterThan(("file_size",), 0), ds.EqualTo(("content",), b"x")]
    place = spark.conf.get("spark.checkpoint.dir")
    latest = max((os.path.join(place, n) for n in os.listdir(place) if n.startswith("documents-")), key=os.path.getmtime)
    reader = source.DocumentReader(source.DOCUMENT_SCHEMA, {"listing": latest})
    assert list(reader.pushFilters(where)) == where[2:]
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert sorted(paths) == sorted(r["file_name"] for r in rows) == sorted(PDFS - {"empty.pdf", "dir.pdf"} | {"s.pdf"})


def test_pushed_filters_against_sql(spark):
    """Each kind of filter over values and nulls, against Spark's own evaluation."""
    from docflow.sources.datasource import _LISTING, can_filter, passes

    rows = [("a/x.pdf", "x.pdf", 5, True, True, None), ("b", None, None, None, True, None), (None, "y.txt", 0, False, False, None)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _LISTING)], schema=_LISTING)
    spark.createDataFrame(rows, DATED_LISTING_SCHEMA).createOrReplaceTempView("named")
    kinds = {
        "file_name = 'x.pdf'": ds.EqualTo(("file_name",), "x.pdf"), "file_size <=> 5": ds.EqualNullSafe(("file_size",), 5),
        "file_size <=> NULL": ds.EqualNullSafe(("file_size",), None), "file_size > 0": ds.GreaterThan(("file_size",), 0),
        "file_size >= 0": ds.GreaterThanOrEqual(("file_size",), 0), "file_size < 5": ds.LessThan(("file_size",), 5),
        "file_size <= 5": ds.LessThanOrEqual(("file_size",), 5), "file_size IN (5, 7)": ds.In(("file_size",), (5, 7)),
        "file_size IN (5, NULL)": ds.In(("file_size",), (5, None)), "file_name IS NULL": ds.IsNull(("file_name",)),
        "file_name IS NOT NULL": ds.IsNotNull(("file_name",)), "startswith(file_name, 'x')": ds.StringStartsWith(("file_name",), "x"),
        "endswith(file_name, 'txt')": ds.StringEndsWith(("file_name",), "txt"), "contains(document_path, '/')": ds.StringContains(("document_path",), "/"),
        "is_file = true": ds.EqualTo(("is_file",), True),
    }
    for text, given in kinds.items():
        for sql, pushed in ((text, given), (f"NOT ({text})", ds.Not(given))):
            assert can_filter(pushed)
            kept = [r[0] for r in spark.sql(f"SELECT document_path FROM named WHERE {sql}").collect()]
            assert batch.filter(passes(pushed, batch)).column(0).to_pylist() == kept, sql


def test_balance(spark):
    few = spark.range(100, numPartitions=2)
    assert balance(few, 7).rdd.getNumPartitions() == 7
    hot = few.select(F.lit("same").alias("document_path"))
    sizes = balance(hot, 4).rdd.glom().map(len).collect()
    assert max(sizes) <= 30


def test_large_files_are_handed_over_without_being_held(tmp_path):
    # The bytes of each were held twice: as read, and as a column.
    sizes = {"a": 5, "large": 64 << 20, "b": 3, "folder": 0, "huge": 32 << 20, "gone": 64 << 20}
    (tmp_path / "folder").mkdir()
    for name, size in sizes.items():
        if name not in ("folder", "gone"):
            with open(tmp_path / name, "wb") as file:
                file.write(name.encode())
                file.truncate(size)
    columns = [[str(tmp_path / n) for n in sizes], list(sizes.values()), [n != "folder" for n in sizes]]
    names = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["document_path", "file_size", "is_file"])
    found, before = [], pa.total_allocated_bytes()
    tracemalloc.start()
    for batch in opened_rows(names, ["content", "file_size"]):
        assert pa.total_allocated_bytes() - before < 1 << 20
        for content in batch.column(0):
            bytes_ = content.as_buffer()
            found.append(bytes_ and (bytes_.size, bytes_[:2].to_pybytes()))
    assert tracemalloc.get_traced_memory()[1] < 8 << 20
    tracemalloc.stop()
    assert found == [(5, b"a\0"), (64 << 20, b"la"), (3, b"b\0"), None, (32 << 20, b"hu"), None]


def test_plug_ins_get_files_that_no_other_task_has_read(spark, folder):
    listing = list_documents(spark, folder)
    converted = convert_listing(listing, lambda: lambda path, content: str(None if content is None else len(content)))
    # The listing dealt out, and the conversion; a third one read all files, invalid ones too.
    text = plan(converted).split("\n\n")[0]
    assert text.count("MapInArrow") == 2
    rows = {os.path.basename(r.document_path): (r.success, r.content) for r in converted.collect()}
    assert rows["a.pdf"] == (True, "14") and rows["empty.pdf"] == (True, "0") and rows["dir.pdf"] == (False, "")
    for options in ({"isolate": True}, {"timeout_s": 3}):
        def slow():
            def convert(path, content):
                time.sleep(0.5)
                return str(len(content))

            return convert

        found = convert_listing(listing, slow, ConvertConfig(**options)).collect()
        assert {os.path.basename(r.document_path): (r.success, r.content) for r in found} == rows


def test_large_files_are_held_one_at_a_time(tmp_path, monkeypatch):
    monkeypatch.setattr(filesystem, "LARGE_BYTES", 3)
    monkeypatch.setattr(tempfile, "tempdir", str(tmp_path))
    (tmp_path / "f").write_bytes(b"some")
    with filesystem.Unread(str(tmp_path / "f"), 4).held() as held, open(next(tmp_path.glob("docflow-*.lock")), "ab") as other:
        assert held == [b"some"]
        with pytest.raises(BlockingIOError):
            fcntl.flock(other, fcntl.LOCK_EX | fcntl.LOCK_NB)
        with filesystem.Unread(str(tmp_path / "f"), 3).held() as small, filesystem.Unread("/missing", 1).held() as missing:
            assert (small, missing) == ([b"some"], [None])
