import json
import logging
import os
import shutil
import subprocess
import sys

import pytest
from conftest import ROOT
from docflow.operators import file_rules
from docflow.plans.convert import convert_valid
from docflow.plans.job import _arguments, run_job
from docflow.schemas import OUTPUT_SCHEMA
from docflow.session import scratch_dir
from docflow.sinks import read_results, recover, write_results
from docflow.sources import InputNotFound, list_documents
from docflow.sources.dealing import FILE_BYTES
from docflow.streaming import missing_documents, stream_documents, stream_every_document, stream_results
from faulty_converters import misbehaving_on_bytes as text_converter
from pyspark.sql import functions as F


def test_stream_takes_each_file_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    os.mkdir(source)

    def add(*names):
        for name in names:
            with open(f"{source}/{name}", "w") as file:
                file.write(f"<p>{name}")

    def run():
        query = stream_results(
            stream_documents(spark, source, "*.html"),
            out,
            checkpoint,
            lambda docs: convert_valid(docs, file_rules(".html")),
        )
        query.awaitTermination()
        return sorted(r.content for r in spark.read.schema(OUTPUT_SCHEMA).json(out).collect())

    add("a.html", "b.html", "c.html", "skipped.txt")
    open(f"{source}/empty.html", "w").close()
    assert run() == ["a.html", "b.html", "c.html"]
    add("d.html")
    assert run() == ["a.html", "b.html", "c.html", "d.html"]
    assert run() == ["a.html", "b.html", "c.html", "d.html"]
    listing = list_documents(spark, source, "*.html")
    missing = missing_documents(listing, spark.read.schema(OUTPUT_SCHEMA).json(out))
    assert [r.file_name for r in missing.collect()] == ["empty.html"]


def test_stream_of_every_file(spark, tmp_path):
    """Hidden and empty files, sub-folders, links and folders of a matching name, each once, over restarts."""
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    (source / "sub").mkdir(parents=True)

    def run():
        documents = stream_every_document(spark, str(source), f"{checkpoint}-log", "*.html", recursive=True)
        convert = lambda docs: convert_valid(docs, file_rules(".html"), lambda: lambda p, c: c.decode())
        stream_results(documents, out, checkpoint, convert).awaitTermination()
        rows = spark.read.schema(OUTPUT_SCHEMA).json(out).collect()
        return sorted((r.document_path.removeprefix(f"file:{source}/"), r.success, r.content) for r in rows)

    (source / "a.html").write_text("a")
    (source / ".hidden.html").write_text("h")
    (source / "empty.html").touch()
    (source / "other.txt").write_text("t")
    os.symlink(source, source / "sub" / "up")
    first = [(".hidden.html", True, "h"), ("a.html", True, "a"), ("empty.html", True, "")]
    rows = run()
    assert rows == first or rows == [*first[:2], ("empty.html", False, "")]
    first = rows
    assert run() == first
    (source / "sub" / "_b.html").write_text("b")
    (source / "sub" / "dir.html").mkdir()
    assert run() == sorted([*first, ("sub/_b.html", True, "b"), ("sub/dir.html", False, "")])
    assert len(run()) == 5


def test_a_file_that_cannot_be_read_is_a_row_of_the_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.html").write_text("<p>a")
    (source / "big.html").write_text("<p>" + "b" * 100)
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 50)
    try:
        docs = stream_documents(spark, str(source), "*.html")
        stream_results(docs, str(tmp_path / "out"), str(tmp_path / "cp"), lambda d: convert_valid(d, file_rules(".html"))).awaitTermination()
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", before)
    assert spark.read.schema(OUTPUT_SCHEMA).json(str(tmp_path / "out")).filter("success").count() == 2


@pytest.fixture
def texts(tmp_path):
    for name in ("ok.pdf", "raise.pdf"):
        (tmp_path / name).write_text(name[:-4])
    (tmp_path / "empty.pdf").touch()
    return str(tmp_path)


def test_job(spark, texts, caplog):
    out = scratch_dir(spark, "job")
    with caplog.at_level(logging.INFO, "docflow"):
        report = run_job(spark, texts, out, text_converter)
    assert report[:3] == (3, 2, 1)
    assert {os.path.basename(r.document_path) for r in report.failures.collect()} == {"raise.pdf"}
    assert "documents: 3, succeeded: 2, failed: 1" in caplog.text and "status=failed" in caplog.text
    rows = spark.read.schema(OUTPUT_SCHEMA).json(out).collect()
    assert len(rows) == 3


def test_job_without_failures_or_input(spark, texts):
    os.rename(f"{texts}/raise.pdf", f"{texts}/raise.txt")
    out = scratch_dir(spark, "job")
    report = run_job(spark, texts, out, text_converter, pattern="ok.pdf")
    assert report[:3] == (1, 1, 0) and report.failures.count() == 0
    with pytest.raises(InputNotFound):
        run_job(spark, texts + "/none", out, text_converter)


def test_documents_are_converted_once(spark, texts, tmp_path):
    marks = str(tmp_path / "marks")
    os.mkdir(marks)

    def converter():
        import tempfile

        def convert(path, content):
            tempfile.mkstemp(dir=marks)
            return "x"

        return convert

    run_job(spark, texts, scratch_dir(spark, "job"), converter)
    assert len(os.listdir(marks)) == 3


def marked_converter(marks):
    def converter():
        import tempfile

        def convert(path, content):
            if content == b"raise":
                raise ValueError("refused")
            tempfile.mkstemp(dir=marks, prefix=os.path.basename(path))
            return content.decode()

        return convert

    return converter


def contents(df):
    return sorted((os.path.basename(r.document_path), r.success, r.content) for r in df.collect())


def test_a_job_that_was_broken_off_goes_on(spark, tmp_path):
    source, marks, out = tmp_path / "in", str(tmp_path / "marks"), scratch_dir(spark, "job")
    source.mkdir()
    os.mkdir(marks)
    for i in range(40):
        (source / f"{i}.pdf").write_text("raise" if i % 10 == 0 else f"text {i}")
    converter = marked_converter(marks)
    run = lambda **more: run_job(spark, str(source), out, converter, resume=True, chunk_bytes=8 * FILE_BYTES, **more)
    first = run(max_chunks=2)
    assert 0 < first.total < 40 and first.total == read_results(spark, out).count()
    # What an attempt without an end has left behind is not read, and removed by the next.
    os.makedirs(f"{out}/chunk=2/status=succeeded")
    with open(f"{out}/chunk=2/status=succeeded/part-0.json", "w") as file:
        file.write('{"document_path": "x", "success": true}\n')
    assert read_results(spark, out).count() == first.total
    second = run()
    assert second[:3] == (40, 36, 4) and second.failures.count() == 4
    expected = sorted((f"{i}.pdf", i % 10 != 0, "" if i % 10 == 0 else f"text {i}") for i in range(40))
    assert contents(read_results(spark, out)) == expected
    assert len(os.listdir(marks)) == 36
    # Nothing new; then a new file, a changed one and one that now can be read.
    assert run()[:3] == (40, 36, 4) and len(os.listdir(marks)) == 36
    (source / "new.pdf").write_text("new")
    (source / "7.pdf").write_text("changed")
    (source / "10.pdf").write_text("mended")
    assert run()[:3] == (41, 38, 3) and len(os.listdir(marks)) == 39
    found = {name: text for name, _, text in contents(read_results(spark, out))}
    assert len(found) == 41 and (found["7.pdf"], found["10.pdf"], found["new.pdf"]) == ("changed", "mended", "new")
    assert read_results(spark, out).count() == 41


def test_a_chunk_whose_manifest_is_missing_is_made_again(spark, tmp_path):
    source, marks, out = tmp_path / "in", str(tmp_path / "marks"), scratch_dir(spark, "job")
    source.mkdir()
    os.mkdir(marks)
    for i in range(6):
        (source / f"{i}.pdf").write_text(f"{i}")
    run = lambda: run_job(spark, str(source), out, marked_converter(marks), resume=True)
    assert run()[:3] == (6, 6, 0)
    os.unlink(f"{out}/_manifest/chunk=0/documents/_SUCCESS")
    assert read_results(spark, out).count() == 0
    assert run()[:3] == (6, 6, 0) and len(contents(read_results(spark, out))) == 6


def test_a_result_without_manifest_is_not_continued(spark, texts):
    out = scratch_dir(spark, "job")
    run_job(spark, texts, out, text_converter)
    with pytest.raises(ValueError, match="without a manifest"):
        run_job(spark, texts, out, text_converter, resume=True)
    assert read_results(spark, out).count() == 3


def test_a_failing_job_leaves_the_old_result(spark, tmp_path):
    out = str(tmp_path / "out")
    good = spark.range(5).select(F.col("id").cast("string").alias("document_path"), F.lit(True).alias("success"))
    write_results(good, out)
    bad = good.select(F.when(F.col("document_path") == "3", F.raise_error(F.lit("no"))).otherwise("9").alias("document_path"), "success")
    with pytest.raises(Exception, match="no"):
        write_results(bad, out)
    assert sorted(r.document_path for r in read_results(spark, out).collect()) == list("01234")
    assert sorted(os.listdir(tmp_path)) == ["out"]
    write_results(good.where("document_path > 2"), out)
    assert read_results(spark, out).count() == 2 and sorted(os.listdir(tmp_path)) == ["out"]
    # A run that ended after it had moved the old result away.
    os.rename(out, tmp_path / ".out.previous")
    recover(spark, out)
    assert read_results(spark, out).count() == 2
    os.rename(out, tmp_path / ".out.previous")
    write_results(good, out)
    assert read_results(spark, out).count() == 5 and sorted(os.listdir(tmp_path)) == ["out"]


def test_scratch_needs_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_arguments():
    args = _arguments(["--input-dir", "i", "--output-file", "o"])
    assert (args.input, args.output, args.timeout) == ("i", "o", 300.0)


def command(*args, cwd):
    env = {**os.environ, "PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"}
    return subprocess.run(
        [sys.executable, os.path.join(ROOT, "job.py"), *args], cwd=cwd, env=env, capture_output=True, timeout=240
    )


def test_command_line(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.html").write_text("<h1>Hé</h1>")
    done = command("--input-dir", "in", "--output-file", "out/results.jsonl", cwd=tmp_path)
    assert done.returncode == 0, done.stderr.decode()[-2000:]
    (part,) = (tmp_path / "out" / "results.jsonl" / "status=succeeded").glob("part-*")
    (line,) = part.read_text().splitlines()
    assert json.loads(line)["content"] == "# Hé"
    shutil.rmtree(tmp_path / "in")
    assert command("--input-dir", "in", "--output", "out2", cwd=tmp_path).returncode != 0
