import json
import subprocess
import sys
import time

import faulty_converters as faulty
import pytest
from conftest import plan
from docflow.config import ConvertConfig
from docflow.operators import flatten_results, not_empty, validate
from docflow.operators import convert_documents as convert
from docflow.operators.convert import convert_html
from docflow.plans.convert import convert_valid
from docflow.schemas import OUTPUT_SCHEMA, RESULT_SCHEMA
from docflow.sources import documents_from_table
from pyspark.sql import functions as F


def documents(spark, *texts, parts=1):
    rows = [(f"d/{i}.txt", text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "path string, text string").coalesce(parts)
    return documents_from_table(df, "path", "text")


def results(spark, texts, converter=faulty.misbehaving, parts=1, **options):
    df = convert_valid(documents(spark, *texts, parts=parts), [not_empty()], converter, ConvertConfig(**options))
    rows = {r.document_path: r for r in df.collect()}
    assert len(rows) == len(texts), "one result per document"
    return [rows[f"d/{i}.txt"] for i in range(len(texts))]


def test_success_and_metadata(spark):
    row = results(spark, ["abc"], faulty.well_behaved)[0]
    assert (row.success, row.content, row.error_message) == (True, "ABC", None)
    assert json.loads(row.metadata) == {
        "file_name": "0.txt", "file_size": "3", "file_extension": ".txt", "file_path": "d/0.txt",
        "num_pages": "3", "confidence_score": "0.93", "document_metadata": "{'k': 1}",
    }


def test_each_fault_costs_one_row(spark):
    texts = ["ok", "raise", "", "exit", "none", "surrogate", "nulls", "ok"]
    rows = results(spark, texts)
    assert [r.success for r in rows] == [True, False, False, False, False, True, True, True]
    assert rows[1].error_message.startswith("Error processing d/1.txt: bad\nfile\nTraceback: Traceback")
    assert rows[2].error_message == "Invalid file"
    assert rows[3].error_message.startswith("Error processing d/3.txt: 3")
    assert rows[4].error_message == "Error processing d/4.txt: converter returned NoneType, not text"
    assert rows[5].content == "a\\ud800b"
    assert json.loads(rows[6].metadata)["num_pages"] == json.loads(rows[6].metadata)["confidence_score"] == ""
    for row in rows:
        if not row.success:
            assert row.content == "" and row.metadata == "{}"


def test_time_limit(spark):
    rows = results(spark, ["ok", "hang", "ok"], timeout_s=0.3)
    assert [r.success for r in rows] == [True, False, True]
    assert rows[1].error_message.startswith("Error processing d/1.txt: timed out after 0.3 s\n")


def test_hanging_documents_wait_together(spark):
    # Sixteen in one task took 16 * 3 s; in eight processes at once, 2 * 3 s and their start.
    start = time.monotonic()
    rows = results(spark, ["ok", *["hang"] * 16, "ok"], faulty.slow_once_in_process, timeout_s=3)
    assert time.monotonic() - start < 30
    assert [r.success for r in rows] == [True, *[False] * 16, True]
    for i, row in enumerate(rows[1:-1], 1):
        assert row.error_message.startswith(f"Error processing d/{i}.txt: timed out after 3 s\nTraceback")


def test_long_documents_have_all_their_time(spark):
    texts = ["ok", "slow", "odd", "slow", "", "ok"]
    rows = results(spark, texts, faulty.slow_once_in_process, timeout_s=4)
    assert [r.success for r in rows] == [True, True, True, True, False, True]
    assert rows[0].content == rows[5].content and rows[1].content != rows[0].content
    # What cannot be sent back is converted in the worker.
    assert "generator" in json.loads(rows[2].metadata)["document_metadata"]
    alone = results(spark, texts, faulty.slow_once_in_process, timeout_s=4, overtime=0)
    assert len({r.content for r in alone if r.content.isdigit()}) == 1
    died = results(spark, ["die", "ok", "ok"], faulty.dies_when_long, timeout_s=4)
    assert [r.success for r in died] == [False, True, True]
    assert died[0].error_message == "Error processing d/0.txt: converter process ended with exit code -9"


def test_children_import_nothing_anew(spark):
    # What a child uses before its first document is less than what importing Spark's worker module takes.
    code = "import time, pyspark.serializers; s = time.process_time(); import pyspark.worker; print(time.process_time() - s)"
    imports = float(subprocess.run([sys.executable, "-c", code], capture_output=True, check=True, text=True).stdout)
    rows = results(spark, ["crash", "cpu"] * 5, faulty.telling_its_time, isolate=True)
    used = sorted(float(r.content) for r in rows if r.success)
    assert len(used) == 5 and used[2] < imports / 2


def test_isolation_survives_crash_and_hang(spark):
    rows = results(spark, ["ok", "crash", "hang", "raise", "exit", "ok"], isolate=True, timeout_s=2)
    assert [r.success for r in rows] == [True, False, False, False, False, True]
    assert rows[1].error_message == "Error processing d/1.txt: converter process ended with exit code -11"
    assert rows[2].error_message == "Error processing d/2.txt: timed out after 2 s"
    assert "bad\nfile\nTraceback" in rows[3].error_message


@pytest.mark.parametrize(
    "converter, options, message",
    [
        (faulty.never_built, {}, "cannot build converter: no model"),
        (faulty.never_built, {"isolate": True}, "cannot build converter: no model"),
        (faulty.crash_when_built, {"isolate": True}, "cannot build converter: converter process ended with exit code -9"),
    ],
)
def test_converter_that_cannot_be_built_fails_the_task(spark, converter, options, message):
    with pytest.raises(Exception, match=message):
        results(spark, ["a", "b"], converter, **options)


def test_build_limit_is_an_option(spark):
    def slow():
        import time

        time.sleep(30)

    with pytest.raises(Exception, match="cannot build converter: timed out after 0.5 s"):
        results(spark, ["a"], slow, isolate=True, build_timeout_s=0.5)


@pytest.mark.parametrize("isolate", [False, True])
def test_one_build_per_worker(spark, isolate):
    rows = results(spark, ["x"] * 20, faulty.counting, parts=1, isolate=isolate)
    assert len({r.content for r in rows}) == 1
    df = documents(spark, *["x"] * 60)
    spread = convert_valid(df, [], faulty.counting, ConvertConfig(isolate=isolate), num_partitions=30)
    # At most one for each of the four cores, whatever the number of tasks.
    assert len({r.content for r in spread.collect()}) <= 4


def test_local_functions_work_as_plug_ins(spark):
    suffix = "!"
    assert results(spark, ["a"], lambda: lambda path, content: content + suffix)[0].content == "a!"


def test_large_texts_leave_in_several_batches(spark, monkeypatch):
    rows = results(spark, ["x" * 7_000_000] * 6, lambda: lambda path, content: content)
    assert [len(r.content) for r in rows] == [7_000_000] * 6


def test_schema_and_plan(spark):
    checked = validate(documents(spark, "a", ""), [not_empty()])
    converted = convert(checked, faulty.well_behaved)
    native = convert_html(checked)
    for df in (converted, native):
        fields = {f.name: f.dataType for f in df.schema["result"].dataType.fields}
        assert fields == {f.name: f.dataType for f in RESULT_SCHEMA.fields}
        assert not df.schema["result"].dataType["success"].nullable
    flat = flatten_results(converted)
    assert flat.columns == OUTPUT_SCHEMA.fieldNames()
    text = plan(flat.filter(~F.col("success")))
    assert text.split("\n\n")[0].count("MapInArrow") == 1 and "BatchEval" not in text
    assert "Python" not in plan(flatten_results(native)).split("\n\n")[0]


def test_native_conversion_of_bytes(spark):
    df = spark.createDataFrame([("p", bytearray(b"<p>a\xffb"))], "path string, html binary")
    row = convert_valid(documents_from_table(df, "path", "html"), [not_empty()]).first()
    assert (row.content, json.loads(row.metadata)["file_size"]) == ("a�b", "6")
