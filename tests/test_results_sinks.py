import glob
import json
import os

import pytest
from docflow.operators import failures, failures_report, preview, successes, summarize
from docflow.schemas import OUTPUT_SCHEMA
from docflow.sinks import write_jsonl, write_results

ROWS = [
    ("a/ü.pdf", True, 'line\nnext "q" é', '{"k":"v"}', None),
    ("b.pdf", False, "", "{}", "Invalid file"),
    ("c.pdf", True, "x" * 60, "{}", None),
]


@pytest.fixture
def flat(spark):
    return spark.createDataFrame(ROWS, OUTPUT_SCHEMA)


def test_counts(flat):
    assert tuple(summarize(flat).first()) == (3, 2, 1)
    assert tuple(summarize(flat.limit(0)).first()) == (0, 0, 0)
    assert [r.document_path for r in failures(flat).collect()] == ["b.pdf"]
    assert successes(flat).count() == 2
    assert [tuple(r) for r in failures_report(flat).collect()] == [("b.pdf", "Invalid file")]


def test_preview(flat):
    rows = preview(flat, n=2).collect()
    assert [r.document_path for r in rows] == ["a/ü.pdf", "b.pdf"]
    assert preview(flat).collect()[2].content == "x" * 47 + "..."
    assert preview(flat, width=None).collect()[2].content == "x" * 60
    assert "TakeOrderedAndProject" in preview(flat)._jdf.queryExecution().toString()


def lines(path):
    files = glob.glob(path + "/**/part-*.json", recursive=True) if os.path.isdir(path) else [path]
    return [line for file in files for line in open(file, encoding="utf-8").read().splitlines()]


def test_json_lines(flat, spark, tmp_path):
    path = str(tmp_path / "new" / "folder" / "out")
    for _ in range(2):  # replaces what is there
        write_jsonl(flat, path)
    text = lines(path)
    assert len(text) == 3
    objects = [json.loads(line) for line in text]
    assert all(list(o) == OUTPUT_SCHEMA.fieldNames() for o in objects)
    assert any("é" in line and "\\u00e9" not in line for line in text)
    assert sorted(tuple(o.values()) for o in objects) == sorted(ROWS)
    assert sorted(spark.read.schema(OUTPUT_SCHEMA).json(path).collect()) == sorted(flat.collect())


def test_results_are_split_by_status(flat, spark, tmp_path):
    path = str(tmp_path / "out")
    write_results(flat, path)
    assert len(lines(f"{path}/status=failed")) == 1 and len(lines(f"{path}/status=succeeded")) == 2
    assert all(list(json.loads(x)) == OUTPUT_SCHEMA.fieldNames() for x in lines(path))
    assert spark.read.json(path).filter("status = 'failed'").first().error_message == "Invalid file"
