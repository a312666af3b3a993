import json
import time

import pytest
from docflow.config import ConvertConfig
from docflow.functions import build_metadata, file_name, stringify_metadata, suffix, url_path
from docflow.operators import Rule, file_rules, has_suffix, validate
from docflow.operators.validate import ends_with
from docflow.schemas import LISTING_SCHEMA
from pyspark.sql import functions as F


@pytest.mark.parametrize(
    "name, expected",
    [("a.PDF", ".PDF"), (".pdf", ""), ("a.", ""), ("a.b.pdf", ".pdf"), ("a", ""), ("..pdf", ".pdf"), ("x\ny.pdf", ".pdf")],
)
def test_suffix(spark, name, expected):
    assert spark.range(1).select(suffix(F.lit(name))).first()[0] == expected


def test_names(spark):
    one = spark.range(1)
    for path, expected in {"file:/a/b.pdf": "b.pdf", "a/b/": "b", "b": "b", "/": ""}.items():
        assert one.select(file_name(F.lit(path))).first()[0] == expected
    url = "https://h/x/y.html?q=/a#/b"
    assert one.select(url_path(F.lit(url))).first()[0] == "https://h/x/y.html"


def test_first_broken_rule_is_named(spark):
    rows = [
        ("p/gone.pdf", "gone.pdf", None, False, False),
        ("p/dir.pdf", "dir.pdf", 0, False, True),
        ("p/n.txt", "n.txt", 3, True, True),
        ("p/e.pdf", "e.pdf", 0, True, True),
        ("p/.h.pdf", ".h.pdf", 3, True, True),
        ("p/UP.PDF", "UP.PDF", 3, True, True),
    ]
    df = spark.createDataFrame(rows, LISTING_SCHEMA)
    checked = {r.file_name: r for r in validate(df, file_rules()).collect()}
    assert {n: r.failed_rule for n, r in checked.items()} == {
        "gone.pdf": "exists", "dir.pdf": "is_file", "n.txt": "suffix", "e.pdf": None,
        ".h.pdf": None, "UP.PDF": None,
    }
    assert all(r.is_valid == (r.failed_rule is None) for r in checked.values())
    assert all((r.error_message == "Invalid file") != r.is_valid for r in checked.values())


def test_null_condition_is_not_met(spark):
    df = spark.range(1).select(F.lit(None).cast("string").alias("file_name"))
    assert validate(df, [has_suffix(".pdf")]).first().failed_rule == "suffix"
    assert validate(df, []).first().is_valid
    assert validate(df, [Rule("never", F.lit(False))]).first().failed_rule == "never"


def test_tail(spark):
    whole = ["<P></HTML> ", "x</html>\n", "x</html>\r\n", "x</html><!-- c -->", "</html> <!-- a\n-- b --> \t<!---->", "a</html>b</html>"]
    cut = ["<p>", "", "</html>x", "</html><!-- ", "</html> <!-- a --> b", "</htm"]
    df = spark.createDataFrame([(t,) for t in whole + cut], "content string")
    assert [r.is_valid for r in validate(df, [ends_with("</html>")]).collect()] == [True] * 6 + [False] * 6


@pytest.mark.parametrize("piece", ["</html> ", "</html><!-- ", "<!-- --> ", " ", "-->"])
def test_tail_of_hostile_pages_takes_linear_time(spark, piece):
    df = spark.createDataFrame([(piece * 200_000 + "x",)], "content string")
    begun = time.perf_counter()
    assert not validate(df, [ends_with("</html>")]).first().is_valid
    assert time.perf_counter() - begun < 5


def test_metadata_order_defaults_and_optional_entry(spark):
    df = spark.createDataFrame(
        [("d/a.pdf", 7, 3, 0.93, "{'t': 1}"), ("d/b", None, None, None, None)],
        "p string, s long, n int, c double, d string",
    )
    metadata = build_metadata(*[F.col(c) for c in "ps"], None, *[F.col(c) for c in "ncd"])
    full, bare = [r[0] for r in df.select(F.to_json(metadata)).collect()]
    assert full == (
        '{"file_name":"a.pdf","file_size":"7","file_extension":".pdf","file_path":"d/a.pdf",'
        '"num_pages":"3","confidence_score":"0.93","document_metadata":"{\'t\': 1}"}'
    )
    assert json.loads(bare) == {
        "file_name": "b", "file_size": "", "file_extension": "", "file_path": "d/b",
        "num_pages": "0", "confidence_score": "0.0",
    }


def test_stringify(spark):
    one = spark.range(1)
    values = {"i": F.lit(1), "f": F.lit(0.5), "n": F.lit(None), "b": F.lit(True)}
    assert one.select(F.to_json(stringify_metadata(values))).first()[0] == '{"i":"1","f":"0.5","n":"","b":"true"}'
    assert one.select(F.to_json(stringify_metadata({}))).first()[0] == "{}"
    for given, expected in {
        "cast(null as map<string,int>)": "{}",
        "cast(map() as map<string,int>)": "{}",
        "map('a', 1, 'b', null)": '{"a":"1","b":""}',
    }.items():
        assert one.select(F.to_json(stringify_metadata(F.expr(given)))).first()[0] == expected


def test_config():
    config = ConvertConfig()
    assert (config.timeout_s, config.image_mode, config.tables) == (300.0, "embedded", True)
    assert config.updated(timeout_s=5).timeout_s == 5 and config.timeout_s == 300.0
    with pytest.raises(TypeError):
        ConvertConfig(table_mode="accurate")
    with pytest.raises(ValueError):
        ConvertConfig(image_mode="inline")
    with pytest.raises(ValueError):
        ConvertConfig(timeout_s=-1)
