"""Every registered query against SQL in another engine, on the smallest tables."""

import __spark_entry__ as entry
import duckdb
import pytest
from conftest import plan
from docflow.plans import queries as q
from docflow.plans.oracle import FOLDER, ORACLE

DATA = "/root/testdata/sf0.001"
# Those of optional parts have tests of their own.
QUERIES = q.QUERIES


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in ("pages", "documents", "orders"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
    return connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sql, name):
    df = QUERIES[name](spark, DATA)
    relation = sql.sql(ORACLE[name].replace(FOLDER, DATA))
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    order = [relation.columns.index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in relation.fetchall()]
    actual = [tuple(row) for row in df.select(*columns).collect()]
    assert sorted(actual, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("name", ["stream_convert", "list_documents", "read_content", "convert_directory", "stream_documents", "convert_pages"])
def test_tables_may_be_folders_of_parts(spark, tmp_path, name):
    for table in ("pages", "documents"):
        spark.read.parquet(f"{DATA}/{table}.parquet").repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
    files = {p.name: p.stat().st_size for p in tmp_path.rglob("*.parquet") if p.is_file()}
    rows = QUERIES[name](spark, str(tmp_path)).collect()
    if name in ("stream_convert", "convert_pages"):
        assert len(rows) == 50
    elif name == "stream_documents":
        assert {r.file_name for r in rows} == {p.name for p in tmp_path.glob("pages.parquet/*.parquet")}
    else:
        assert {r.file_name for r in rows} == set(files) and len(rows) == 6


def test_every_query_is_registered():
    assert entry.queries().keys() >= QUERIES.keys() and entry.oracle_sql().keys() >= ORACLE.keys()


def test_entry(spark):
    assert entry.entry(spark).count() == 50


def test_counting_converts_nothing(spark):
    for query in (q.status_summary, q.failures_report):
        text = plan(query(spark, DATA))
        assert "array_join" not in text and "Python" not in text
    assert text.count("Exchange") == 0


def test_flagship_moves_no_data_on_large_input(spark):
    text = plan(q._page_results(spark, DATA))
    assert "Exchange" not in text and "Python" not in text
    assert "ReadSchema: struct<url:string,html:string>" in text


def test_preview_converts_only_what_it_shows(spark):
    text = plan(q.preview(spark, DATA))
    scan = text[: text.index("(2) Filter")]
    assert "PushedFilters: [Or(IsNull(url),LessThanOrEqual(url,ScalarSubquery" in scan
    assert "rangepartitioning" not in text and text.count("TakeOrderedAndProject (") >= 2
