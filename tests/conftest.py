import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from docflow.session import build_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = build_session(
        "docflow-tests",
        spark__master="local[4]",
        spark__driver__memory="4g",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    spark.sparkContext.addPyFile(os.path.join(ROOT, "tests", "faulty_converters.py"))
    yield spark
    spark.stop()


@pytest.fixture
def folder(tmp_path):
    """Files and a folder of every kind a listing meets; six match ``*.pdf``."""
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    for name in ("a.pdf", "b c%20é.pdf", "UP.PDF", ".hid.pdf", "_u.pdf", "n.txt", "sub/s.pdf"):
        (root / name).write_bytes(b"bytes of " + name.encode())
    (root / "empty.pdf").touch()
    (root / "dir.pdf").mkdir()
    return str(root)


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
