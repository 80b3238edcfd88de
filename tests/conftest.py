from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from weftline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect a frame as a sorted list of plain tuples."""

    def collect(df, *cols):
        out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
        return sorted(out, key=repr)

    return collect


@pytest.fixture
def value(spark):
    """One column expression over one literal row."""

    def evaluate(column, **literals):
        from pyspark.sql import functions as F

        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in literals.items()])
        return row.select(column.alias("out")).first()["out"]

    return evaluate
