"""Every registered query against its SQL oracle on the driver tables."""

from __future__ import annotations

import os
from pathlib import Path

import oracle
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are not here")

JOBS, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = oracle.connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    assert oracle.differences(JOBS[name](spark, FOLDER), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(JOBS) - set(SQL)))
def test_runs_without_oracle(spark, name):
    assert JOBS[name](spark, FOLDER).count() > 0


def test_entry(spark):
    first = entry.entry(spark).first()
    assert first["copies"] >= 1


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(JOBS)
