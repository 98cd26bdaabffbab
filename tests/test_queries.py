"""Every registered query against its SQL check on the smallest driver tables."""

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tools.compare import compare  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query_equals_sql(spark, duck, sf, name):
    line = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], sf)
    assert line.startswith("ok") and "TYPES" not in line, line


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
