"""Every registered query beside its SQL, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_query(spark, db, name):
    df = entry_module.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name in entry_module.oracle_sql():
        found = db.execute(entry_module.oracle_sql()[name])
        names = [c[0] for c in found.description]
        assert sorted(names) == sorted(df.columns)
        assert got == rows_of(names, found.fetchall())
    else:
        # Without SQL: that it runs and keeps its columns. What it finds is tested with its operator.
        assert df.columns and all(len(r) == len(df.columns) for r in got)


def test_entry(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
