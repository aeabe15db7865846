"""Queries of the text operators against their SQL on small tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(
    os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as entry
from check import TABLES, rows_of
from litsearch.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")


def test_all_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = con.execute(ORACLE_SQL[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    got = QUERIES[name](spark, SF)
    assert rows_of(got.columns, got.collect()) == want
