"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
from check import TABLES, rows_of
from litsearch.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries()) & set(entry.oracle_sql())


SLOW_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
              "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name, capsys):
    """Same result as the SQL, from a plan without Python and cross joins."""
    df = entry.queries()[name](spark, SF)
    capsys.readouterr()
    df.explain("extended")
    plan = capsys.readouterr().out
    assert not [node for node in SLOW_NODES if node in plan]
    cursor = con.execute(entry.oracle_sql()[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(df.columns, df.collect()) == want


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"query_id", "doc_id", "score", "rank", "topic", "n_docs"} <= set(df.columns)


def test_queries_without_the_text_operators(monkeypatch):
    """Where a library of the text operators is missing, all other queries are still there."""
    for name in [*(n for n in sys.modules if n.startswith("litsearch.llm")), "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name, raising=False)
    monkeypatch.setitem(sys.modules, "zstandard", None)
    assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql())
