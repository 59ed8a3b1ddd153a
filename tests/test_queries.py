"""Every registered query against its SQL."""

import importlib
import sys

import pytest

import __spark_entry__ as registry
from tests.compare import difference, duck
from tidemark.plans import oracle, queries, streams

FOLDER = "/root/testdata/sf0.001"
QUERIES = {**queries.BATCH, **streams.STREAM}
SQL = {**oracle.BATCH, **oracle.STREAM}


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert SQL.keys() == QUERIES.keys()
    assert QUERIES.items() <= registry.queries().items()
    assert SQL.items() <= registry.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    frame = QUERIES[name](spark, FOLDER)
    assert difference(frame, connection, SQL[name]) is None


def test_entry(spark):
    assert registry.entry(spark).columns == ["channel", "sequence", "trade_date", "price"]


def test_core_queries_without_the_corpus_ones(monkeypatch):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("tidemark.llm.")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "tidemark.llm", None)  # importing it raises ImportError
    try:
        assert importlib.reload(registry).queries().keys() == QUERIES.keys()
        assert registry.oracle_sql().keys() == SQL.keys()
    finally:
        monkeypatch.undo()
        importlib.reload(registry)
