"""Every registered query against its SQL on the smallest tables."""

import sys

import pytest

import __spark_entry__ as spark_entry
from tests.oracle_check import compare, connect
from tickloom.plans import oracle
from tickloom.plans.queries import registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES = registry()
SQL = oracle.statements()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(con, QUERIES[name](spark, SF_DIR), SQL[name]) is None


def test_entry(spark):
    frame = spark_entry.entry(spark)
    assert frame.count() > 0
    assert "vwap" in frame.columns


def test_entry_registers_all():
    assert set(QUERIES) <= set(spark_entry.queries())
    assert SQL.items() <= spark_entry.oracle_sql().items()


def test_entry_without_the_training_data(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("tickloom.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)

    class Hidden:
        def find_spec(self, name, path=None, target=None):
            if name.startswith("tickloom.llm"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(sys, "meta_path", [Hidden(), *sys.meta_path])
    assert set(spark_entry.queries()) == set(QUERIES)
    assert spark_entry.oracle_sql() == SQL
