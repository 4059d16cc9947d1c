"""Driver contract: entry, query registry and oracle SQL agree at sf0.001."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from sluice.plans.tpch_queries import QUERIES, TABLES

from conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "STG_LINEITEM_KEY" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


def test_registry_holds_every_query():
    assert set(QUERIES) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(E.oracle_sql())))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    cur = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    order = sorted(d_cols)
    s_rows = sorted(repr(tuple(_norm(r[c]) for c in order)) for r in df.collect())
    d_rows = sorted(repr(tuple(_norm(row[d_cols.index(c)]) for c in order)) for row in cur.fetchall())
    assert s_rows == d_rows


def test_other_queries_stay_when_the_training_data_queries_do_not_import(monkeypatch):
    import sys

    for name in [n for n in sys.modules if n.startswith("sluice.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    monkeypatch.setitem(sys.modules, "sluice.llm.registry", None)
    names = set(E.queries())
    assert {"incremental_insert", "sketched_insert", "key_diff"} <= names and not any(n.startswith("op") for n in names)
