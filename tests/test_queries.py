"""Every query with SQL gives what DuckDB gives on the smallest tables; all others give rows."""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerloom import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"lead_model", "conversion_model", "ltv_model", "churn_model", "segments", "model_comparison", "tuned_model", "selected_features"}
#: Models need some hundred customers to find what is asked.
HELD = sorted(n for n in queries.QUERIES if n.startswith("held_"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, (float, decimal.Decimal)) else v


@pytest.mark.parametrize("name", HELD)
def test_models_are_held(spark, name):
    con = duckdb.connect()
    con.execute("create view customer as select * from '/root/testdata/sf0.01/customer.parquet'")
    compare(queries.QUERIES[name](spark, "/root/testdata/sf0.01"), con, name)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - SLOW - set(HELD)))
def test_query(spark, duck, name):
    compare(queries.QUERIES[name](spark, SF), duck, name)


def compare(out, duck, name):
    rows = [r.asDict() for r in out.collect()]
    if name not in queries.ORACLES:
        assert rows
        return
    result = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(out.columns) == sorted(names)
    want = [dict(zip(names, r, strict=True)) for r in result.fetchall()]
    line = lambda r: tuple(repr(plain(r[c])) for c in sorted(names))
    assert sorted(map(line, rows)) == sorted(map(line, want))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_training_data_operators(monkeypatch):
    import importlib
    import importlib.util

    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name == "ledgerloom.llm" else real(name, *a))
    try:
        bare = importlib.reload(entry)
        assert set(bare.queries()) == set(queries.QUERIES) and set(bare.oracle_sql()) == set(queries.ORACLES)
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
