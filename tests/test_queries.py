"""Every query with SQL against DuckDB on the same tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tessera import queries

TABLES = ("customer", "orders", "supplier", "events")


def plain(x):
    if isinstance(x, float):
        return 0.0 if x == 0 else round(x, 6) if not math.isnan(x) else None
    return str(x) if hasattr(x, "isoformat") else x


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_duckdb(spark, duck, sf_dir, name):
    got = queries.QUERIES[name](spark, sf_dir)
    want = duck.sql(queries.ORACLE_SQL[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    a = sorted((tuple(plain(r[c]) for c in cols) for r in got.collect()), key=str)
    at = [want.columns.index(c) for c in cols]
    b = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)
    assert a == b and (a or name in ("search_none",))


def test_all_live_matches_occur(spark, sf_dir):
    got = {r["match_type"]: r["n"] for r in queries.match_summary(spark, sf_dir).collect()}
    assert {k for k, v in got.items() if v} == {"exact", "exactOffset", "highOverlap", "moved", "newBoundary", "fail", "Total"} and got["Total"] == 150


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_outside_import_of_the_pipeline_operators():
    root = Path(__file__).resolve().parents[1] / "tessera"
    for p in root.rglob("*.py"):
        if "llm" not in p.parts:
            assert "tessera.llm" not in p.read_text()
