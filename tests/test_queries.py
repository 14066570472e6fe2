"""Every registered query that has SQL, against DuckDB on the smallest tables."""

from __future__ import annotations

from datetime import date, datetime

import duckdb
import pytest

from cadastre.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return v.isoformat() if isinstance(v, date | datetime) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    if name not in ORACLES:
        assert got
        return
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == names
    at = [rel.columns.index(n) for n in names]
    assert got == sorted((tuple(plain(r[k]) for k in at) for r in rel.fetchall()), key=repr)


def test_scans_are_pruned_and_filtered(spark):
    plan = QUERIES["jn_semi"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,300000.0)" in plan and "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan
