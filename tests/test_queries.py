"""Registered queries against their SQL on the smallest given tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import normal

SF = "/root/testdata/sf0.001"
QUERIES = {n: f for n, f in entry.queries().items() if f.__module__.startswith("workload.")}
ORACLES = {n: q for n, q in entry.oracle_sql().items() if n in QUERIES}
# the end-to-end job and the widest plans are left to check.py
HEAVY = {"workload.whole", "workload.scores"}
LIGHT = [n for n, f in QUERIES.items() if f.__module__ not in HEAVY] + ["geo_disparity", "custom_pct_prop", "safe_divide"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", LIGHT)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(cur.fetchall(), names)
