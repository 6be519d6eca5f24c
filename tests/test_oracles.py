"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from seasonlab.plans.oracles import ORACLES
from seasonlab.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERY_NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, repr(v + 0.0))
    return (3, repr(v))


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "fantasy_points" in df.columns


@pytest.mark.parametrize("name", QUERY_NAMES)
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    got_rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan  # no cross joins
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    oidx = [rel.columns.index(c) for c in order]
    a = sorted(tuple(_norm(r[c]) for c in order) for r in got_rows)
    b = sorted(tuple(_norm(r[i]) for i in oidx) for r in rel.fetchall())
    assert a == b
