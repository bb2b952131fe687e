"""Every registered query against its DuckDB oracle on the smallest TESTDATA."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from indistar.plans.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="TESTDATA not present")


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rel = duck.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(rel.fetchall(), rel.columns)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["ano", "o_orderpriority", "media"]
