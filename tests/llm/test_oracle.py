"""SQL parity on TESTDATA for the operators that SQL can express."""

import duckdb
import pytest

from indistar.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(ORACLE_SQL[name])
    df = QUERIES[name](spark, SF).select(*rel.columns)
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, rel.fetchall()))
