"""Hot keys (a third of all rows on one key) and the join helpers."""

import contextlib
import io

import pandas as pd
import pytest
from pyspark.sql import functions as F

from indistar.operators import aggregates as agg
from indistar.operators import contracts as ct
from indistar.operators import flatten as fl
from indistar.operators import joins as jn
from indistar.operators import reshape as rs
from indistar.operators import windows as wn
from pyspark.sql import types as T


@pytest.fixture(scope="module")
def skewed(spark):
    rows = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else i % 97 + 1          # key 0 holds a third of the rows
        rows.append((key, 2000 + i % 7, i, float(i % 13)))
    pdf = pd.DataFrame(rows, columns=["k", "ano", "seq", "v"])
    return pdf, spark.createDataFrame(pdf).repartition(8)


def test_keep_last_hot_key(skewed):
    pdf, df = skewed
    got = {r.k: r.seq for r in rs.dedup_keep_last(df, ["k"], ["seq"]).collect()}
    assert got == pdf.groupby("k")["seq"].max().to_dict()


def test_pivot_hot_key(skewed):
    pdf, df = skewed
    wide = rs.pivot_values(df, ["k"], "ano", {2000: "a", 2003: "b"}, "v", conflict="max").collect()
    want = pdf[pdf.ano == 2003].groupby("k")["v"].max().to_dict()
    assert {r.k: r.b for r in wide if r.b is not None} == want and len(wide) == pdf.k.nunique()


def test_growth_after_aggregation_hot_key(skewed):
    pdf, df = skewed
    per = df.groupBy("k", "ano").agg(F.count(F.lit(1)).alias("n"))
    g = {(r.k, r.ano): r.variacao_absoluta for r in wn.previous_period_change(per, ["k"], "ano", "n").collect()}
    cnt = pdf.groupby(["k", "ano"]).size()
    assert g[(0, 2001)] == cnt[(0, 2001)] - cnt[(0, 2000)]


def test_duplicate_summary_and_fk_hot_key(spark, skewed):
    pdf, df = skewed
    s = agg.duplicate_key_summary(df, ["k"]).first()
    assert s.n_duplicadas == len(pdf) - pdf.k.nunique()
    dim = spark.createDataFrame([(k,) for k in range(1, 98)], "k int")
    c = ct.Contract("s", T.StructType([T.StructField("k", T.LongType())]), key=[],
                    foreign_keys=[(["k"], "d", ["k"])])
    v = ct.violations(c, df.select("k"), {"d": dim}).first()
    assert v.violacoes == (pdf.k == 0).sum()


def test_join_helpers(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, 99)], "id int, uf_id int")
    dim = spark.createDataFrame([(10, "A", 1), (20, "B", 2)], "uf_id int, nome string, reg int")
    assert jn.orphans(fact, dim, "uf_id").count() == 1
    assert jn.attach_dimension(fact, dim, "uf_id").filter("nome is null").count() == 1
    regions = spark.createDataFrame([(1,)], "reg int")
    out = jn.propagate_filter([(regions, None), (dim, "reg")], fact, "uf_id")
    assert [r.id for r in out.collect()] == [1]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        jn.attach_dimension(fact, dim, "uf_id").explain()
    assert "Broadcast" in buf.getvalue()


def test_struct_expand_and_dedup_any(spark):
    df = spark.createDataFrame([(1, (2, "x")), (1, (2, "x"))], "id int, s struct<a:int,b:string>")
    e = fl.expand_struct(df, "s", "s_")
    assert e.columns == ["id", "s_a", "s_b"]
    assert rs.dedup_any(e, ["id"]).count() == 1


def test_share_hot_and_null_partitions_without_window(spark, skewed):
    pdf, df = skewed
    rows = df.select(F.when(F.col("k") == 5, F.lit(None)).otherwise(F.col("k")).alias("k"), "seq", "v")
    out = wn.share_of_total(rows, ["k"], "v", digits=None)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    got = {r.seq: r.participacao_pct for r in out.collect()}
    keyed = pdf.assign(k=pdf.k.where(pdf.k != 5, -1))         # null keys form one group, as in a window
    tot = keyed.groupby("k").v.transform("sum")
    want = (100.0 * keyed.v / tot).where(tot != 0)            # zero total -> null
    for seq, w in zip(keyed.seq, want):
        if pd.isna(w):
            assert got[seq] is None
        else:
            assert got[seq] == pytest.approx(w)
    assert out.count() == len(pdf)
