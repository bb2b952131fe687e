"""Property checks (hypothesis): reshaping identities and merge laws."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from indistar.operators import publish as pb
from indistar.operators import reshape as rs
from indistar.operators import windows as wn

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

cells = st.dictionaries(
    keys=st.tuples(st.integers(0, 5), st.sampled_from([10, 20, 30])),
    values=st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)),
    min_size=1, max_size=20)


@SETTINGS
@given(cells)
def test_long_wide_long_identity(spark, data):
    rows = [(k, v, x) for (k, v), x in data.items()]
    df = spark.createDataFrame(rows, "k int, var int, valor double")
    wide = rs.pivot_values(df, ["k"], "var", {10: "a", 20: "b", 30: "c"})
    back = (wide.unpivot(["k"], ["a", "b", "c"], "nome", "valor")
            .filter(F.col("valor").isNotNull()))
    names = {"a": 10, "b": 20, "c": 30}
    got = sorted((r.k, names[r.nome], r.valor) for r in back.collect())
    assert got == sorted((k, v, x) for k, v, x in rows if x is not None)


snapshots = st.dictionaries(st.integers(0, 30), st.integers(0, 9), max_size=15)


@SETTINGS
@given(snapshots, snapshots)
def test_merge_is_idempotent_and_updates_win(spark, target, updates):
    schema = "k int, v int"
    t = spark.createDataFrame(list(target.items()), schema)
    u = spark.createDataFrame(list(updates.items()), schema)
    once = pb.merge_snapshot(t, u, ["k"])
    twice = pb.merge_snapshot(once, u, ["k"])
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    assert dict(a) == {**target, **updates}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 1000)), min_size=1, max_size=25))
def test_shares_sum_to_100(spark, rows):
    df = spark.createDataFrame(rows, "g int, v long")
    s = wn.share_of_total(df, ["g"], "v", digits=None).groupBy("g").agg(F.sum("participacao_pct").alias("t"))
    assert all(abs(r.t - 100.0) < 1e-9 for r in s.collect())


@SETTINGS
@given(st.dictionaries(st.integers(2000, 2010), st.integers(1, 10_000), min_size=2, max_size=11))
def test_total_change_telescopes_without_gaps(spark, series):
    years = sorted(series)
    contiguous = {y: series.get(y, 1) for y in range(years[0], years[-1] + 1)}
    df = spark.createDataFrame([(1, y, v) for y, v in contiguous.items()], "id int, ano int, pop long")
    g = wn.previous_period_change(df, ["id"], "ano", "pop")
    total = g.agg(F.sum("variacao_absoluta").alias("t")).first().t
    assert total == contiguous[years[-1]] - contiguous[years[0]]
