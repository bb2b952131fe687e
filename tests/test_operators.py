import datetime as dt

import pytest
from pyspark.sql import functions as F

from indistar.operators import aggregates as agg
from indistar.operators import reshape as rs
from indistar.operators import windows as wn


def test_pivot_null_first_and_unlisted(spark):
    df = spark.createDataFrame(
        [(1, 10, None), (1, 10, 5.0), (1, 20, 7.0), (1, 99, 1.0), (2, 99, 3.0)],
        "k int, var int, valor double").repartition(3)
    w = rs.pivot_values(df, ["k"], "var", {10: "a", 20: "b"})
    rows = {r.k: r for r in w.collect()}
    assert (rows[1].a, rows[1].b) == (5.0, 7.0)   # a null arriving first does not win
    assert (rows[2].a, rows[2].b) == (None, None)  # unlisted id: key row survives
    assert rs.multi_valued_cells(df, ["k"], "var").count() == 0
    df2 = df.union(spark.createDataFrame([(1, 10, 6.0)], df.schema))
    assert rs.multi_valued_cells(df2, ["k"], "var").count() == 1


def test_dedup_keep_last_partitioning_independent(spark):
    data = [(k % 5, i, float(i)) for i, k in enumerate(range(200))]
    df = spark.createDataFrame(data, "k int, ordem int, v double")
    a = sorted(tuple(r) for r in rs.dedup_keep_last(df, ["k"], ["ordem"]).collect())
    b = sorted(tuple(r) for r in rs.dedup_keep_last(df.repartition(7, "v"), ["k"], ["ordem"]).collect())
    assert a == b and [r[1] for r in a] == [195, 196, 197, 198, 199]


def test_union_and_column_sets(spark):
    with pytest.raises(ValueError):
        rs.union_frames([])
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, id int")
    assert rs.union_frames([a, b]).count() == 2
    assert rs.column_set_diff(a, ["id", "z"]) == (["z"], ["s"])
    with pytest.raises(ValueError):
        rs.require_columns(a, ["id", "z"])


def test_split_by_class(spark):
    df = spark.createDataFrame([(93, 1.9), (9808, 2.555), (9810, -3.3)], "variavel_id int, valor double")
    out = rs.split_by_class(df, "variavel_id", {"p": ([93], "n", "long"), "f": ([9808], "m", "decimal(20,2)")})
    assert out["p"].first().n == 1 and float(out["f"].first().m) == 2.56


def test_duplicate_key_summary_and_null_profile(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 1, "a"), (1, 2, None), (2, 1, "b")], "a int, b int, c string")
    s = agg.duplicate_key_summary(df, ["a", "b"]).first()
    assert (s.n_linhas, s.n_chaves, s.n_duplicadas, s.n_chaves_repetidas) == (4, 3, 1, 1)
    p = agg.null_profile(df).first()
    assert (p.a, p.c, p.total_nulos) == (0, 2, 2)
    assert agg.duplicate_keys(df, ["a", "b"]).count() == 1


def test_avg_of_avgs_merges_labels_across_years(spark):
    df = spark.createDataFrame([("SP", 2021, "1º trimestre", 10.0), ("SP", 2021, "1º trimestre", 20.0),
                                ("SP", 2022, "1º trimestre", 30.0), ("SP", 2022, "2º trimestre", 40.0)],
                               "uf string, ano int, trimestre string, taxa double")
    merged = agg.avg_of_avgs(df, ["uf"], "trimestre", "taxa").first().media
    assert merged == pytest.approx(((10 + 20 + 30) / 3 + 40) / 2)
    per_year = {r.ano: r.media for r in agg.avg_of_avgs(df, ["uf", "ano"], "trimestre", "taxa").collect()}
    assert per_year == {2021: 15.0, 2022: 35.0}


def test_matrix_levels(spark):
    df = spark.createDataFrame([("A", "g1", 2020, 5.0), ("A", "g2", 2020, 3.0), ("A", "g1", 2021, 1.0),
                                ("B", "g1", 2020, 9.0)], "area string, grupo string, ano int, v double")
    m = {(r.nivel, r.area, r.grupo): r for r in agg.matrix(df, "area", "grupo", "ano", "v", [2020, 2021]).collect()}
    assert m[(0, "A", "g1")].v_2020 == 5.0 and m[(0, "A", "g1")].v_2021 == 1.0
    assert m[(1, "A", None)].v_2020 == 3.0
    assert m[(3, None, None)].v_2020 == 3.0 and m[(3, None, None)].v_2021 == 1.0
    assert len(m) == 3 + 2 + 1


def test_matrix_fails_on_an_unlisted_column(spark):
    df = spark.createDataFrame([("A", "g1", 2020, 5.0), ("A", "g2", 2022, 3.0)], "area string, grupo string, ano int, v double")
    with pytest.raises(Exception, match="no column for ano = 2022"):
        agg.matrix(df, "area", "grupo", "ano", "v", [2020, 2021]).collect()


def test_date_drill_levels(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 5), 1.0), (dt.date(2020, 4, 5), 2.0), (dt.date(2021, 1, 1), 3.0)],
                               "d date, v double")
    r = agg.date_drill(df, "d", [F.sum("v").alias("s")])
    levels = {}
    for x in r.collect():
        levels.setdefault(x.nivel, []).append(x.s)
    assert sorted(levels[3]) == [6.0] and sorted(levels[2]) == [3.0, 3.0] and len(levels[0]) == 3


def test_previous_period_change_gap_and_share(spark):
    df = spark.createDataFrame([(1, 2019, 100), (1, 2020, 110), (1, 2022, 121), (2, 2020, 0), (2, 2021, 5)],
                               "id int, ano int, pop long")
    g = {(r.id, r.ano): r for r in wn.previous_period_change(df, ["id"], "ano", "pop").collect()}
    assert g[(1, 2020)].crescimento_pct == 10.0 and g[(1, 2020)].variacao_absoluta == 10
    assert g[(1, 2022)].valor_anterior is None      # 2021 missing: no 2-year change
    assert g[(2, 2021)].crescimento_pct is None     # previous value 0
    s = wn.share_of_total(df, ["id"], "pop", digits=None).groupBy("id").agg(F.sum("participacao_pct").alias("t"))
    totals = {r.id: r.t for r in s.collect()}
    assert totals[1] == pytest.approx(100.0)


def test_single_value(spark):
    df = spark.createDataFrame([("a", "Norte"), ("a", "Norte"), ("b", "Sul"), ("b", "Norte"),
                                ("c", "Norte"), ("c", None)], "g string, r string")
    got = {r.g: r.v for r in df.groupBy("g").agg(agg.single_value("r").alias("v")).collect()}
    assert got == {"a": "Norte", "b": None, "c": None}
