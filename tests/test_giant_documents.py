"""One document with very many series is flattened by many tasks."""

import json

from pyspark.sql import functions as F

from indistar.operators import flatten as fl
from indistar.plans import reports as rp
from indistar.sources import readers as rd

PLACES, PERIODS = 5_571, 4


def _document(path, repeated=False):
    series = [{"localidade": {"id": str(7 if repeated else i), "nivel": {"id": "N6", "nome": "M"}, "nome": f"p{i}"},
               "serie": {str(2000 + k): str(i * k) for k in range(PERIODS)}} for i in range(PLACES)]
    path.write_text(json.dumps([{"id": "1", "variavel": "v", "unidade": "u", "resultados": [
        {"classificacoes": [], "series": series}, {"classificacoes": [], "series": []}, {"classificacoes": [], "series": None}]}]))
    return str(path)


def test_series_of_one_result_spread_over_tasks(spark, tmp_path):
    for repeated in (False, True):  # all series of one place: the number tells them apart
        raw = rd.read_nested(spark, _document(tmp_path / f"{repeated}.json", repeated), with_file=False)
        one, many = fl.flatten_nested(raw), fl.flatten_nested(raw, spread=16)
        assert one.rdd.getNumPartitions() == 1
        sizes = [r["count"] for r in many.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 16 and max(sizes) < 2 * PLACES * PERIODS / 16 and sum(sizes) == PLACES * PERIODS
        assert many.columns == fl.LONG_COLUMNS
        plain = [c for c in fl.LONG_COLUMNS if c != "classificacoes"]
        assert many.select(plain).exceptAll(one.select(plain)).isEmpty() and one.count() == many.count()


def test_spread_as_the_session_says(spark, tmp_path):
    raw = rd.read_nested(spark, _document(tmp_path / "d.json"), with_file=False)
    long = fl.flatten_nested(raw, spread=True)
    assert long.count() == PLACES * PERIODS
    assert "REPARTITION_BY_COL" in long._jdf.queryExecution().executedPlan().toString()


def test_matrix_counts_travel_in_the_same_grouping_sets(spark):
    """The fact is aggregated once, sort measure and all."""
    f = spark.range(1000).select(
        F.concat(F.lit("a"), (F.col("id") % 3).cast("string")).alias("area_ipca"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("grupo_ipca"),
        F.when(F.col("id") % 11 > 0, F.lit(2020) + (F.col("id") % 2)).cast("int").alias("ano"),
        F.col("id").cast("double").alias("acumulado_12_meses_pct"))
    assert rp.matrix_years({"ipca_area_mes": f}) == [2020, 2021]
    m = rp.cpi_matrix({"ipca_area_mes": f}, [2020, 2021])
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Range (") == 1 and "Join" not in plan
    rows = [tuple(r) for r in m.collect()]
    data = [(f"a{i % 3}", f"g{i % 7}" if i % 7 else None, 2020 + i % 2 if i % 11 else None, float(i)) for i in range(1000)]

    def least(area, group, year, level):
        got = [v for a, g, y, v in data if y == year and (level == 3 or a == area) and (level > 0 or g == group)]
        return min(got, default=None)
    count = lambda a, g=None, all_=True: sum(1 for x in data if x[0] == a and x[1] is not None and (all_ or x[1] == g))
    assert len(rows) == 3 * 7 + 3 + 1
    for level, area, group, *cells in rows:
        assert cells == [least(area, group, y, level) for y in (2020, 2021)]
    areas = list(dict.fromkeys(r[1] for r in rows if r[0] < 3))
    assert areas == sorted(areas, key=lambda a: (-count(a), a)) and rows[-1][0] == 3
    for a in areas:
        groups = [r[2] for r in rows if r[0] == 0 and r[1] == a]
        assert groups == sorted(groups, key=lambda g: (-count(a, g, False), g is None, g or ""))
