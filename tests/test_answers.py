"""Operators on the input that used to give a wrong answer quietly."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indistar.operators import contracts as ct
from indistar.operators import joins as jn
from indistar.operators import reshape as rs
from indistar.sources import catalog as cat

C = ct.Contract("t", T.StructType([T.StructField("k", T.IntegerType()), T.StructField("d", T.DateType()),
                                      T.StructField("v", T.DecimalType(5, 2))]), key=["k"], foreign_keys=[(["k"], "dim", ["k"])])
D = dt.date


def test_contract_refuses_text_for_numbers_and_dates(spark):
    dim = {"dim": spark.createDataFrame([(1,)], "k int")}
    ct.assert_contract(C, spark.createDataFrame([(1, D(2020, 1, 1), 1.5)], "k int, d date, v double"), dim)
    with pytest.raises(ValueError, match="k is string.*d is string.*v is string"):
        ct.assert_contract(C, spark.createDataFrame([("1", "2020-01-01", "1.5")], "k string, d string, v string"), dim)


def test_foreign_key_needs_its_dimension(spark):
    df = spark.createDataFrame([(1, D(2020, 1, 1), 1.5)], "k int, d date, v double")
    for dims in (None, {}, {"other": df}):
        with pytest.raises(ValueError, match="dimension dim"):
            ct.violations(C, df, dims)


def test_pivot_refuses_two_values_in_a_cell(spark):
    rows = [(1, 10, 5.0), (1, 10, 5.0), (1, 10, None), (1, 20, 7.0), (2, 30, 1.0)]
    names, kind = {10: "a", 20: "b"}, "k int, id int, valor double"
    wide = rs.pivot_values(spark.createDataFrame(rows, kind), ["k"], "id", names)
    assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, wide.collect())) == [(1, 5.0, 7.0), (2, None, None)]
    two = spark.createDataFrame([*rows, (1, 10, 9.0)], kind)
    with pytest.raises(PySparkException, match="a: two values in one cell: 1"):
        rs.pivot_values(two, ["k"], "id", names).collect()
    assert {r.a for r in rs.pivot_values(two, ["k"], "id", names, conflict="max").collect()} == {9.0, None}


def test_window_join_keeps_series_apart(spark):
    """Two series with windows of their own: two facts give two rows."""
    bounds = spark.createDataFrame([("x", D(2000, 1, 1), D(2009, 6, 30)), ("y", D(2001, 5, 5), D(2004, 5, 4))], "s string, inicio date, fim date")
    fact = spark.createDataFrame([("x", D(2003, 7, 1)), ("y", D(2003, 7, 1)), ("x", D(2010, 1, 1)), ("z", D(2003, 7, 1))], "s string, dia date")
    got = jn.window_join(fact, "dia", bounds, ["s"], 3)
    assert sorted(map(tuple, got.collect())) == [("x", D(2003, 7, 1), 1, D(2003, 1, 1), D(2005, 12, 31)),
                                                ("y", D(2003, 7, 1), 0, D(2001, 5, 5), D(2004, 5, 4))]
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("start", [D(2000, 2, 29), D(1999, 1, 31), D(2001, 3, 1), D(2000, 12, 31)])
@pytest.mark.parametrize("years", [1, 3, 4])
def test_every_day_has_its_window(spark, start, years):
    end = D(2013, 5, 5)
    bounds = spark.createDataFrame([("x", start, end)], "s string, inicio date, fim date")
    days = bounds.select("s", F.explode(F.sequence("inicio", "fim")).alias("dia"))
    table = {r.janela: (r.janela_inicio, r.janela_fim) for r in cat.window_table(bounds, years=years, keys=["s"]).collect()}
    got = jn.window_join(days, "dia", bounds, ["s"], years).collect()
    assert len(got) == (end - start).days + 1
    assert all((r.janela_inicio, r.janela_fim) == table[r.janela] and r.janela_inicio <= r.dia <= r.janela_fim for r in got)


def test_calendar_of_a_mistyped_year_fails(spark):
    from indistar.plans.datasets import calendar_for
    days = lambda *d: spark.createDataFrame([(x,) for x in d], "d date")
    assert calendar_for(days(D(2020, 5, 1), D(2021, 2, 1), None), "d").count() == 366 + 365
    assert calendar_for(days(None), "d").count() == 0 and calendar_for(days(), "d").count() == 0
    with pytest.raises(PySparkException, match="2020 to 9999 is more than 400 years"):
        calendar_for(days(D(2020, 5, 1), D(9999, 1, 1)), "d").collect()
