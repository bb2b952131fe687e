import datetime as dt

from pyspark.sql import functions as F

from indistar.functions import parsing as fp
from indistar.functions import periods as fd


def _one_col(spark, values, expr_fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr_fn(F.col("x"))).collect()]


def test_parse_number_tokens(spark):
    vals = ["4814760", "1.7", "1,5", "...", "-", " 12 ", "-3,5", "1.234,56", None, "+4", "", "1e5"]
    got = _one_col(spark, vals, fp.parse_number)
    assert got == [4814760.0, 1.7, 1.5, None, None, 12.0, -3.5, None, None, 4.0, None, None]


def test_parse_decimal_lenient(spark):
    got = _one_col(spark, ["13,75", "1.234,56", "", None, "0.043739"], lambda c: fp.parse_decimal(c, 20, 8))
    assert [None if g is None else float(g) for g in got] == [13.75, None, None, None, 0.043739]


def test_state_suffix_and_prefix(spark):
    got = _one_col(spark, ["Sao Paulo - SP", "Embu-Guacu - SP", "Brasilia-DF", "Sem sufixo"], fp.strip_state_suffix)
    assert got == ["Sao Paulo", "Embu-Guacu", "Brasilia", "Sem sufixo"]
    assert _one_col(spark, ["3550308", "1", None], fp.code_prefix) == [35, 1, None]


def test_leading_number_and_bands(spark):
    labels = ["0 a 4 anos", "15 a 19 anos", "100 anos ou mais", "Menos de 1 ano", "Total", None]
    assert _one_col(spark, labels, fp.leading_number) == [0, 15, 100, None, None, None]
    bands = _one_col(spark, labels, lambda c: fp.age_band(fp.leading_number(c)))
    # a label without a leading number falls to the last band, as published
    assert bands == ["0 a 14 anos", "15 a 29 anos", "60 anos ou mais", "60 anos ou mais",
                     "60 anos ou mais", "60 anos ou mais"]
    marked = _one_col(spark, labels, lambda c: fp.age_band(fp.leading_number(c), unknown_label="?"))
    assert marked[3:] == ["?", "?", "?"]


def test_group_label_rules(spark):
    df = spark.createDataFrame([(7169, "Indice geral"), (7170, "1.Alimentacao e bebidas"),
                                (7445, "2.  Habitacao"), (7486, "Sem numero")], "id int, rotulo string")
    rows = df.select(fp.group_name("rotulo", "id").alias("n"), fp.group_order("rotulo", "id").alias("o")).collect()
    assert [(r.n, r.o) for r in rows] == [("Índice geral", 0), ("Alimentacao e bebidas", 1),
                                          ("Habitacao", 2), ("Sem numero", None)]


def test_region_color(spark):
    got = _one_col(spark, ["Norte", "Sul", "Outra", None], fp.region_color)
    assert got == ["#eb6834", "#1baf7a", "#898781", "#898781"]


def test_periods(spark):
    df = spark.createDataFrame([("2021",), ("abcd",)], "p string")
    r = df.select(*[v.alias(k) for k, v in fd.annual_period("p").items()]).collect()
    assert (r[0].ano, r[0].data_referencia) == (2021, dt.date(2021, 1, 1))
    assert (r[1].ano, r[1].data_referencia) == (None, None)
    m = spark.createDataFrame([("202402",), ("202413",)], "p string")
    r = m.select(*[v.alias(k) for k, v in fd.monthly_period("p").items()]).collect()
    assert r[0].data_referencia == dt.date(2024, 2, 1) and r[1].data_referencia is None
    q = spark.createDataFrame([("202102",), ("202104",), ("202105",)], "p string")
    r = q.select(*[v.alias(k) for k, v in fd.quarterly_period("p").items()]).collect()
    assert [x.data_referencia for x in r] == [dt.date(2021, 4, 1), dt.date(2021, 10, 1), None]
    assert r[0].trimestre == "2º trimestre"


def test_parse_day(spark):
    got = _one_col(spark, ["01/02/2020", "31/02/2020", "junk", None], fd.parse_day)
    assert got == [dt.date(2020, 2, 1), None, None, None]


def test_calendar_columns(spark):
    df = spark.createDataFrame([(dt.date(2021, 11, 5),)], "d date")
    r = df.select(*[v.alias(k) for k, v in fd.calendar_columns("d").items()]).first()
    assert (r.ano, r.month_no, r.mes, r.quarter_no, r.trimestre, r.dia) == (2021, 11, "November", 4, "Qtr 4", 5)
