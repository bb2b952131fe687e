"""The library's operators applied to the driver's TESTDATA star schema.

Each query reads whole tables (``{sf_dir}/{table}.parquet``) and maps the
indicator semantics onto them: customers play municipalities, nations play
states, regions play regions, order dates play reference periods and order
counts play populations.  ``ORACLE_SQL`` holds the same computation as
DuckDB SQL over the same tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parsing as fp
from ..functions import periods as fd
from ..operators import aggregates as agg
from ..operators import commits as cm
from ..operators import contracts as ct
from ..operators import flatten as fl
from ..operators import joins as jn
from ..operators import publish as pb
from ..operators import reshape as rs
from ..operators import windows as wn
from ..sources import catalog as cat
from ..sources import readers as rd
from ..sources import snapshots as sn
from ..sources.intake import take_in
from ..sources.schemas import FLAT_ITEM_SCHEMA
from ..session import checkpoint_dir
from . import datasets as ds
from . import jobs
from . import reports as rp

# Fixed parameters of the report queries over TESTDATA.
REPORT_YEARS = [1996, 1997, 1998, 1999, 2000]
MATRIX_YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]
SLICER_REGION = "AMERICA"
# State codes of TESTDATA nations on the population page (two digits).
STATE_CODE_OFFSET = 10
PAGE_YEARS = [1998]
PIVOT_TYPES = {"click": "click_max", "purchase": "purchase_max",
               "view": "view_max", "signup": "signup_max"}
# Order status -> (sex id, sex label); every order also counts in "Total".
SEX_OF_STATUS = {"F": ("4", "Homens"), "O": ("5", "Mulheres")}
SEX_TOTAL = ("6794", "Total")
# Priority digit -> (age class id, age label).
AGE_OF_PRIORITY = {"1": ("93070", "0 a 4 anos"), "2": ("93087", "15 a 19 anos"),
                   "3": ("93091", "35 a 39 anos"), "4": ("93096", "60 a 64 anos"),
                   "5": ("60040", "Menos de 1 ano")}
# Event types playing the four value classes of a national-accounts table.
PERSON_TYPES = ["signup", "click"]
MONEY_TYPES = ["purchase"]
PERCENT_TYPES = ["view", "error"]
# Event series catalog: (serie, serie_id, indicador, unidade, periodicidade).
EVENT_SERIES = [
    ("click", 1, "Cliques", "eventos", "diaria"),
    ("error", 2, "Erros", "eventos", "diaria"),
    ("purchase", 3, "Compras", "USD", "diaria"),
    ("signup", 4, "Cadastros", "eventos", "diaria"),
    ("view", 5, "Visualizacoes", "eventos", "diaria"),
]
DATE_RANGE = ("1996-03-01", "1997-06-30")
UPSERT_TARGET_BEFORE = "1999-01-01"
UPSERT_UPDATES_FROM = "1998-01-01"
UPSERT_YEAR = 1997
# Day from which the second (re-)extraction of the event series starts.
SECOND_EXTRACTION_FROM = "2024-01-16"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _year_span_filter(col: str, years: list[int]):
    """Exact year membership plus a range bound Parquet can prune on."""
    lo, hi = min(years), max(years)
    return ((F.col(col) >= F.lit(f"{lo}-01-01").cast("timestamp"))
            & (F.col(col) < F.lit(f"{hi + 1}-01-01").cast("timestamp"))
            & F.year(col).isin(years))


# ---------------------------------------------------------------- parsing --

def _acctbal_text(c="c_acctbal", seg="c_mktsegment"):
    """Locale-formatted balance text with junk and thousands-separated tokens."""
    return (F.when(F.col(seg) == "HOUSEHOLD", F.lit("..."))
            .when(F.col(seg) == "MACHINERY",
                  F.translate(F.format_number(F.col(c), 2), ",.", ".,"))
            .otherwise(F.regexp_replace(F.format_string("%.2f", F.col(c)), r"\.", ",")))


def parse_number(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey", _acctbal_text().alias("texto"))
    return c.select("c_custkey", "texto", fp.parse_number("texto").alias("valor"))


def parse_decimal(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey", _acctbal_text().alias("texto"))
    return (c.select("c_custkey", fp.parse_decimal("texto", 20, 8).alias("valor"))
            .filter(F.col("valor").isNotNull()))


def parse_day(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    text = (F.when(F.col("o_orderstatus") == "P",
                   F.concat(F.lit("31/02/"), F.year("o_orderdate").cast("string")))
            .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")))
    d = o.select("o_orderkey", fd.parse_day(text).alias("data_referencia"))
    parts = fd.year_month_small("data_referencia")
    return (d.filter(F.col("data_referencia").isNotNull())
            .select("o_orderkey", "data_referencia", parts["ano"].alias("ano"), parts["mes"].alias("mes")))


def _period_totals(o: DataFrame, period_cols: dict, keys: list[str]) -> DataFrame:
    return (o.select(*[v.alias(k) for k, v in period_cols.items()], "o_totalprice")
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_pedidos"),
                 F.round(F.sum("o_totalprice"), 2).alias("total")))


def period_year(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    p = fd.annual_period(F.year("o_orderdate").cast("string"))
    return _period_totals(o, p, ["data_referencia", "ano"])


def period_month(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    p = fd.monthly_period(F.date_format("o_orderdate", "yyyyMM"))
    return _period_totals(o, p, ["data_referencia", "ano", "mes"])


def period_quarter(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    code = F.concat(F.year("o_orderdate").cast("string"),
                    F.lpad(F.quarter("o_orderdate").cast("string"), 2, "0"))
    p = fd.quarterly_period(code)
    return _period_totals(o, p, ["data_referencia", "ano", "trimestre_num", "trimestre"])


def strip_suffix(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    place = F.concat("c_name", F.lit(" - "), F.upper(F.substring("c_mktsegment", 1, 2)))
    place_id = F.col("c_custkey").cast("string")
    return c.select("c_custkey",
                    fp.strip_state_suffix(place).alias("municipio_nome"),
                    fp.code_prefix(place_id, 2).alias("uf_id"))


def group_label(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    label = F.regexp_replace("o_orderpriority", "-", ".")
    g = o.select(label.alias("rotulo"))
    g = g.withColumn("grupo_id", F.lit(fp.GENERAL_INDEX_ID - 1) + fp.leading_number("rotulo"))
    return (g.groupBy("grupo_id", "rotulo").agg(F.count(F.lit(1)).alias("n"))
            .select("grupo_id",
                    fp.group_name("rotulo", "grupo_id").alias("grupo"),
                    fp.group_order("rotulo", "grupo_id").alias("grupo_ordem"), "n"))


def macro_band(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    label = (F.when(F.col("p_size") < 5, F.concat(F.lit("Menos de "), F.col("p_size").cast("string"), F.lit(" anos")))
             .otherwise(F.concat(F.col("p_size").cast("string"), F.lit(" a "),
                                 (F.col("p_size") + 4).cast("string"), F.lit(" anos"))))
    f = p.select(label.alias("faixa_etaria"))
    f = f.withColumn("faixa_etaria_ordem", fp.leading_number("faixa_etaria"))
    return (f.withColumn("faixa_macro", fp.age_band("faixa_etaria_ordem"))
            .groupBy("faixa_etaria", "faixa_etaria_ordem", "faixa_macro")
            .agg(F.count(F.lit(1)).alias("n_partes")))


# ----------------------------------------------------- nested / flattening --

def _nested_orders(spark, sf_dir) -> DataFrame:
    """Orders re-shaped, row by row, into nested indicator documents.

    Low-priority orders carry an empty result list (they vanish when
    flattened); every series carries two periods, one of them a junk token.
    """
    o = _t(spark, sf_dir, "orders")
    price_text = F.format_string("%.2f", F.col("o_totalprice"))
    classes = F.array(
        F.struct(F.lit("prio").alias("id"), F.lit("prioridade").alias("nome"),
                 F.create_map(F.substring("o_orderpriority", 1, 1), F.col("o_orderpriority")).alias("categoria")),
        F.struct(F.lit("cli").alias("id"), F.lit("cliente").alias("nome"),
                 F.create_map(F.col("o_custkey").cast("string"), F.lit("cliente")).alias("categoria")))
    place = F.struct(F.col("o_orderkey").cast("string").alias("id"),
                     F.struct(F.lit("N9").alias("id"), F.lit("Pedido").alias("nome")).alias("nivel"),
                     F.concat(F.lit("Pedido "), F.col("o_orderkey").cast("string")).alias("nome"))
    serie = F.create_map(F.date_format("o_orderdate", "yyyyMM"), price_text,
                         F.date_format("o_orderdate", "yyyy"), F.lit("..."))
    result = F.struct(classes.alias("classificacoes"),
                      F.array(F.struct(place.alias("localidade"), serie.alias("serie"))).alias("series"))
    # an empty list of the same element type: filter everything out
    empty = F.filter(F.array(result), lambda x: F.lit(False))
    results = F.when(F.col("o_orderpriority") == "5-LOW", empty).otherwise(F.array(result))
    return o.select(F.ascii("o_orderstatus").cast("string").alias("id"),
                    F.concat(F.lit("status "), F.col("o_orderstatus")).alias("variavel"),
                    F.lit("USD").alias("unidade"),
                    results.alias("resultados"))


def nested_flatten(spark, sf_dir):
    long = fl.flatten_nested(_nested_orders(spark, sf_dir))
    prio = fl.category_of("classificacoes", "prio")
    missing = fl.category_of("classificacoes", "nao_existe")
    return long.select(*[c for c in fl.LONG_COLUMNS if c != "classificacoes"],
                       prio["key"].alias("prio_chave"), prio["value"].alias("prio_nome"),
                       missing["key"].alias("sem_chave"))


def category_lookup(spark, sf_dir):
    """First matching classification -> first (id, label) of its categories,
    for a present ('cli'), a second present ('prio') and an absent id."""
    long = fl.flatten_nested(_nested_orders(spark, sf_dir))
    cli = fl.category_of("classificacoes", "cli")
    prio = fl.category_of("classificacoes", "prio")
    none = fl.category_of("classificacoes", "inexistente")
    return long.select("localidade_id", "periodo", cli["key"].alias("cliente_id"), cli["value"].alias("cliente_nome"),
                       prio["key"].alias("prio_id"), none["value"].alias("sem_valor"))


def catalog_profile(spark, sf_dir):
    return fl.catalog_profile(_nested_orders(spark, sf_dir))


def map_flatten(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    m = e.select("event_id", F.from_json("props", "map<string,string>").alias("props"))
    out = fl.map_entries_long(m, "props", "chave", "valor_original", keep=["event_id"])
    return out.withColumn("valor", fp.parse_number("valor_original"))


# ------------------------------------------------------- split / union ----

def _event_long(spark, sf_dir) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", F.col("event_type").alias("variavel"),
                    F.to_date("ts").alias("data_referencia"), F.col("value").alias("valor"))


def _split(spark, sf_dir, which):
    classes = {"pessoas": (PERSON_TYPES, "valor_pessoas", "bigint"),
               "financeiro": (MONEY_TYPES, "valor_financeiro", "decimal(20,2)"),
               "percentual": (PERCENT_TYPES, "valor_percentual", "decimal(10,2)")}
    parts = rs.split_by_class(_event_long(spark, sf_dir), "variavel", classes,
                              keep=["event_id", "variavel", "data_referencia"])
    return parts[which]


def split_persons(spark, sf_dir):
    return _split(spark, sf_dir, "pessoas")


def split_money(spark, sf_dir):
    return _split(spark, sf_dir, "financeiro")


def split_percent(spark, sf_dir):
    return _split(spark, sf_dir, "percentual")


def union_series(spark, sf_dir):
    """Daily-series recipe over events: text day + comma value -> typed series."""
    e = _t(spark, sf_dir, "events")
    catalog = spark.createDataFrame(
        EVENT_SERIES, "serie string, serie_id int, indicador string, unidade string, periodicidade string")
    raw = e.select(F.col("event_type").alias("serie"),
                   F.date_format("ts", "dd/MM/yyyy").alias("data"),
                   F.regexp_replace(F.format_string("%.2f", F.col("value")), r"\.", ",").alias("valor"),
                   "ts", "event_id")
    typed = (jn.attach_dimension(raw, catalog, "serie", "inner")
             .withColumn("data_referencia", fd.parse_day("data"))
             .withColumn("valor", fp.parse_decimal("valor", 20, 8))
             .filter(F.col("data_referencia").isNotNull() & F.col("valor").isNotNull()))
    last = rs.dedup_keep_last(typed.select("serie_id", "serie", "indicador", "unidade", "periodicidade",
                                           "data_referencia", "valor", "ts", "event_id"),
                              ["serie_id", "data_referencia"], ["ts", "event_id"])
    parts = fd.year_month_small("data_referencia")
    return last.select("serie_id", "serie", "indicador", "unidade", "periodicidade", "data_referencia",
                       parts["ano"].alias("ano"), parts["mes"].alias("mes"), "valor")


def constant_cols(spark, sf_dir):
    """Constant per-series columns attached from a broadcast catalog."""
    e = _t(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("serie"))
    catalog = spark.createDataFrame(
        EVENT_SERIES, "serie string, serie_id int, indicador string, unidade string, periodicidade string")
    return jn.attach_dimension(e, catalog, "serie", "left").select(
        "event_id", "serie", "serie_id", "indicador", "unidade", "periodicidade")


def pivot_long_wide(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("dia"), "event_type", "value")
    return rs.pivot_values(e, ["user_id", "dia"], "event_type", PIVOT_TYPES, "value", conflict="max")


def dedup_last(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("dia"),
                                           "ts", "event_id", "event_type", "value")
    return rs.dedup_keep_last(e, ["user_id", "dia"], ["ts", "event_id"]).drop("ts")


# ------------------------------------------------------------- profiles ---

def dup_key_report(spark, sf_dir):
    return agg.duplicate_key_summary(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def null_profile(spark, sf_dir):
    return agg.null_profile(pivot_long_wide(spark, sf_dir))


def range_summary(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("dia"))
    return agg.range_summary(e, ["event_type"], "dia")


def value_list(spark, sf_dir):
    return agg.value_list(_t(spark, sf_dir, "region"), "r_name")


def value_list_year(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("ano"))
    return agg.value_list(o, "ano")


def row_counts(spark, sf_dir):
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    return agg.row_counts({n: _t(spark, sf_dir, n) for n in names})


def file_profile(spark, sf_dir):
    li = (_t(spark, sf_dir, "lineitem")
          .select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag",
                  F.col("_metadata.file_name").alias("arquivo")))
    return agg.file_profile(li, ["l_orderkey", "l_linenumber"])


ORDERS_CONTRACT = ct.Contract(
    name="pedidos",
    schema=T.StructType([
        T.StructField("o_orderkey", T.LongType(), False),
        T.StructField("o_custkey", T.LongType(), False),
        T.StructField("data_referencia", T.DateType(), False),
        T.StructField("ano", T.IntegerType(), False),
        T.StructField("mes", T.IntegerType(), False),
        T.StructField("o_orderpriority", T.StringType(), False),
        T.StructField("o_totalprice", T.DecimalType(7, 2), True),
    ]),
    key=["o_orderkey"],
    not_null=["o_orderkey", "o_custkey", "data_referencia", "ano", "mes", "o_orderpriority"],
    foreign_keys=[(["o_custkey"], "customer", ["c_custkey"])],
    year_of_date=("ano", "data_referencia"),
    ranges={"mes": (1, 12)},
    max_length={"o_orderpriority": 8},
)


def contract_checks(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    fact = o.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("data_referencia"),
                    F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes"),
                    "o_orderpriority", "o_totalprice")
    return ct.violations(ORDERS_CONTRACT, fact, {"customer": _t(spark, sf_dir, "customer")})


# -------------------------------------------------------- star / reports ---

def _nation_region(spark, sf_dir) -> DataFrame:
    # nation and region have 25 and 5 rows at every scale factor (fixed by
    # the schema, like the 27-state dimension): broadcast without a check
    n = _t(spark, sf_dir, "nation")
    r = _t(spark, sf_dir, "region")
    return jn.attach_dimension(n, r.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey", "inner")


def _customer_geo(spark, sf_dir) -> DataFrame:
    """customer -> nation -> region.  The customer table grows with the data,
    so it is never broadcast by hint; only the 25-row nation/region side is."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nr = _nation_region(spark, sf_dir).withColumnRenamed("n_nationkey", "c_nationkey")
    return jn.attach_dimension(c, nr, "c_nationkey", "inner")


def _orders_per_customer(spark, sf_dir, *aggs) -> DataFrame:
    """Aggregate orders per customer BEFORE joining the customer table.

    Combining map-side first shrinks the big join input and takes the skew
    of a hot customer out of the join.
    """
    o = _t(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(*aggs)


def star_region_sum(spark, sf_dir):
    per_c = _orders_per_customer(spark, sf_dir, F.sum("o_totalprice").alias("t"))
    j = per_c.join(_customer_geo(spark, sf_dir), "c_custkey", "inner")
    out = j.groupBy("r_name").agg(F.round(F.sum("t"), 2).alias("total"))
    return rs.order_by_measure(out, "total", ["r_name"])


def avg_by_group(spark, sf_dir):
    per_c = _orders_per_customer(spark, sf_dir, F.count(F.lit(1)).alias("n_pedidos"))
    j = per_c.join(_customer_geo(spark, sf_dir), "c_custkey", "inner")
    out = j.groupBy("n_name").agg(F.round(F.avg("n_pedidos"), 4).alias("media_pedidos"))
    return rs.order_by_measure(out, "media_pedidos", ["n_name"])


def count_nonnull(spark, sf_dir):
    per_c = _orders_per_customer(spark, sf_dir, F.count(F.year("o_orderdate")).alias("k"))
    j = per_c.join(_customer_geo(spark, sf_dir), "c_custkey", "inner")
    out = j.groupBy("n_name").agg(F.sum("k").alias("n_anos"))
    return rs.order_by_measure(out, "n_anos", ["n_name"])


def two_key_count(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    per = (o.groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("ano"))
           .agg(F.count(F.lit(1)).alias("k")))
    j = per.join(_customer_geo(spark, sf_dir), "c_custkey", "inner")
    out = j.groupBy("ano", "r_name").agg(F.sum(F.when(F.col("c_nationkey").isNotNull(), F.col("k"))).alias("n_estados"))
    return out.orderBy("ano", "r_name")


def filter_propagation(spark, sf_dir):
    r = _t(spark, sf_dir, "region").filter(F.col("r_name") == SLICER_REGION)
    n = _t(spark, sf_dir, "nation")
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    nations = jn.keep_matching(n, r.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey", broadcast=True)
    customers = jn.keep_matching(c, nations.select(F.col("n_nationkey").alias("c_nationkey")), "c_nationkey",
                                 broadcast=True)
    return jn.keep_matching(o, customers.select(F.col("c_custkey").alias("o_custkey")), "o_custkey")


def avg_of_avgs(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    x = o.select("o_orderpriority", fd.quarterly_period(
        F.concat(F.year("o_orderdate").cast("string"), F.lpad(F.quarter("o_orderdate").cast("string"), 2, "0"))
    )["trimestre"].alias("trimestre"), "o_totalprice")
    out = agg.avg_of_avgs(x, ["o_orderpriority"], "trimestre", "o_totalprice")
    return rs.order_by_measure(out.withColumn("media", F.round("media", 2)), "media", ["o_orderpriority"])


def avg_of_avgs_by_year(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").filter(_year_span_filter("o_orderdate", REPORT_YEARS))
    x = o.select(F.year("o_orderdate").alias("ano"), "o_orderpriority",
                 F.concat(F.quarter("o_orderdate").cast("string"), F.lit(fd.QUARTER_LABEL_SUFFIX)).alias("trimestre"),
                 "o_totalprice")
    out = agg.avg_of_avgs(x, ["ano", "o_orderpriority"], "trimestre", "o_totalprice")
    return out.withColumn("media", F.round("media", 2)).orderBy("ano", "o_orderpriority")


def _customer_year_counts(spark, sf_dir) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    return (o.groupBy("o_custkey", F.year("o_orderdate").alias("ano"))
            .agg(F.count(F.lit(1)).alias("n_pedidos")))


def lag_growth(spark, sf_dir):
    return wn.previous_period_change(_customer_year_counts(spark, sf_dir), ["o_custkey"], "ano", "n_pedidos")


def year_summary(spark, sf_dir):
    g = lag_growth(spark, sf_dir)
    out = agg.year_summary(g, "ano", "n_pedidos", "crescimento_pct", "variacao_absoluta", "o_custkey")
    return out.withColumn("crescimento_medio_pct", F.round("crescimento_medio_pct", 4))


def report_cards(spark, sf_dir):
    """Card measures over the whole growth table: mean growth, total change,
    total and entity count."""
    g = lag_growth(spark, sf_dir)
    return g.agg(F.round(F.avg("crescimento_pct"), 4).alias("crescimento_medio_pct"),
                 F.sum("variacao_absoluta").alias("variacao_absoluta_total"),
                 F.sum("n_pedidos").alias("total"),
                 F.count_distinct("o_custkey").alias("qtd_entidades"))


def share_of_total(spark, sf_dir):
    per = (_t(spark, sf_dir, "orders")
           .groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
           .agg(F.count(F.lit(1)).alias("k")))
    j = per.join(_customer_geo(spark, sf_dir), "c_custkey", "inner")
    cells = j.groupBy("n_name", "o_orderpriority").agg(F.sum("k").alias("n_pedidos"))
    return wn.share_of_total(cells, ["n_name"], "n_pedidos")


def matrix_rollup(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"),
                                           F.year("o_orderdate").alias("ano"), "o_totalprice")
    # pre-aggregate per (customer, year): min is decomposable
    per = o.groupBy("c_custkey", "ano").agg(F.min("o_totalprice").alias("m"))
    j = per.join(_customer_geo(spark, sf_dir), "c_custkey", "inner")
    return agg.matrix(j, "r_name", "n_name", "ano", "m", MATRIX_YEARS, "min")


def date_drill(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    return agg.date_drill(o, "o_orderdate", [F.count(F.lit(1)).alias("n_pedidos"),
                                            F.round(F.sum("o_totalprice"), 2).alias("total")])


def date_drill_day(spark, sf_dir):
    """All four levels of the hierarchy, down to the day."""
    o = _t(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    return agg.date_drill(o, "o_orderdate", [F.count(F.lit(1)).alias("n_pedidos"),
                                            F.round(F.sum("o_totalprice"), 2).alias("total")], depth=4)


def single_value(spark, sf_dir):
    per = (_t(spark, sf_dir, "orders")
           .groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("ano"))
           .agg(F.count(F.lit(1)).alias("k")))
    j = per.join(_customer_geo(spark, sf_dir), "c_custkey", "inner")
    out = (j.groupingSets([["n_name"], ["ano"]], "n_name", "ano")
           .agg(agg.single_value("r_name").alias("regiao"),
                F.grouping_id("n_name", "ano").alias("nivel")))
    return out.withColumn("cor", fp.region_color("regiao"))


def calendar(spark, sf_dir):
    return ds.calendar_for(_t(spark, sf_dir, "orders"), "o_orderdate")


def date_part_join(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("ts", "value")
    cal = ds.calendar_for(e, "ts")
    j = jn.calendar_join(e, "ts", cal, "data")
    return (j.groupBy("ano", "month_no", "mes", "trimestre")
            .agg(F.count(F.lit(1)).alias("n_eventos"), F.round(F.sum("value"), 2).alias("soma_valor")))


def _order_bounds(spark, sf_dir) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    return o.agg(F.to_date(F.min("o_orderdate")).alias("inicio"), F.to_date(F.max("o_orderdate")).alias("fim"))


def window_table(spark, sf_dir):
    return cat.window_table(_order_bounds(spark, sf_dir), years=3)


def window_coverage(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    w = cat.window_table(_order_bounds(spark, sf_dir), years=3)
    j = jn.range_join(o, F.col("d"), w)
    return j.groupBy("janela", "janela_inicio", "janela_fim").agg(F.count(F.lit(1)).alias("n_pedidos"))


def window_coverage_series(spark, sf_dir):
    """Orders per priority in two-year windows of the priority's own span: the
    join is on the priority, the window number is arithmetic."""
    o = _t(spark, sf_dir, "orders").select("o_orderpriority", F.to_date("o_orderdate").alias("dia"))
    bounds = o.groupBy("o_orderpriority").agg(F.min("dia").alias("inicio"), F.max("dia").alias("fim"))
    per_day = o.groupBy("o_orderpriority", "dia").agg(F.count(F.lit(1)).alias("k"))  # a hot priority has few days
    return jn.window_join(per_day, "dia", bounds, ["o_orderpriority"], 2).groupBy(
        "o_orderpriority", "janela", "janela_inicio", "janela_fim").agg(F.sum("k").alias("n_pedidos"))


def _population_documents(spark, sf_dir, state_coded: bool = False) -> DataFrame:
    """Orders per customer and year as nested population documents.

    One variable element per customer whose only series maps each year to
    the customer's order count; the map holds one entry per year of the
    span, however many orders the customer has.  With ``state_coded`` the
    place id is a municipality code whose first two digits are the state:
    ``nation + 10`` followed by the customer key in at least 7 digits.
    """
    o = _t(spark, sf_dir, "orders")
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment",
                                             "c_nationkey")
    per = (o.groupBy("o_custkey", F.year("o_orderdate").cast("string").alias("periodo"))
           .agg(F.count(F.lit(1)).cast("string").alias("valor")))
    series = per.groupBy("o_custkey").agg(
        F.map_from_entries(F.collect_list(F.struct("periodo", "valor"))).alias("serie"))
    docs = series.join(c, "o_custkey", "inner")
    place_id = (F.concat(F.format_string("%02d", F.col("c_nationkey") + STATE_CODE_OFFSET),
                         F.format_string("%07d", F.col("o_custkey")))
                if state_coded else F.col("o_custkey").cast("string"))
    place = F.struct(place_id.alias("id"),
                     F.struct(F.lit("N6").alias("id"), F.lit("Municipio").alias("nome")).alias("nivel"),
                     F.concat("c_name", F.lit(" - "), F.upper(F.substring("c_mktsegment", 1, 2))).alias("nome"))
    result = F.struct(F.array().cast("array<struct<id:string,nome:string,categoria:map<string,string>>>")
                      .alias("classificacoes"),
                      F.array(F.struct(place.alias("localidade"), F.col("serie"))).alias("series"))
    return docs.select(F.lit("9324").alias("id"), F.lit("Populacao").alias("variavel"),
                       F.lit("Pessoas").alias("unidade"), F.array(result).alias("resultados"))


def population_recipe(spark, sf_dir):
    return ds.populacao_municipio(fl.flatten_nested(_population_documents(spark, sf_dir)))


def resumo_ano_recipe(spark, sf_dir):
    return ds.resumo_ano(population_recipe(spark, sf_dir))


def _unemployment_documents(spark, sf_dir) -> DataFrame:
    """Orders per nation and quarter as two nested quarterly indicators:
    4099 = number of orders, 4118 = urgent orders written with a decimal
    comma ("..." when there are none).  Each series map holds one entry per
    quarter of the span."""
    o = _t(spark, sf_dir, "orders")
    code = F.concat(F.year("o_orderdate").cast("string"), F.lpad(F.quarter("o_orderdate").cast("string"), 2, "0"))
    per_c = (o.groupBy(F.col("o_custkey").alias("c_custkey"), code.alias("periodo"))
             .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("u")))
    cells = (per_c.join(_customer_geo(spark, sf_dir), "c_custkey", "inner")
             .groupBy("c_nationkey", "n_name", "periodo").agg(F.sum("n").alias("n"), F.sum("u").alias("u")))
    urgent = F.when(F.col("u") == 0, F.lit("...")).otherwise(F.concat(F.col("u").cast("string"), F.lit(",0")))
    kv = F.explode(F.array(F.struct(F.lit("4099").alias("id"), F.col("n").cast("string").alias("valor")),
                           F.struct(F.lit("4118").alias("id"), urgent.alias("valor"))))
    long = cells.select("c_nationkey", "n_name", "periodo", kv.alias("kv"))
    series = (long.groupBy(F.col("kv.id").alias("id"), "c_nationkey", "n_name")
              .agg(F.map_from_entries(F.collect_list(F.struct("periodo", F.col("kv.valor")))).alias("serie")))
    place = F.struct(F.col("c_nationkey").cast("string").alias("id"),
                     F.struct(F.lit("N3").alias("id"), F.lit("UF").alias("nome")).alias("nivel"),
                     F.col("n_name").alias("nome"))
    result = F.struct(F.array().cast("array<struct<id:string,nome:string,categoria:map<string,string>>>")
                      .alias("classificacoes"),
                      F.array(F.struct(place.alias("localidade"), F.col("serie"))).alias("series"))
    return series.select("id", F.concat(F.lit("indicador "), F.col("id")).alias("variavel"),
                         F.lit("%").alias("unidade"), F.array(result).alias("resultados"))


def unemployment_recipe(spark, sf_dir):
    return ds.desemprego_uf_trimestre(fl.flatten_nested(_unemployment_documents(spark, sf_dir)))


def _state_dimension(spark, sf_dir, offset: int = 0) -> DataFrame:
    """TESTDATA's state dimension: nations as states (id ``nation + offset``),
    their regions as regions (25 rows at every scale factor)."""
    return _nation_region(spark, sf_dir).select(
        (F.col("n_nationkey") + offset).cast("int").alias("uf_id"), F.col("n_name").alias("uf_sigla"),
        F.col("n_name").alias("uf_nome"), F.col("r_name").alias("regiao"))


def _unemployment_model(spark, sf_dir) -> dict:
    return {"desemprego_uf_trimestre": unemployment_recipe(spark, sf_dir),
            "dim_uf": _state_dimension(spark, sf_dir)}


def unemployment_table_report(spark, sf_dir):
    """Q1 (the report function itself): year x state mean of per-quarter-label
    means over the report years, on the TESTDATA unemployment table."""
    out = rp.unemployment_table(_unemployment_model(spark, sf_dir), REPORT_YEARS)
    return out.withColumn("taxa_desemprego_media_anual", F.round("taxa_desemprego_media_anual", 4))


def unemployment_by_state_report(spark, sf_dir):
    """Q2 (the report function itself): per state over all quarters (labels
    carry no year, so each label's mean spans every year)."""
    out = rp.unemployment_by_state(_unemployment_model(spark, sf_dir))
    return out.withColumn("taxa_desemprego_media_anual", F.round("taxa_desemprego_media_anual", 4))


def unemployment_report_recipe(spark, sf_dir):
    out = agg.avg_of_avgs(unemployment_recipe(spark, sf_dir), ["ano", "uf_id"], "trimestre",
                          ["taxa_desocupacao_pct", "taxa_subutilizacao_pct"],
                          ["taxa_desemprego_media_anual", "taxa_desocupacao_media_anual"])
    return out.select("ano", "uf_id", F.round("taxa_desemprego_media_anual", 4).alias("taxa_desemprego_media_anual"),
                      F.round("taxa_desocupacao_media_anual", 4).alias("taxa_desocupacao_media_anual"))


def _cpi_documents(spark, sf_dir) -> DataFrame:
    """Orders per region, priority group and month as four nested monthly
    indicators with a group classification (id 315).  The group id is
    7168 + the priority digit, so priority 1 is the general index."""
    o = _t(spark, sf_dir, "orders")
    per_c = (o.groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderpriority",
                       F.date_format("o_orderdate", "yyyyMM").alias("periodo"))
             .agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(F.col("o_orderstatus") == "F").alias("f"),
                  F.count_if(F.col("o_orderstatus") == "O").alias("o"),
                  F.count_if(F.col("o_orderstatus") == "P").alias("p")))
    cells = (per_c.join(_customer_geo(spark, sf_dir), "c_custkey", "inner")
             .groupBy("n_regionkey", "r_name", "o_orderpriority", "periodo")
             .agg(*[F.sum(c).alias(c) for c in ["n", "f", "o", "p"]]))

    def txt(c, comma=False):
        base = F.col(c).cast("string")
        return F.when(F.col(c) == 0, F.lit("...")).otherwise(F.concat(base, F.lit(",0")) if comma else base)
    kv = F.explode(F.array(F.struct(F.lit("63").alias("id"), F.col("n").cast("string").alias("valor")),
                           F.struct(F.lit("69").alias("id"), txt("f").alias("valor")),
                           F.struct(F.lit("2265").alias("id"), txt("o").alias("valor")),
                           F.struct(F.lit("66").alias("id"), txt("p", comma=True).alias("valor"))))
    long = cells.select("n_regionkey", "r_name", "o_orderpriority", "periodo", kv.alias("kv"))
    series = (long.groupBy(F.col("kv.id").alias("id"), "n_regionkey", "r_name", "o_orderpriority")
              .agg(F.map_from_entries(F.collect_list(F.struct("periodo", F.col("kv.valor")))).alias("serie")))
    gid = (F.lit(fp.GENERAL_INDEX_ID - 1) + fp.leading_number("o_orderpriority")).cast("string")
    group = F.struct(F.lit("315").alias("id"), F.lit("grupo").alias("nome"),
                     F.create_map(gid, F.regexp_replace("o_orderpriority", "-", ".")).alias("categoria"))
    place = F.struct(F.col("n_regionkey").cast("string").alias("id"),
                     F.struct(F.lit("N7").alias("id"), F.lit("Area").alias("nome")).alias("nivel"),
                     F.col("r_name").alias("nome"))
    result = F.struct(F.array(group).alias("classificacoes"),
                      F.array(F.struct(place.alias("localidade"), F.col("serie"))).alias("series"))
    return series.select("id", F.concat(F.lit("indicador "), F.col("id")).alias("variavel"),
                         F.lit("%").alias("unidade"), F.array(result).alias("resultados"))


def cpi_recipe(spark, sf_dir):
    return ds.ipca_area_mes(fl.flatten_nested(_cpi_documents(spark, sf_dir)))


def cpi_matrix_report(spark, sf_dir):
    """Q7 (the report function itself) over the CPI table built from TESTDATA:
    area -> group rows with subtotals x year columns of the minimum."""
    return rp.cpi_matrix({"ipca_area_mes": cpi_recipe(spark, sf_dir)}, MATRIX_YEARS)


def _lookup(col, table: dict, part: int):
    expr = None
    for k, v in table.items():
        expr = F.when(col == k, F.lit(v[part])) if expr is None else expr.when(col == k, F.lit(v[part]))
    return expr


def _age_documents(spark, sf_dir) -> DataFrame:
    """Orders per nation, status ("sex"), priority ("age band") and year as
    nested documents with two classifications per result, plus the Total
    sex rows."""
    o = _t(spark, sf_dir, "orders")
    per_c = (o.groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderstatus",
                       F.substring("o_orderpriority", 1, 1).alias("prio"),
                       F.year("o_orderdate").cast("string").alias("periodo"))
             .agg(F.count(F.lit(1)).alias("n")))
    geo = per_c.join(_customer_geo(spark, sf_dir), "c_custkey", "inner")
    # per-sex cells and the Total cells in ONE aggregate (grouping sets):
    # one scan and one shuffle instead of two branches
    place_keys = ["c_nationkey", "n_name", "prio", "periodo"]
    both = (geo.groupingSets([[*place_keys, "o_orderstatus"], place_keys], *place_keys, "o_orderstatus")
            .agg(F.sum("n").alias("n"), F.grouping("o_orderstatus").alias("_total")))
    is_total = F.col("_total") == 1
    status = F.col("o_orderstatus")
    cells = (both.filter(is_total | status.isin(list(SEX_OF_STATUS)))
             .select("c_nationkey", "n_name",
                     F.when(is_total, F.lit(SEX_TOTAL[0])).otherwise(_lookup(status, SEX_OF_STATUS, 0)).alias("sid"),
                     F.when(is_total, F.lit(SEX_TOTAL[1])).otherwise(_lookup(status, SEX_OF_STATUS, 1)).alias("sname"),
                     "prio", "periodo", "n"))
    series = (cells.groupBy("c_nationkey", "n_name", "sid", "sname", "prio")
              .agg(F.map_from_entries(F.collect_list(F.struct("periodo", F.col("n").cast("string")))).alias("serie")))
    classes = F.array(
        F.struct(F.lit("2").alias("id"), F.lit("Sexo").alias("nome"),
                 F.create_map("sid", "sname").alias("categoria")),
        F.struct(F.lit("287").alias("id"), F.lit("Idade").alias("nome"),
                 F.create_map(_lookup(F.col("prio"), AGE_OF_PRIORITY, 0),
                              _lookup(F.col("prio"), AGE_OF_PRIORITY, 1)).alias("categoria")))
    place = F.struct(F.col("c_nationkey").cast("string").alias("id"),
                     F.struct(F.lit("N3").alias("id"), F.lit("UF").alias("nome")).alias("nivel"),
                     F.col("n_name").alias("nome"))
    result = F.struct(classes.alias("classificacoes"),
                      F.array(F.struct(place.alias("localidade"), F.col("serie"))).alias("series"))
    return series.select(F.lit("93").alias("id"), F.lit("Populacao residente").alias("variavel"),
                         F.lit("Pessoas").alias("unidade"), F.array(result).alias("resultados"))


def age_band_recipe(spark, sf_dir):
    return ds.faixa_etaria_uf(fl.flatten_nested(_age_documents(spark, sf_dir)))


def age_share_recipe(spark, sf_dir):
    f = age_band_recipe(spark, sf_dir).filter(F.col("sexo") != SEX_TOTAL[1])  # Total would double count
    return wn.share_of_total(f, ["data_referencia", "uf_id"], "populacao", "participacao_uf_pct").select(
        "data_referencia", "uf_id", "sexo_id", "faixa_etaria_id", "populacao", "participacao_uf_pct")


# National variables built from orders: (id, name, unit).
NATIONAL_VARIABLES = [("93", "Pedidos", "Mil pedidos"), ("9808", "Valor total", "USD"),
                      ("9809", "Valor faturado", "USD"), ("9810", "Pedidos urgentes", "%")]


def _national_documents(spark, sf_dir) -> DataFrame:
    """Yearly national totals of orders as one nested document element per
    variable (persons, two money values and a percentage-class value)."""
    o = _t(spark, sf_dir, "orders")
    y = (o.groupBy(F.year("o_orderdate").cast("string").alias("periodo"))
         .agg(F.count(F.lit(1)).alias("n"),
              F.sum("o_totalprice").alias("total"),
              F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("faturado"),
              F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("u")))
    money = lambda c: F.coalesce(F.format_string("%.2f", F.col(c)), F.lit("..."))
    kv = F.explode(F.array(F.struct(F.lit("93").alias("id"), F.col("n").cast("string").alias("valor")),
                           F.struct(F.lit("9808").alias("id"), money("total").alias("valor")),
                           F.struct(F.lit("9809").alias("id"), money("faturado").alias("valor")),
                           F.struct(F.lit("9810").alias("id"), F.col("u").cast("string").alias("valor"))))
    long = y.select("periodo", kv.alias("kv"))
    series = (long.groupBy(F.col("kv.id").alias("id"))
              .agg(F.map_from_entries(F.collect_list(F.struct("periodo", F.col("kv.valor")))).alias("serie")))
    names = spark.createDataFrame(NATIONAL_VARIABLES, "id string, variavel string, unidade string")
    place = F.struct(F.lit("1").alias("id"), F.struct(F.lit("N1").alias("id"), F.lit("Total").alias("nome")).alias("nivel"),
                     F.lit("Total").alias("nome"))
    result = F.struct(F.array().cast("array<struct<id:string,nome:string,categoria:map<string,string>>>")
                      .alias("classificacoes"),
                      F.array(F.struct(place.alias("localidade"), F.col("serie"))).alias("series"))
    return (jn.attach_dimension(series, names, "id", "inner")
            .select("id", "variavel", "unidade", F.array(result).alias("resultados")))


def pib_money_recipe(spark, sf_dir):
    return ds.pib_tables(fl.flatten_nested(_national_documents(spark, sf_dir)))["PIB_financeiro"]


def pib_long_recipe(spark, sf_dir):
    return ds.pib_brasil_ano(fl.flatten_nested(_national_documents(spark, sf_dir)))


def date_range_filter(spark, sf_dir):
    import datetime as _dt
    lo, hi = (_dt.date.fromisoformat(d) for d in DATE_RANGE)
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return (cat.date_range(o, "o_orderdate", lo, hi)
            .select("o_orderkey", F.to_date("o_orderdate").alias("data_referencia"), "o_totalprice"))


def upsert_merge(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    target = o.filter(F.col("o_orderdate") < F.lit(UPSERT_TARGET_BEFORE).cast("timestamp"))
    updates = (o.filter(F.col("o_orderdate") >= F.lit(UPSERT_UPDATES_FROM).cast("timestamp"))
               .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0)))
    return pb.merge_snapshot(target, updates, ["o_orderkey"]).drop("o_orderdate")


# ------------------------------------------------------ file round trips --
# Data derived from TESTDATA is landed as files in a fresh folder under the
# shared checkpoint folder and read back by the library's own readers, so
# the file connectors run over data that grows with the tables.

def _landing_folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/landing/{name}_{uuid.uuid4().hex}"


def landed_nested_recipe(spark, sf_dir):
    """Population documents landed as JSON (one variable element per line)
    and read back by the nested-document reader with its explicit schema;
    the result equals ``population_recipe``."""
    folder = _landing_folder(spark, "populacao")
    _population_documents(spark, sf_dir).write.mode("error").json(folder)
    raw = rd.read_nested(spark, folder, mode="FAILFAST", with_file=False, multi_line=False)
    return ds.populacao_municipio(fl.flatten_nested(raw))


EVENT_SERIES_CATALOG = {s: {"codigo": sid, "nome": ind, "unidade": u, "periodicidade": p}
                        for s, sid, ind, u, p in EVENT_SERIES}


def landed_series_recipe(spark, sf_dir):
    """Daily event series landed as raw flat records ``{serie, codigo, data,
    valor}`` in two extractions (all days, then the days from
    ``SECOND_EXTRACTION_FROM`` again), each de-duplicated and sorted by the
    raw landing step; both are read back by one multi-path scan carrying
    file name and time, typed, and de-duplicated across files (the newest
    file wins).  The result equals ``union_series``."""
    e = _t(spark, sf_dir, "events")
    codes = spark.createDataFrame([(s, sid) for s, sid, *_ in EVENT_SERIES], "serie string, codigo int")
    raw = jn.attach_dimension(
        e.select(F.col("event_type").alias("serie"),
                 F.date_format("ts", "dd/MM/yyyy").alias("data"),
                 F.regexp_replace(F.format_string("%.2f", F.col("value")), r"\.", ",").alias("valor"),
                 "ts", "event_id"),
        codes, "serie", "inner")
    root = _landing_folder(spark, "series")
    first = pb.land_raw(raw, root, ["codigo", "data"], ["ts", "event_id"], stamp="1")
    again = raw.filter(F.to_date("ts") >= F.lit(SECOND_EXTRACTION_FROM).cast("date"))
    second = pb.land_raw(again, root, ["codigo", "data"], ["ts", "event_id"], stamp="2")
    landed = rd.read_flat_series(spark, [first, second], mode="FAILFAST", multi_line=False)
    return ds.bacen_from_raw(landed, EVENT_SERIES_CATALOG)


CUSTOMER_CSV_CONTRACT = ct.Contract(
    name="clientes_csv",
    schema=T.StructType([
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DecimalType(12, 2)),
        T.StructField("c_mktsegment", T.StringType()),
    ]),
    key=["c_custkey"],
)


def _customer_csv(spark, sf_dir) -> DataFrame:
    """Customers written as a header CSV of texts (junk tokens in two
    columns for two segments) and read back as strings."""
    c = _t(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    text = c.select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
        F.when(seg == "BUILDING", F.lit("n/d")).otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"),
        F.when(seg == "HOUSEHOLD", F.lit("...")).otherwise(F.format_string("%.2f", F.col("c_acctbal")))
        .alias("c_acctbal"),
        "c_mktsegment")
    folder = _landing_folder(spark, "clientes_csv")
    pb.write_table(text, folder, fmt="csv", mode="error")
    return rd.read_csv_strings(spark, folder, CUSTOMER_CSV_CONTRACT.columns)


def csv_typed_import(spark, sf_dir):
    """Typed CSV import: every column converted by the contract's type."""
    typed, _ = ct.typed_by_contract(CUSTOMER_CSV_CONTRACT, _customer_csv(spark, sf_dir))
    return typed


def csv_cast_failures(spark, sf_dir):
    """Per column, the non-empty texts the contract's type rejects."""
    _, fails = ct.typed_by_contract(CUSTOMER_CSV_CONTRACT, _customer_csv(spark, sf_dir))
    return fails


PER_SERIES_CSV_SCHEMA = T.StructType([
    T.StructField("serie_id", T.IntegerType()),
    T.StructField("indicador", T.StringType()),
    T.StructField("unidade", T.StringType()),
    T.StructField("periodicidade", T.StringType()),
    T.StructField("data_referencia", T.DateType()),
    T.StructField("ano", T.ShortType()),
    T.StructField("mes", T.ShortType()),
    T.StructField("valor", T.DecimalType(20, 8)),
])


def per_series_csv(spark, sf_dir):
    """The typed daily series written as one header-CSV folder per series by
    one ``partitionBy`` job, then read back with the declared schema: the
    series name returns from the folder names (partition discovery)."""
    folder = _landing_folder(spark, "por_serie")
    pb.write_per_series(union_series(spark, sf_dir), folder, series_col="serie", fmt="csv",
                        sort_within=["serie", "data_referencia"])
    back = rd.read_csv_typed(spark, folder, PER_SERIES_CSV_SCHEMA)
    return back.select("serie_id", "serie", *[c for c in PER_SERIES_CSV_SCHEMA.fieldNames() if c != "serie_id"])


REFRESH_CONTRACTS = {
    "clientes": ct.Contract(
        name="clientes",
        schema=T.StructType([
            T.StructField("c_custkey", T.LongType(), False),
            T.StructField("c_nationkey", T.IntegerType(), False),
            T.StructField("c_mktsegment", T.StringType(), True),
        ]),
        key=["c_custkey"], not_null=["c_custkey", "c_nationkey"],
        foreign_keys=[(["c_nationkey"], "nacoes", ["n_nationkey"])],
        max_length={"c_mktsegment": 10}),
    "pedidos": ct.Contract(
        name="pedidos",
        schema=T.StructType([
            T.StructField("o_orderkey", T.LongType(), False),
            T.StructField("o_custkey", T.LongType(), False),
            T.StructField("data_referencia", T.DateType(), False),
            T.StructField("ano", T.IntegerType(), False),
            T.StructField("mes", T.IntegerType(), False),
            T.StructField("o_orderpriority", T.StringType(), False),
            T.StructField("o_totalprice", T.DecimalType(12, 2), True),
        ]),
        key=["o_orderkey"],
        not_null=["o_orderkey", "o_custkey", "data_referencia", "ano", "mes", "o_orderpriority"],
        foreign_keys=[(["o_custkey"], "clientes", ["c_custkey"])],
        year_of_date=("ano", "data_referencia"), ranges={"mes": (1, 12)},
        max_length={"o_orderpriority": 20}),
}


def full_refresh_counts(spark, sf_dir):
    """Full refresh of a customer and an order table: both contracts
    (keys, foreign keys to the NEW customer table and to nations, ranges)
    are checked before either table is switched; then the row count of each
    table read back from its published version."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    o = _t(spark, sf_dir, "orders")
    fact = o.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("data_referencia"),
                    F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes"),
                    "o_orderpriority", F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"))
    tables = {"clientes": (c, REFRESH_CONTRACTS["clientes"]), "pedidos": (fact, REFRESH_CONTRACTS["pedidos"])}
    dims = {"clientes": c, "nacoes": _t(spark, sf_dir, "nation")}
    root = _landing_folder(spark, "carga")
    pb.full_refresh(spark, tables, root, dims=dims)
    return pb.post_load_counts(spark, {name: f"{root}/{name}" for name in tables})


def upsert_published(spark, sf_dir):
    """The snapshot upsert through the published-table path: the target is
    published, the updates are merged into a NEW version folder and the
    pointer switched; the same batch is applied twice (a replay) and the
    current version is read back.  Equals ``upsert_merge``."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    target = o.filter(F.col("o_orderdate") < F.lit(UPSERT_TARGET_BEFORE).cast("timestamp")).drop("o_orderdate")
    updates = (o.filter(F.col("o_orderdate") >= F.lit(UPSERT_UPDATES_FROM).cast("timestamp"))
               .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0)).drop("o_orderdate"))
    root = _landing_folder(spark, "pedidos_publicados")
    pb.upsert(spark, target, root, ["o_orderkey"])
    pb.upsert(spark, updates, root, ["o_orderkey"])
    pb.upsert(spark, updates, root, ["o_orderkey"])  # replayed batch: same table
    return pb.read_current(spark, root)


def _orders_by_year(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("ano"),
                                              F.col("o_totalprice").cast("decimal(12,2)").alias("valor"))


def _raised(df: DataFrame, by: int) -> DataFrame:
    return df.withColumn("valor", (F.col("valor") + F.lit(by)).cast("decimal(12,2)"))


def upsert_touched_partitions(spark, sf_dir):
    """A year-partitioned table of all orders, then an upsert of the orders of
    ``UPSERT_YEAR``: per year its rows, their total and the commit that wrote
    the partition (2 for that year alone, the other folders stay)."""
    o = _orders_by_year(spark, sf_dir)
    root = _landing_folder(spark, "particionado")
    pb.upsert(spark, o, f"{root}/pedidos", ["o_orderkey"], ["ano"])
    pb.upsert(spark, _raised(o.filter(F.col("ano") == UPSERT_YEAR), 1), f"{root}/pedidos", ["o_orderkey"], ["ano"])
    written = pb.partitions(spark, f"{root}/pedidos").select(
        F.get_json_object("valores", "$.ano").cast("int").alias("ano"), F.col("gravado").alias("commit"))
    sums = pb.read_current(spark, f"{root}/pedidos").groupBy("ano").agg(
        F.count(F.lit(1)).alias("linhas"), F.sum("valor").cast("double").alias("total"))
    return sums.join(written, "ano").select("ano", "linhas", F.round("total", 2).alias("total"), "commit")


def upsert_two_writers(spark, sf_dir):
    """Three writers merge batches that were all staged against the first
    commit: one raises the orders of a year, one those of another year, one
    those of the first year's customers with even keys.  The first two commit
    side by side, the third finds its year changed and merges again, so no
    batch is lost."""
    o = _orders_by_year(spark, sf_dir)
    root = _landing_folder(spark, "escritores")
    pb.upsert(spark, o, f"{root}/pedidos", ["o_orderkey"], ["ano"])
    one, two, three = (cm.Changes(spark, root) for _ in range(3))
    first = o.filter(F.col("ano") == UPSERT_YEAR)
    one.upsert("pedidos", _raised(first.filter(F.col("o_custkey") % 2 == 1), 1), ["o_orderkey"], ["ano"])
    two.upsert("pedidos", _raised(o.filter(F.col("ano") == UPSERT_YEAR + 1), 2), ["o_orderkey"], ["ano"])
    even = _raised(first.filter(F.col("o_custkey") % 2 == 0), 3)
    three.upsert("pedidos", even, ["o_orderkey"], ["ano"])
    one.commit()
    two.commit()
    try:
        three.commit()
    except cm.CommitConflict:
        pb.upsert(spark, even, f"{root}/pedidos", ["o_orderkey"], ["ano"])
    return pb.read_current(spark, f"{root}/pedidos")


def refresh_one_commit(spark, sf_dir):
    """Full refreshes of a customer and an order table as readers see them:
    after the first one, after one that breaks a contract (orders of unknown
    customers), after one that stops between the tables, and after a good one
    whose orders cost 3 more.  Rows and totals of both tables each time."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    o = _t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("data_referencia"), F.year("o_orderdate").alias("ano"),
        F.month("o_orderdate").alias("mes"), "o_orderpriority", F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"))
    higher = o.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(14,2)") + 3).withColumn(
        "o_totalprice", F.col("o_totalprice").cast("decimal(12,2)"))
    few = c.filter(F.col("c_custkey") % 2 == 0)
    dims = {"nacoes": _t(spark, sf_dir, "nation")}
    root = _landing_folder(spark, "um_commit")

    def refresh(customers, orders):
        pb.full_refresh(spark, {"clientes": (customers, REFRESH_CONTRACTS["clientes"]),
                                "pedidos": (orders, REFRESH_CONTRACTS["pedidos"])}, root, dims=dims)

    def seen(step: str) -> DataFrame:
        customers, orders = (pb.read_current(spark, f"{root}/{n}") for n in ("clientes", "pedidos"))
        return customers.agg(F.lit(step).alias("etapa"), F.lit("clientes").alias("tabela"), F.count(F.lit(1)).alias("linhas"),
                             F.sum("c_custkey").cast("double").alias("total")).union(
            orders.agg(F.lit(step), F.lit("pedidos"), F.count(F.lit(1)), F.sum("o_totalprice").cast("double")))

    refresh(c, o)
    steps = [seen("1 primeira")]
    try:
        refresh(few, higher)
        raise AssertionError("orders of unknown customers were published")
    except ValueError:
        steps.append(seen("2 contrato violado"))
    stopped = cm.Changes(spark, root)  # a writer that stops after one table
    stopped.replace("clientes", few)
    steps.append(seen("3 interrompida"))
    refresh(c, higher)
    steps.append(seen("4 completa"))
    return rs.union_frames(steps).withColumn("total", F.round("total", 2))


def _landed_events(spark, sf_dir) -> DataFrame:
    codes = spark.createDataFrame([(s, sid) for s, sid, *_ in EVENT_SERIES], "serie string, codigo int")
    e = _t(spark, sf_dir, "events").select(
        F.col("event_type").alias("serie"), F.to_date("ts").alias("dia"), F.date_format("ts", "dd/MM/yyyy").alias("data"),
        F.col("value").alias("numero"), "ts", "event_id")
    return jn.attach_dimension(e, codes, "serie", "inner")


def _as_text(df: DataFrame) -> DataFrame:
    text = F.regexp_replace(F.format_string("%.2f", F.col("numero")), r"\.", ",")
    return df.select("serie", "codigo", "data", text.alias("valor"), "ts", "event_id")


def landed_extractions(spark, sf_dir):
    """The daily-series job over what ``land_series`` landed: one run with all
    days, a later run with other values (one more) for the days from
    ``SECOND_EXTRACTION_FROM``; the published history has the later values."""
    raw, root = _landed_events(spark, sf_dir), _landing_folder(spark, "corridas")
    later = raw.filter(F.col("dia") >= F.lit(SECOND_EXTRACTION_FROM).cast("date")).withColumn("numero", F.col("numero") + 1)
    for df, stamp in ((raw, "20240201_000000"), (later, "20240202_000000")):
        pb.land_series(_as_text(df), f"{root}/raw", "eventos", ["codigo", "data"], ["ts", "event_id"], stamp)
    jobs.run_bacen(spark, f"{root}/raw", f"{root}/dw", catalog=EVENT_SERIES_CATALOG, fonte="eventos")
    return pb.read_current(spark, f"{root}/dw/bacen_serie_historica")


def intake_report(spark, sf_dir):
    """Accounting of a landing folder: a sound run of the event series, broken
    records (purchases cut off), records without a field (signups), a series
    that the catalog does not know (orders by status as documents) and a run
    without a record.  Problem, snapshots that have it, records."""
    root, stamp = _landing_folder(spark, "entrada"), "20240201_000000"
    keys, order = ["codigo", "data"], ["ts", "event_id"]
    text = _as_text(_landed_events(spark, sf_dir))
    pb.land_series(text.filter(~F.col("serie").isin("purchase", "signup")), root, "eventos", keys, order, stamp)

    def run_folder(dataset: str, code: int) -> str:
        return f"{root}/fonte=eventos/dataset={dataset}/codigo={code}/run={stamp}"
    lines = text.filter(F.col("serie") == "purchase").select(
        F.concat(F.lit('{"serie": "purchase", "data": "'), "data").alias("value"))
    lines.write.mode("error").text(run_folder("purchase", 3))
    text.filter(F.col("serie") == "signup").select(F.lit('{"erro": "sem dados"}').alias("value")).write.mode("error").text(
        run_folder("signup", 4))
    o = _t(spark, sf_dir, "orders").select(F.to_json(F.struct(
        F.col("o_orderstatus").alias("serie"), F.lit(77).alias("codigo"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("data"),
        F.lit("1").alias("valor"))).alias("value"))
    o.write.mode("error").text(run_folder("pedidos", 77))
    spark.createDataFrame([(" ",)], "value string").write.mode("error").text(run_folder("vazio", 78))
    known = spark.createDataFrame([(s, sid) for s, sid, *_ in EVENT_SERIES], "serie string, codigo int")
    taken = take_in(rd.read_landing_folder(spark, root, FLAT_ITEM_SCHEMA), f"{_landing_folder(spark, 'registros')}", known,
                    ["serie", "codigo"], sn.snapshot_listing(spark, root), on_problem="quarantine")
    good = taken.good.agg(F.lit("aproveitado").alias("problema"), F.count_distinct(
        sn.snapshot_of(F.col("arquivo_caminho"))).alias("instantaneos"), F.count(F.lit(1)).alias("registros"))
    return taken.report.groupBy("problema").agg(F.count(F.lit(1)).alias("instantaneos"), F.sum("linhas").alias("registros")).union(good)


def document_problems_report(spark, sf_dir):
    """Corrupt-document check over two landed batches read by ONE permissive
    scan: the population documents (valid) and one truncated record per
    HOUSEHOLD customer (malformed).  Per batch: rows, malformed records and
    rows carrying data."""
    good = _landing_folder(spark, "documentos_bons")
    bad = _landing_folder(spark, "documentos_corrompidos")
    _population_documents(spark, sf_dir).write.mode("error").json(good)
    c = _t(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "HOUSEHOLD")
    (c.select(F.concat(F.lit('{"id": "'), F.col("c_custkey").cast("string"), F.lit('", "variavel": ')).alias("value"))
     .write.mode("error").text(bad))
    raw = rd.read_nested(spark, [good, bad], mode="PERMISSIVE", with_file=True, multi_line=False)
    batch = F.when(F.col("arquivo_caminho").contains("/documentos_corrompidos_"), F.lit("corrompidos")) \
        .otherwise(F.lit("bons"))
    return ct.document_problems(raw.select("id", "_corrupt_record", batch.alias("lote")), file_col="lote")


def _population_model(spark, sf_dir) -> dict:
    pop = ds.populacao_municipio(fl.flatten_nested(_population_documents(spark, sf_dir, state_coded=True)))
    return {"populacao_municipio": ds.populacao_com_crescimento(pop), "resumo_ano": ds.resumo_ano(pop),
            "dim_uf": _state_dimension(spark, sf_dir, STATE_CODE_OFFSET)}


def page_population_by_region(spark, sf_dir):
    """Q3 on the population page under the year slicer (Q12: calendar year
    -> yearly summary -> municipal fact, as semi joins)."""
    return rp.population_by_region(rp.year_slicer(_population_model(spark, sf_dir), PAGE_YEARS))


def page_mean_population_by_state(spark, sf_dir):
    """Q4 on the population page under the year slicer."""
    out = rp.mean_population_by_state(rp.year_slicer(_population_model(spark, sf_dir), PAGE_YEARS))
    return out.withColumn("media_populacao", F.round("media_populacao", 4))


def page_year_count_by_state(spark, sf_dir):
    """Q5 on the population page under the year slicer."""
    return rp.year_count_by_state(rp.year_slicer(_population_model(spark, sf_dir), PAGE_YEARS))


def page_state_count_by_year_region(spark, sf_dir):
    """Q6 on the population page under the year slicer."""
    return rp.state_count_by_year_region(rp.year_slicer(_population_model(spark, sf_dir), PAGE_YEARS))


def page_cards(spark, sf_dir):
    """Q8-Q11 on the population page under the year slicer."""
    cards = rp.cards(rp.year_slicer(_population_model(spark, sf_dir), PAGE_YEARS))
    return cards.withColumn("valor", F.round("valor", 4))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "avg_of_avgs": avg_of_avgs,
    "avg_of_avgs_by_year": avg_of_avgs_by_year,
    "parse_number": parse_number,
    "parse_decimal": parse_decimal,
    "parse_day": parse_day,
    "period_year": period_year,
    "period_month": period_month,
    "period_quarter": period_quarter,
    "strip_suffix": strip_suffix,
    "group_label": group_label,
    "macro_band": macro_band,
    "nested_flatten": nested_flatten,
    "category_lookup": category_lookup,
    "catalog_profile": catalog_profile,
    "map_flatten": map_flatten,
    "split_persons": split_persons,
    "split_money": split_money,
    "split_percent": split_percent,
    "union_series": union_series,
    "constant_cols": constant_cols,
    "pivot_long_wide": pivot_long_wide,
    "dedup_last": dedup_last,
    "dup_key_report": dup_key_report,
    "null_profile": null_profile,
    "range_summary": range_summary,
    "value_list": value_list,
    "value_list_year": value_list_year,
    "row_counts": row_counts,
    "file_profile": file_profile,
    "contract_checks": contract_checks,
    "star_region_sum": star_region_sum,
    "avg_by_group": avg_by_group,
    "count_nonnull": count_nonnull,
    "two_key_count": two_key_count,
    "filter_propagation": filter_propagation,
    "lag_growth": lag_growth,
    "year_summary": year_summary,
    "report_cards": report_cards,
    "share_of_total": share_of_total,
    "matrix_rollup": matrix_rollup,
    "date_drill": date_drill,
    "date_drill_day": date_drill_day,
    "single_value": single_value,
    "calendar": calendar,
    "date_part_join": date_part_join,
    "window_table": window_table,
    "window_coverage": window_coverage,
    "window_coverage_series": window_coverage_series,
    "date_range_filter": date_range_filter,
    "population_recipe": population_recipe,
    "resumo_ano_recipe": resumo_ano_recipe,
    "unemployment_recipe": unemployment_recipe,
    "unemployment_report_recipe": unemployment_report_recipe,
    "unemployment_table_report": unemployment_table_report,
    "unemployment_by_state_report": unemployment_by_state_report,
    "page_population_by_region": page_population_by_region,
    "page_mean_population_by_state": page_mean_population_by_state,
    "page_year_count_by_state": page_year_count_by_state,
    "page_state_count_by_year_region": page_state_count_by_year_region,
    "page_cards": page_cards,
    "cpi_recipe": cpi_recipe,
    "cpi_matrix_report": cpi_matrix_report,
    "age_band_recipe": age_band_recipe,
    "age_share_recipe": age_share_recipe,
    "pib_money_recipe": pib_money_recipe,
    "pib_long_recipe": pib_long_recipe,
    "upsert_merge": upsert_merge,
    "landed_nested_recipe": landed_nested_recipe,
    "landed_series_recipe": landed_series_recipe,
    "csv_typed_import": csv_typed_import,
    "csv_cast_failures": csv_cast_failures,
    "per_series_csv": per_series_csv,
    "full_refresh_counts": full_refresh_counts,
    "upsert_published": upsert_published,
    "document_problems_report": document_problems_report,
    "upsert_touched_partitions": upsert_touched_partitions,
    "upsert_two_writers": upsert_two_writers,
    "refresh_one_commit": refresh_one_commit,
    "landed_extractions": landed_extractions,
    "intake_report": intake_report,
}
