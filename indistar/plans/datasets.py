"""Dataset recipes: raw landed documents -> published facts and dimensions.

Each recipe is a lazy DataFrame plan over the long layer of ``flatten``;
nothing is collected.  ``TABLE_CONTRACTS`` (in ``tables``) declares keys,
foreign keys and ranges checked before publishing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsing as fp
from ..functions import periods as fd
from ..operators import aggregates as agg
from ..operators import flatten as fl
from ..operators import joins as jn
from ..operators import reshape as rs
from ..operators import windows as wn
from ..sources import catalog as cat
from ..sources import readers as rd
from ..sources.snapshots import snapshot_field

# ---------------------------------------------------------------------------
# Variable / classification ids and output names.
# ---------------------------------------------------------------------------
PIB_PERSONS = [93]
PIB_MONEY = [9808, 9809, 9812, 9813]
PIB_PERCENT = [9810, 9811, 9814]
SEX_CLASSIFICATION = 2
AGE_CLASSIFICATION = 287
IPCA_GROUP_CLASSIFICATION = 315
UNEMPLOYMENT_VARIABLES = {4099: "taxa_desocupacao_pct", 4118: "taxa_subutilizacao_pct"}
IPCA_VARIABLES = {63: "variacao_mensal_pct", 69: "acumulado_ano_pct",
                  2265: "acumulado_12_meses_pct", 66: "peso_mensal_pct"}
# Longest calendar: 146,100 days, a few megabytes.
CALENDAR_YEARS = 400
PIB_COLUMNS = ["variavel_id", "variavel_nome", "unidade", "data_referencia", "ano"]


def long_layer(spark: SparkSession, paths) -> DataFrame:
    """Nested documents (one or many files) -> long layer."""
    return fl.flatten_nested(rd.read_nested(spark, paths, with_file=False))


def _with(df: DataFrame, cols: Mapping) -> DataFrame:
    return df.withColumns(dict(cols))


def dim_uf(spark: SparkSession) -> DataFrame:
    return cat.state_dimension(spark)


def populacao_municipio(long: DataFrame) -> DataFrame:
    base = _with(long, fd.annual_period("periodo"))
    return base.select(
        "data_referencia", "ano",
        F.col("localidade_id").try_cast("int").alias("municipio_id"),
        fp.strip_state_suffix("localidade_nome").alias("municipio_nome"),
        fp.code_prefix("localidade_id", 2).alias("uf_id"),
        F.col("valor").cast("long").alias("populacao"))


def pib_tables(long: DataFrame) -> dict[str, DataFrame]:
    """GDP long layer -> persons / money / percentage tables (own types)."""
    base = _with(long, fd.annual_period("periodo"))
    classes = {
        "PIB_pessoas": (PIB_PERSONS, "populacao_mil_pessoas", "long"),
        "PIB_financeiro": (PIB_MONEY, "valor_financeiro", "decimal(20,2)"),
        "PIB_percentual": (PIB_PERCENT, "valor_percentual", "decimal(10,2)"),
    }
    return rs.split_by_class(base, "variavel_id", classes, keep=PIB_COLUMNS)


def pib_brasil_ano(long: DataFrame) -> DataFrame:
    """Unsplit GDP table with place and level columns."""
    base = _with(long, fd.annual_period("periodo"))
    return base.select("variavel_id", "variavel_nome", "unidade",
                       F.col("localidade_id").try_cast("int").alias("pais_id"),
                       F.col("localidade_nome").alias("pais_nome"),
                       "nivel_id", "nivel_nome", "ano", "data_referencia", "valor")


def faixa_etaria_uf(long: DataFrame) -> DataFrame:
    """Population by state, sex and age band (``Total`` sex rows kept, as
    published; exclude them before summing across sexes)."""
    base = (_with(long, fd.annual_period("periodo"))
            .withColumn("cat_sexo", fl.category_of("classificacoes", SEX_CLASSIFICATION))
            .withColumn("cat_idade", fl.category_of("classificacoes", AGE_CLASSIFICATION)))
    start = fp.leading_number(F.col("cat_idade.value"))
    return base.select(
        "data_referencia", "ano",
        F.col("localidade_id").try_cast("int").alias("uf_id"),
        F.col("cat_sexo.key").try_cast("int").alias("sexo_id"),
        F.col("cat_sexo.value").alias("sexo"),
        F.col("cat_idade.key").try_cast("int").alias("faixa_etaria_id"),
        F.col("cat_idade.value").alias("faixa_etaria"),
        start.alias("faixa_etaria_ordem"),
        fp.age_band(start).alias("faixa_macro"),
        F.col("valor").cast("long").alias("populacao"))


def desemprego_uf_trimestre(long: DataFrame) -> DataFrame:
    base = (_with(long, fd.quarterly_period("periodo"))
            .withColumn("uf_id", F.col("localidade_id").try_cast("int")))
    return rs.pivot_values(base, ["data_referencia", "ano", "trimestre_num", "trimestre", "uf_id"],
                           "variavel_id", UNEMPLOYMENT_VARIABLES)


def ipca_area_mes(long: DataFrame) -> DataFrame:
    """Monthly CPI by surveyed area (areas are not states: no state join)."""
    base = (_with(long, fd.monthly_period("periodo"))
            .withColumn("cat_grupo", fl.category_of("classificacoes", IPCA_GROUP_CLASSIFICATION)))
    gid = F.col("cat_grupo.key").try_cast("int")
    label = F.col("cat_grupo.value")
    base = base.withColumns({
        "grupo_ipca_id": gid,
        "area_ipca_id": F.col("localidade_id").try_cast("int"),
        "area_ipca": F.col("localidade_nome"),
        "grupo_ipca_ordem": fp.group_order(label, gid),
        "grupo_ipca": fp.group_name(label, gid),
    })
    keys = ["data_referencia", "ano", "mes", "area_ipca_id", "area_ipca", "nivel_id",
            "grupo_ipca_id", "grupo_ipca", "grupo_ipca_ordem"]
    return rs.pivot_values(base, keys, "variavel_id", IPCA_VARIABLES)


def bacen_from_raw(raw: DataFrame, series: dict | None = None) -> DataFrame:
    """Typed, de-duplicated daily series from raw flat-document rows.

    ``raw`` carries ``arquivo`` / ``arquivo_modificado`` (``read_flat_series``);
    constant columns come from a broadcast catalog join; the same (series,
    date) seen in several snapshots keeps the row of the latest extraction:
    the stamp in the landed file name or run folder decides, then the
    modification time, then the name (files without a stamp are ordered by
    time).
    """
    catalog = cat.series_catalog(raw.sparkSession, series).drop("serie_id")
    if "_corrupt_record" in raw.columns:
        raw = raw.drop("_corrupt_record")
    typed = (jn.attach_dimension(raw, catalog, "serie", "inner")
             .withColumn("data_referencia", fd.parse_day("data"))
             .withColumn("valor", fp.parse_decimal("valor", 20, 8))
             .filter(F.col("data_referencia").isNotNull() & F.col("valor").isNotNull()))
    parts = fd.year_month_small("data_referencia")
    stamp = snapshot_field(F.col("arquivo_caminho" if "arquivo_caminho" in raw.columns else "arquivo"), "carimbo")
    shaped = typed.select(F.col("codigo").alias("serie_id"), "serie", "indicador", "unidade", "periodicidade",
                          "data_referencia", parts["ano"].alias("ano"), parts["mes"].alias("mes"), "valor",
                          stamp.alias("carimbo"), "arquivo_modificado", "arquivo")
    last = rs.dedup_keep_last(shaped, ["serie_id", "data_referencia"], ["carimbo", "arquivo_modificado", "arquivo"])
    return last.drop("carimbo", "arquivo_modificado", "arquivo")


def bacen_serie_historica(spark: SparkSession, paths, series: dict | None = None) -> DataFrame:
    """Daily series from flat documents of any number of snapshots (one read)."""
    return bacen_from_raw(rd.read_flat_series(spark, paths), series)


def bacen_per_series(historica: DataFrame, series: dict | None = None) -> dict[str, DataFrame]:
    """One table per series (filter on the fixed id of each)."""
    series = cat.SERIES if series is None else series
    return {name: historica.filter(F.col("serie_id") == c["codigo"]) for name, c in series.items()}


def populacao_com_crescimento(pop: DataFrame) -> DataFrame:
    """Municipal population with previous year, absolute change and growth %."""
    return wn.previous_period_change(pop, ["municipio_id"], "ano", "populacao",
                                     prev_name="populacao_ano_anterior")


def resumo_ano(pop: DataFrame) -> DataFrame:
    """Yearly summary: total, municipalities, mean growth %, total change."""
    g = populacao_com_crescimento(pop)
    s = agg.year_summary(g, "ano", "populacao", "crescimento_pct", "variacao_absoluta", "municipio_id")
    return s.select(F.make_date("ano", F.lit(1), F.lit(1)).alias("ano"),
                    F.col("total").alias("populacao_total"),
                    F.col("qtd_entidades").alias("qtd_municipios"),
                    F.round("crescimento_medio_pct", 2).alias("crescimento_medio_pct"),
                    F.col("variacao_absoluta_total").cast("double").alias("variacao_absoluta_total"))


def calendar_for(df: DataFrame, date_col: str, max_years: int = CALENDAR_YEARS) -> DataFrame:
    """Calendar from 1 Jan of the first year to 31 Dec of the last year of a
    date column (size bounded by the span, not by the data volume).  A span of
    more than ``max_years``, such as one mistyped year makes, fails the run:
    every calendar is small enough to broadcast."""
    b = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    span = F.concat(F.lit(f"calendar of {date_col}: "), F.year("lo").cast("string"), F.lit(" to "), F.year("hi").cast("string"),
                    F.lit(f" is more than {max_years} years"))
    last = F.when(F.year("hi") - F.year("lo") < max_years, F.year("hi")).when(F.col("lo").isNotNull(), F.raise_error(span).cast("int"))
    days = b.select(F.explode(F.sequence(F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
                                         F.make_date(last, F.lit(12), F.lit(31)))).alias("data"))
    return days.select("data", *[v.alias(k) for k, v in fd.calendar_columns("data").items()])


def with_state(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Denormalised state code, name and region on a fact (27-row dim broadcast)."""
    return jn.attach_dimension(fact, dim, "uf_id", "left")
