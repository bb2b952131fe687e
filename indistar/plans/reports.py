"""Report queries of the indicator panel over the published star model.

``model`` maps table names to DataFrames: ``populacao_municipio`` (with the
growth columns of ``datasets.populacao_com_crescimento``), ``resumo_ano``,
``desemprego_uf_trimestre``, ``faixa_etaria_uf``, ``ipca_area_mes`` and
``dim_uf``.  Slicers become semi joins that propagate along the model's
relationships (calendar year -> yearly summary -> municipal fact);
``panel_model`` puts any set of them through the whole relationship graph.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import joins as jn
from ..operators import reshape as rs
from ..operators.model import Relationship, Selections, StarModel
from . import datasets as ds

Model = Mapping[str, DataFrame]

# The relationships of the panel.  Each fact has a calendar of
# its own, so a year chosen for the population visuals leaves the others alone.
RELATIONSHIPS = [
    Relationship("resumo_ano", "to_date(ano)", "calendario", "data", {"ano": "year(ano)"}),
    Relationship("populacao_municipio", "ano", "resumo_ano", "year(ano)", {"year(ano)": "ano"}),
    Relationship("desemprego_uf_trimestre", "to_date(data_referencia)", "calendario_desemprego", "data", {"ano": "ano"}),
    Relationship("ipca_area_mes", "to_date(data_referencia)", "calendario_ipca", "data", {"ano": "ano"}),
    Relationship("populacao_municipio", "uf_id", "dim_uf", "uf_id", {"uf_id": "uf_id"}),
    Relationship("desemprego_uf_trimestre", "uf_id", "dim_uf", "uf_id", {"uf_id": "uf_id"}),
    Relationship("faixa_etaria_uf", "uf_id", "dim_uf", "uf_id", {"uf_id": "uf_id"}),
]

# Fixed value: the default year slicer selection of the population page.
DEFAULT_YEARS = [2021]
UNEMPLOYMENT_YEARS = list(range(2017, 2027))


def _pop(model: Model) -> DataFrame:
    """Municipal fact with the state attributes (27-row dimension broadcast)."""
    if "regiao" in model["populacao_municipio"].columns:
        return model["populacao_municipio"]
    return jn.attach_dimension(model["populacao_municipio"], model["dim_uf"], "uf_id", "left")


def panel_model(model: Model, relationships: Sequence[Relationship] = RELATIONSHIPS) -> StarModel:
    """The panel's tables with their relationships and the summary's calendar;
    the municipal fact holds the state attributes, as its slicers need them."""
    tables = dict(model)
    if "calendario" not in tables:
        tables["calendario"] = ds.calendar_for(tables["resumo_ano"], "ano")
    return StarModel({**tables, "populacao_municipio": _pop(model)}, relationships)


def slicer_list(model: StarModel, table: str, column: str, selections: Selections) -> DataFrame:
    """Q12-Q15: what the list of one slicer offers while the others are set
    (its own selection does not narrow it)."""
    others = {k: v for k, v in selections.items() if k != (table, column)}
    return model.slice(others).values(table, column)


def year_slicer(model: Model, years: Sequence[int] | None) -> Model:
    """Apply a calendar-year selection through two hops of relationships."""
    if not years:
        return model
    resumo = model["resumo_ano"].filter(F.year("ano").isin(list(years)))
    pop = jn.keep_matching(model["populacao_municipio"],
                           resumo.select(F.year("ano").alias("ano")), "ano", broadcast=True)
    return {**model, "resumo_ano": resumo, "populacao_municipio": pop}


def attribute_slicer(model: Model, column: str, values: Sequence) -> Model:
    """Region / state / municipality dropdown selection on the municipal fact."""
    pop = model["populacao_municipio"]
    if column in pop.columns:
        pop = pop.filter(F.col(column).isin(list(values)))
    else:
        dim = model["dim_uf"].filter(F.col(column).isin(list(values))).select("uf_id")
        pop = jn.keep_matching(pop, dim, "uf_id", broadcast=True)
    return {**model, "populacao_municipio": pop}


def unemployment_table(model: Model, years: Sequence[int] = UNEMPLOYMENT_YEARS) -> DataFrame:
    """Q1: year x state, mean of per-quarter-label means; sorted by year."""
    f = jn.attach_dimension(model["desemprego_uf_trimestre"], model["dim_uf"], "uf_id", "left")
    f = f.filter(F.col("ano").isin(list(years)))
    out = agg.avg_of_avgs(f, ["ano", "uf_sigla"], "trimestre", "taxa_desocupacao_pct",
                          "taxa_desemprego_media_anual")
    return out.orderBy("ano", "uf_sigla")


def unemployment_by_state(model: Model) -> DataFrame:
    """Q2: per state, the measure over all quarters (labels merge years)."""
    f = jn.attach_dimension(model["desemprego_uf_trimestre"], model["dim_uf"], "uf_id", "left")
    out = agg.avg_of_avgs(f, ["uf_sigla"], "trimestre", "taxa_desocupacao_pct", "taxa_desemprego_media_anual")
    return rs.order_by_measure(out, "taxa_desemprego_media_anual", ["uf_sigla"])


def population_by_region(model: Model) -> DataFrame:
    """Q3: population sum per region, descending."""
    out = _pop(model).groupBy("regiao").agg(F.sum("populacao").alias("populacao"))
    return rs.order_by_measure(out, "populacao", ["regiao"])


def mean_population_by_state(model: Model) -> DataFrame:
    """Q4: average municipal population per state, descending."""
    out = _pop(model).groupBy("uf_sigla").agg(F.avg("populacao").alias("media_populacao"))
    return rs.order_by_measure(out, "media_populacao", ["uf_sigla"])


def year_count_by_state(model: Model) -> DataFrame:
    """Q5: non-null count of year per state, descending."""
    out = _pop(model).groupBy("uf_sigla").agg(F.count("ano").alias("contagem_ano"))
    return rs.order_by_measure(out, "contagem_ano", ["uf_sigla"])


def state_count_by_year_region(model: Model) -> DataFrame:
    """Q6: year x region, non-null count of state code, sorted by year.

    The axis is the year of the yearly summary, reached over the relationship;
    fact rows of a year without a summary count under a blank year.  The fact
    is counted by its own year first, so a year and region is one row of the join.
    """
    counts = _pop(model).groupBy(F.col("ano").alias("_ano"), "regiao").agg(F.count("uf_sigla").alias("_n"))
    axis = model["resumo_ano"].select(F.year("ano").alias("ano")).distinct()
    out = counts.join(axis, F.col("_ano") == F.col("ano"), "left").groupBy("ano", "regiao").agg(
        F.sum("_n").alias("contagem_uf"))
    return out.orderBy("ano", "regiao")


def cpi_matrix(model: Model, years: Sequence[int]) -> DataFrame:
    """Q7: area -> group rows x year columns of the minimum 12-month rate.

    Sorted as the matrix shows it under its (hidden) sort measure, the
    non-null count of the group label, descending at every level: areas by
    their count, groups within an area by theirs, each area's subtotal row
    after its groups and the grand total last.
    """
    m = agg.matrix(model["ipca_area_mes"], "area_ipca", "grupo_ipca", "ano", "acumulado_12_meses_pct", years, "min",
                   name_fn=lambda y: f"ano_{y}", counted="grupo_ipca")
    # an area's count is that of its subtotal row, so the few wide rows hold all sort keys
    of_area = Window.partitionBy(F.col("nivel") == 3, "area_ipca")
    area_count = F.max(F.when(F.col("nivel") == 1, F.col("contagem"))).over(of_area)
    return (m.withColumn("_area", area_count)
            .orderBy((F.col("nivel") == 3).asc(), F.col("_area").desc_nulls_last(), F.col("area_ipca").asc_nulls_last(),
                     F.col("nivel").asc(), F.col("contagem").desc_nulls_last(), F.col("grupo_ipca").asc_nulls_last())
            .drop("_area", "contagem"))


def matrix_years(model: Model) -> list[int]:
    """The years of the CPI table, ascending: the columns its matrix shows.
    The driver gets one row a year."""
    return [r.ano for r in agg.value_list(model["ipca_area_mes"].filter(F.col("ano").isNotNull()), "ano").collect()]


def cards(model: Model) -> DataFrame:
    """Q8-Q11 as one long table ``(cartao, valor)``.

    Mean growth and total change come from the municipal fact; total
    population and the municipality card from the yearly summary.  The
    municipality card sums ``qtd_municipios``, as its aggregate code
    (0 = sum) says, whatever its label.
    """
    p = model["populacao_municipio"].agg(
        F.avg("crescimento_pct").cast("double").alias("crescimento_medio_pct"),
        F.sum("variacao_absoluta").cast("double").alias("variacao_absoluta_total"))
    r = model["resumo_ano"].agg(F.sum("populacao_total").cast("double").alias("populacao_total"),
                                F.sum("qtd_municipios").cast("double").alias("qtd_municipios"))
    long = [d.select(F.lit(c).alias("cartao"), F.col(c).alias("valor"))
            for d in (p, r) for c in d.columns]
    return rs.union_frames(long)


def dropdown(model: Model, column: str) -> DataFrame:
    """Q13-Q15 (and the Q12 year list): distinct sorted slicer values."""
    src = _pop(model)
    return agg.value_list(src, column)


def population_page(model: Model, years: Sequence[int] | None = tuple(DEFAULT_YEARS),
                    regions: Sequence[str] | None = None, states: Sequence[str] | None = None,
                    municipalities: Sequence[str] | None = None,
                    cpi_years: Sequence[int] | None = None) -> dict[str, DataFrame]:
    """Every visual of the population page under its slicers (Q12-Q15).

    The year slicer reaches the municipal fact through the yearly summary
    (two hops); region / state / municipality slicers filter the municipal
    fact.  The unemployment and CPI visuals are not related to those
    slicers in the model and ignore them.  The inflation matrix shows
    ``cpi_years``, by default every year of its table.
    """
    m = year_slicer(model, list(years) if years else None)
    for column, values in (("regiao", regions), ("uf_sigla", states), ("municipio_nome", municipalities)):
        if values:
            m = attribute_slicer(m, column, values)
    visuals = {
        "populacao_por_regiao": population_by_region(m),
        "media_populacao_por_uf": mean_population_by_state(m),
        "contagem_ano_por_uf": year_count_by_state(m),
        "contagem_uf_por_ano_regiao": state_count_by_year_region(m),
        "cartoes": cards(m),
        "desemprego_por_uf": unemployment_by_state(model),
        "lista_regioes": dropdown(model, "regiao"),
        "lista_ufs": dropdown(model, "uf_sigla"),
        "lista_municipios": dropdown(model, "municipio_nome"),
    }
    if "ipca_area_mes" in model:
        visuals["matriz_ipca"] = cpi_matrix(model, cpi_years or matrix_years(model))
    return visuals
