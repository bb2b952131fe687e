"""Declarative catalogs, the inline state dimension and date windows.

Catalogs are tiny, fixed-size config tables: they are broadcast-joined to
facts instead of being stamped in as one literal per file.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Published catalogs (codes, names, units, periodicity).
# ---------------------------------------------------------------------------
SERIES = {
    "selic_meta": {"codigo": 432, "nome": "Meta Selic", "unidade": "% a.a.", "periodicidade": "diaria"},
    "selic_efetiva": {"codigo": 1178, "nome": "Taxa Selic efetiva anualizada", "unidade": "% a.a.", "periodicidade": "diaria"},
    "cdi": {"codigo": 12, "nome": "Taxa de juros CDI", "unidade": "% a.d.", "periodicidade": "diaria"},
    "dolar_venda": {"codigo": 1, "nome": "Taxa de câmbio - dólar americano (venda)", "unidade": "R$/US$", "periodicidade": "diaria"},
}

AGE_CATEGORIES = ("93070,93084,93085,93086,93087,93088,93089,93090,93091,"
                  "93092,93093,93094,93095,93096,93097,93098,49108,49109,"
                  "60040,60041,6653")
CPI_GROUPS = "7169,7170,7445,7486,7558,7625,7660,7712,7766,7786"
INDICATORS = {
    "populacao": {"agregado": "6579", "periodos": "2012-2021", "variaveis": "9324",
                  "localidades": "N6[all]", "classificacao": None},
    "pib": {"agregado": "6784", "periodos": "2012-2021", "variaveis": "all",
            "localidades": "N1[all]", "classificacao": None},
    "faixa_etaria": {"agregado": "9514", "periodos": "2022", "variaveis": "93",
                     "localidades": "N3[all]",
                     "classificacao": f"2[6794,4,5]|287[{AGE_CATEGORIES}]|286[113635]"},
    "desemprego": {"agregado": "4099", "periodos": "all", "variaveis": "4099,4118",
                   "localidades": "N3[all]", "classificacao": None},
    "ipca": {"agregado": "7060", "periodos": "all", "variaveis": "63,69,2265,66",
             "localidades": "N7[all]", "classificacao": f"315[{CPI_GROUPS}]"},
}

# State dimension: (uf_id, uf_sigla, uf_nome, regiao).
STATES = [
    (11, "RO", "Rondônia", "Norte"),
    (12, "AC", "Acre", "Norte"),
    (13, "AM", "Amazonas", "Norte"),
    (14, "RR", "Roraima", "Norte"),
    (15, "PA", "Pará", "Norte"),
    (16, "AP", "Amapá", "Norte"),
    (17, "TO", "Tocantins", "Norte"),
    (21, "MA", "Maranhão", "Nordeste"),
    (22, "PI", "Piauí", "Nordeste"),
    (23, "CE", "Ceará", "Nordeste"),
    (24, "RN", "Rio Grande do Norte", "Nordeste"),
    (25, "PB", "Paraíba", "Nordeste"),
    (26, "PE", "Pernambuco", "Nordeste"),
    (27, "AL", "Alagoas", "Nordeste"),
    (28, "SE", "Sergipe", "Nordeste"),
    (29, "BA", "Bahia", "Nordeste"),
    (31, "MG", "Minas Gerais", "Sudeste"),
    (32, "ES", "Espírito Santo", "Sudeste"),
    (33, "RJ", "Rio de Janeiro", "Sudeste"),
    (35, "SP", "São Paulo", "Sudeste"),
    (41, "PR", "Paraná", "Sul"),
    (42, "SC", "Santa Catarina", "Sul"),
    (43, "RS", "Rio Grande do Sul", "Sul"),
    (50, "MS", "Mato Grosso do Sul", "Centro-Oeste"),
    (51, "MT", "Mato Grosso", "Centro-Oeste"),
    (52, "GO", "Goiás", "Centro-Oeste"),
    (53, "DF", "Distrito Federal", "Centro-Oeste"),
]

STATE_SCHEMA = T.StructType([
    T.StructField("uf_id", T.ShortType(), False),
    T.StructField("uf_sigla", T.StringType(), False),
    T.StructField("uf_nome", T.StringType(), False),
    T.StructField("regiao", T.StringType(), False),
])

SERIES_SCHEMA = T.StructType([
    T.StructField("serie", T.StringType(), False),
    T.StructField("serie_id", T.IntegerType(), False),
    T.StructField("indicador", T.StringType(), False),
    T.StructField("unidade", T.StringType(), False),
    T.StructField("periodicidade", T.StringType(), False),
])


def state_dimension(spark: SparkSession) -> DataFrame:
    """The 27-row state dimension (fixed size: safe to broadcast)."""
    return spark.createDataFrame(STATES, STATE_SCHEMA)


def series_catalog(spark: SparkSession, series: dict | None = None) -> DataFrame:
    series = SERIES if series is None else series
    rows = [(name, int(c["codigo"]), c["nome"], c["unidade"], c["periodicidade"])
            for name, c in series.items()]
    return spark.createDataFrame(rows, SERIES_SCHEMA)


def indicator_catalog(spark: SparkSession, indicators: dict | None = None) -> DataFrame:
    indicators = INDICATORS if indicators is None else indicators
    rows = [(name, c["agregado"], c["periodos"], c["variaveis"], c["localidades"], c["classificacao"])
            for name, c in indicators.items()]
    return spark.createDataFrame(
        rows, "dataset string, agregado string, periodos string, variaveis string, localidades string, "
              "classificacao string")


def date_range(df: DataFrame, date_col: str, start=None, end=None) -> DataFrame:
    """Inclusive ``[start, end]`` day filter; end defaults to today.

    On a timestamp column the bound becomes ``< end + 1 day`` so the whole
    last day is kept; both forms are plain comparisons Parquet can push down.
    """
    if end is None:
        end = _dt.date.today()
    if start is not None and start > end:
        raise ValueError(f"start {start} is after end {end}")
    c = F.col(date_col)
    if isinstance(df.schema[date_col].dataType, (T.TimestampType, T.TimestampNTZType)):
        kind = df.schema[date_col].dataType.simpleString()
        cond = c < F.lit(str(end + _dt.timedelta(days=1))).cast(kind)
        if start is not None:
            cond = cond & (c >= F.lit(str(start)).cast(kind))
    else:
        cond = c <= F.lit(end)
        if start is not None:
            cond = cond & (c >= F.lit(start))
    return df.filter(cond)


def window_table(bounds: DataFrame, start_col: str = "inicio", end_col: str = "fim",
                 years: int = 3, keys: list[str] | None = None) -> DataFrame:
    """Contiguous inclusive windows of ``years`` years covering each bound row.

    ``bounds`` has one row per series (optional ``keys``) with a start and an
    end date.  Each window starts on the ``years``-th anniversary of the
    previous start and ends the day before the next one, the last one
    clipped to the end.  A 29-Feb start moves to 28-Feb in the first
    anniversary year without a 29-Feb and stays on the 28th from then on,
    as a chain of year replacements does.  The table holds
    ``ceil(span/years)`` rows per series.
    """
    keys = keys or []
    s, e = F.col(start_col), F.col(end_col)
    last = F.floor(F.months_between(e, _anchor(s)) / (12 * years)).cast("int") + 1
    i = F.col("janela")
    rows = (bounds.filter(s <= e)
            .select(*keys, s.alias("_s"), e.alias("_e"), F.explode(F.sequence(F.lit(0), last)).alias("janela")))
    start, nxt = window_start(F.col("_s"), i, years), window_start(F.col("_s"), i + 1, years)
    return (rows.select(*keys, "janela", start.alias("janela_inicio"), F.least(F.date_sub(nxt, 1), F.col("_e")).alias("janela_fim"))
            .filter(F.col("janela_inicio") <= F.col("janela_fim")))


def _anchor(start: Column) -> Column:
    """The day whose anniversaries are the window starts: the 28th for a 29-Feb."""
    leap = (F.month(start) == 2) & (F.dayofmonth(start) == 29)
    return F.when(leap, F.date_sub(start, 1)).otherwise(start)


def window_start(start: Column, i: Column, years: int) -> Column:
    """First day of window ``i`` (from 0) of a chain that begins at ``start``."""
    def is_leap_year(y):
        return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)

    # a 29-Feb chain keeps the 29th while every anniversary year up to window i
    # has one; once it falls back it is anchored on the 28th
    kept = (F.month(start) == 2) & (F.dayofmonth(start) == 29) & ~F.exists(
        F.sequence(F.lit(1), F.greatest(i, F.lit(1))), lambda k: ~is_leap_year(F.year(start) + k * years))
    return (F.when(i == 0, start).when(kept, F.add_months(start, i * 12 * years))
            .otherwise(F.add_months(_anchor(start), i * 12 * years)))


def window_number(value: Column, start: Column, years: int) -> Column:
    """The window (from 0) of the chain from ``start`` that holds the day
    ``value``; the months between give it but for one, the starts decide."""
    guess = F.floor(F.months_between(value, _anchor(start)) / (12 * years)).cast("int")
    return (F.when(value < window_start(start, guess, years), guess - 1)
            .when(value >= window_start(start, guess + 1, years), guess + 1).otherwise(guess))
