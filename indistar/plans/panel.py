"""Panel queries over TESTDATA: slicers through the relationship graph, the
lists of the slicers, and dataset tables of the published model."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import aggregates as agg
from ..operators import contracts as ct
from ..operators import flatten as fl
from ..operators import publish as pb
from ..operators import reshape as rs
from ..operators.model import StarModel
from ..sources import catalog as cat
from ..sources import snapshots as sn
from . import datasets as ds
from . import reports as rp
from .oracle import ORACLE_SQL as BASE_SQL, _GEO, _NATIONAL
from .testdata import (EVENT_SERIES_CATALOG, SEX_TOTAL, STATE_CODE_OFFSET, _landing_folder, _national_documents,
                       _population_model, _t, age_band_recipe, cpi_recipe, unemployment_recipe, union_series)

# Fixed slicer selections of the panel queries.
YEARS = [1996, 1997, 1998]
REGIONS = ["AMERICA", "ASIA"]
STATES = ["NATION_1", "NATION_2", "NATION_3", "NATION_16"]
MUNICIPALITIES = ["Customer#000000001", "Customer#000000002", "Customer#000000010", "Customer#000000100"]
CHOSEN_SERIES = ["click", "view"]
FIRST_PUBLISHED_BEFORE = dt.date(1998, 1, 1)
FACT = "populacao_municipio"


def _panel(spark, sf_dir) -> StarModel:
    return rp.panel_model(_population_model(spark, sf_dir))


def page_slicer_region(spark, sf_dir):
    """Q13 with Q12 and Q6: several years and regions; the axis is the summary's year."""
    m = _panel(spark, sf_dir).slice({("calendario", "ano"): YEARS, (FACT, "regiao"): REGIONS})
    return rp.state_count_by_year_region(m.tables)


def page_slicer_state(spark, sf_dir):
    """Q14 with Q12 and Q4: several years and states."""
    m = _panel(spark, sf_dir).slice({("calendario", "ano"): YEARS, (FACT, "uf_sigla"): STATES})
    return rp.mean_population_by_state(m.tables).withColumn("media_populacao", F.round("media_populacao", 4))


def page_slicer_municipality(spark, sf_dir):
    """Q15 with Q8-Q11: the cards under a choice of municipalities; the cards of
    the yearly summary do not follow it (the summary is on the one side)."""
    m = _panel(spark, sf_dir).slice({("calendario", "ano"): YEARS, (FACT, "municipio_nome"): MUNICIPALITIES})
    return rp.cards(m.tables).withColumn("valor", F.round("valor", 4))


def slicer_lists(spark, sf_dir):
    """Q12-Q15: what each slicer's list offers while the others are set."""
    model = _panel(spark, sf_dir)
    chosen = {("calendario", "ano"): YEARS, (FACT, "regiao"): REGIONS, (FACT, "uf_sigla"): STATES}
    columns = [("resumo_ano", "ano"), (FACT, "regiao"), (FACT, "uf_sigla"), (FACT, "municipio_nome")]
    lists = [rp.slicer_list(model, t, c, chosen).select(F.lit(c).alias("lista"), F.col(c).cast("string").alias("valor"))
             for t, c in columns]
    return rs.union_frames(lists)


def sliced_row_counts(spark, sf_dir):
    """J4: rows of every table under a slicer of the state dimension and one of
    the summary's calendar; each reaches the tables on its many sides only."""
    offset = F.lit(STATE_CODE_OFFSET)
    tables = {**_population_model(spark, sf_dir), "ipca_area_mes": cpi_recipe(spark, sf_dir),
              "desemprego_uf_trimestre": unemployment_recipe(spark, sf_dir).withColumn("uf_id", F.col("uf_id") + offset),
              "faixa_etaria_uf": age_band_recipe(spark, sf_dir).filter(F.col("sexo") == SEX_TOTAL[1])
              .withColumn("uf_id", F.col("uf_id") + offset)}
    m = rp.panel_model(tables).slice({("dim_uf", "regiao"): REGIONS, ("calendario", "ano"): YEARS})
    return agg.row_counts(m.tables)


def pib_persons_recipe(spark, sf_dir):
    return ds.pib_tables(fl.flatten_nested(_national_documents(spark, sf_dir)))["PIB_pessoas"]


def pib_percent_recipe(spark, sf_dir):
    return ds.pib_tables(fl.flatten_nested(_national_documents(spark, sf_dir)))["PIB_percentual"]


def per_series_tables(spark, sf_dir):
    """X9 and S8: one table a chosen series, by its fixed id, under its name."""
    chosen = sn.select_datasets(EVENT_SERIES_CATALOG, CHOSEN_SERIES)
    tables = ds.bacen_per_series(union_series(spark, sf_dir), chosen)
    return rs.union_frames([t.select(F.lit(name).alias("tabela"), "*") for name, t in tables.items()])


def state_attributes(spark, sf_dir):
    """X1, S5: customers by the state whose code is their nation's number + 11,
    with the state dimension's attributes; codes without a state stay, blank."""
    c = _t(spark, sf_dir, "customer").groupBy((F.col("c_nationkey") + 11).cast("int").alias("uf_id")).agg(
        F.count(F.lit(1)).alias("municipios"))
    return ds.with_state(c, ds.dim_uf(spark).withColumn("uf_id", F.col("uf_id").cast("int")))


UNIQUE_CONTRACT = ct.Contract(
    name="eventos_por_dia",
    schema=T.StructType([T.StructField("serie_id", T.IntegerType()), T.StructField("user_id", T.LongType()),
                         T.StructField("data_referencia", T.DateType()), T.StructField("ordem", T.LongType())]),
    key=["ordem"], unique=[["user_id", "data_referencia"]], fixed={"serie_id": 1})


def contract_unique_fixed(spark, sf_dir):
    """C4, C7: a daily table declared to hold series 1 alone and one row a user
    and day, checked on events of all series."""
    names = cat.series_catalog(spark, EVENT_SERIES_CATALOG).select(F.col("serie").alias("event_type"), "serie_id")
    e = _t(spark, sf_dir, "events").join(F.broadcast(names), "event_type", "left")
    return ct.violations(UNIQUE_CONTRACT, e.select("serie_id", "user_id", F.to_date("ts").alias("data_referencia"),
                                                   F.col("event_id").alias("ordem")))


def published_snapshots(spark, sf_dir):
    """K1: orders up to a day published, then published whole; the first version
    is read back by its commit number next to the current one."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("data_referencia"), "o_totalprice")
    root = _landing_folder(spark, "publicada") + "/pedidos"
    contract = ct.Contract("pedidos", o.schema, key=["o_orderkey"], not_null=["o_orderkey"])
    pb.publish(o.filter(F.col("data_referencia") < F.lit(FIRST_PUBLISHED_BEFORE)), root, contract)
    first = pb.current_version(spark, root)
    pb.publish(o, root, contract)
    both = [("primeira", pb.read_current(spark, root, first)), ("atual", pb.read_current(spark, root))]
    return rs.union_frames([d.groupBy(F.lit(n).alias("versao"), F.year("data_referencia").alias("ano")).agg(
        F.count(F.lit(1)).alias("linhas"), F.round(F.sum("o_totalprice"), 2).alias("total")) for n, d in both])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "page_slicer_region": page_slicer_region,
    "page_slicer_state": page_slicer_state,
    "page_slicer_municipality": page_slicer_municipality,
    "slicer_lists": slicer_lists,
    "sliced_row_counts": sliced_row_counts,
    "pib_persons_recipe": pib_persons_recipe,
    "pib_percent_recipe": pib_percent_recipe,
    "per_series_tables": per_series_tables,
    "state_attributes": state_attributes,
    "contract_unique_fixed": contract_unique_fixed,
    "published_snapshots": published_snapshots,
}


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


_FACT = f"""
WITH p AS (SELECT n.n_name AS uf_sigla, r.r_name AS regiao, o.o_custkey, c.c_name AS municipio_nome,
                  CAST(year(o.o_orderdate) AS INTEGER) AS ano, count(*) AS pop {_GEO} GROUP BY ALL)"""

_STATE_ROWS = ", ".join(f"({i}, '{s}', '{n}', '{r}')" for i, s, n, r in cat.STATES)

ORACLE_SQL: dict[str, str] = {
    "page_slicer_region": f"""{_FACT}
SELECT ano, regiao, count(uf_sigla) AS contagem_uf FROM p WHERE ano IN {_in(YEARS)} AND regiao IN {_in(REGIONS)}
GROUP BY ano, regiao""",
    "page_slicer_state": f"""{_FACT}
SELECT uf_sigla, round(avg(pop), 4) AS media_populacao FROM p WHERE ano IN {_in(YEARS)} AND uf_sigla IN {_in(STATES)}
GROUP BY uf_sigla""",
    "page_slicer_municipality": f"""{_FACT},
l AS (SELECT *, lag(ano) OVER w AS pa, lag(pop) OVER w AS pv FROM p WINDOW w AS (PARTITION BY o_custkey ORDER BY ano)),
g AS (SELECT ano, municipio_nome, pop, CASE WHEN pa = ano - 1 THEN pv END AS prev FROM l WHERE ano IN {_in(YEARS)}),
h AS (SELECT pop - prev AS variacao, CASE WHEN prev <> 0 THEN round(100.0::DOUBLE * (pop - prev) / prev, 2) END AS crescimento
      FROM g WHERE municipio_nome IN {_in(MUNICIPALITIES)})
SELECT 'crescimento_medio_pct' AS cartao, round(avg(crescimento), 4) AS valor FROM h
UNION ALL SELECT 'variacao_absoluta_total', round(CAST(sum(variacao) AS DOUBLE), 4) FROM h
UNION ALL SELECT 'populacao_total', round(CAST(sum(pop) AS DOUBLE), 4) FROM g
UNION ALL SELECT 'qtd_municipios', round(CAST(count(*) AS DOUBLE), 4) FROM g""",
    "slicer_lists": f"""{_FACT},
a AS (SELECT * FROM p WHERE ano IN {_in(YEARS)})
SELECT DISTINCT 'ano' AS lista, CAST(make_date(ano, 1, 1) AS VARCHAR) AS valor FROM a
UNION ALL SELECT DISTINCT 'regiao', regiao FROM a WHERE uf_sigla IN {_in(STATES)}
UNION ALL SELECT DISTINCT 'uf_sigla', uf_sigla FROM a WHERE regiao IN {_in(REGIONS)}
UNION ALL SELECT DISTINCT 'municipio_nome', municipio_nome FROM a WHERE regiao IN {_in(REGIONS)} AND uf_sigla IN {_in(STATES)}""",
    "sliced_row_counts": f"""{_FACT},
s AS (SELECT n.n_name, r.r_name, CAST(year(o.o_orderdate) AS INTEGER) AS ano, quarter(o.o_orderdate) AS q,
             month(o.o_orderdate) AS m, substr(o.o_orderpriority, 1, 1) AS idade, o.o_orderpriority {_GEO})
SELECT 'populacao_municipio' AS tabela, count(*) AS linhas FROM p WHERE ano IN {_in(YEARS)} AND regiao IN {_in(REGIONS)}
UNION ALL SELECT 'resumo_ano', count(DISTINCT ano) FROM p WHERE ano IN {_in(YEARS)}
UNION ALL SELECT 'calendario', CAST(sum(dayofyear(make_date(ano, 12, 31))) AS BIGINT) FROM (SELECT DISTINCT ano FROM p WHERE ano IN {_in(YEARS)})
UNION ALL SELECT 'dim_uf', count(*) FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN {_in(REGIONS)}
UNION ALL SELECT 'desemprego_uf_trimestre', count(DISTINCT (n_name, ano, q)) FROM s WHERE r_name IN {_in(REGIONS)}
UNION ALL SELECT 'faixa_etaria_uf', count(DISTINCT (n_name, ano, idade)) FROM s WHERE r_name IN {_in(REGIONS)}
UNION ALL SELECT 'ipca_area_mes', count(DISTINCT (r_name, o_orderpriority, ano, m)) FROM s""",
    "pib_persons_recipe": _NATIONAL + """
SELECT variavel_id, variavel_nome, unidade, make_date(ano, 1, 1) AS data_referencia, ano,
       CAST(valor AS BIGINT) AS populacao_mil_pessoas FROM v WHERE variavel_id = 93""",
    "pib_percent_recipe": _NATIONAL + """
SELECT variavel_id, variavel_nome, unidade, make_date(ano, 1, 1) AS data_referencia, ano,
       CAST(valor AS DECIMAL(10,2)) AS valor_percentual FROM v WHERE variavel_id IN (9810, 9811, 9814)""",
    "per_series_tables": f"""
SELECT serie AS tabela, * FROM ({BASE_SQL["union_series"]}) WHERE serie IN {_in(CHOSEN_SERIES)}""",
    "state_attributes": f"""
WITH uf(uf_id, uf_sigla, uf_nome, regiao) AS (VALUES {_STATE_ROWS}),
c AS (SELECT CAST(c_nationkey + 11 AS INTEGER) AS uf_id, count(*) AS municipios FROM customer GROUP BY 1)
SELECT c.uf_id, municipios, uf_sigla, uf_nome, regiao FROM c LEFT JOIN uf ON c.uf_id = uf.uf_id""",
    "contract_unique_fixed": """
SELECT 'eventos_por_dia' AS tabela, 'valor_fixo' AS regra, 'serie_id' AS coluna, count(*) FILTER (WHERE event_type <> 'click') AS violacoes
FROM events
UNION ALL SELECT 'eventos_por_dia', 'chave_primaria', 'ordem', count(*) - count(DISTINCT event_id) FROM events
UNION ALL SELECT 'eventos_por_dia', 'unico', 'user_id,data_referencia',
          CAST(sum(k - 1) AS BIGINT) FROM (SELECT count(*) AS k FROM events GROUP BY user_id, CAST(ts AS DATE))""",
    "published_snapshots": f"""
WITH v AS (SELECT 'atual' AS versao, * FROM orders
           UNION ALL SELECT 'primeira', * FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '{FIRST_PUBLISHED_BEFORE}')
SELECT versao, CAST(year(o_orderdate) AS INTEGER) AS ano, count(*) AS linhas, round(sum(o_totalprice), 2) AS total
FROM v GROUP BY 1, 2""",
}
