"""File imports over TESTDATA: giant documents, checked CSV imports, file columns.

Each query lands files derived from the tables and reads them back through the
library's readers; ``ORACLE_SQL`` states the rows over the tables themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import contracts as ct
from ..operators import flatten as fl
from ..sources import delimited as dl
from ..sources import readers as rd
from . import datasets as ds
from .oracle import ORACLE_SQL as BASE_SQL
from .testdata import CUSTOMER_CSV_CONTRACT, _landing_folder, _population_documents, _t

# Places of one landed document: as many as one request for all municipalities returns.
PLACES_PER_DOCUMENT = 5_571
CSV_COLUMNS = CUSTOMER_CSV_CONTRACT.columns
# Layout of the landed customer files by market segment (columns of the header).
SWAPPED = ["c_mktsegment", "c_acctbal", "c_nationkey", "c_name", "c_custkey"]
LACKING = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_phone"]


def giant_document_recipe(spark, sf_dir):
    """Population documents with up to 5,571 places in one result, landed as
    JSON and flattened with their series spread over the shuffle's partitions;
    equals ``population_recipe``."""
    one = _population_documents(spark, sf_dir)
    place = F.col("resultados")[0]["series"][0]
    number = F.floor(place["localidade"]["id"].cast("long") / PLACES_PER_DOCUMENT)
    series = F.collect_list(place).alias("series")  # bounded: PLACES_PER_DOCUMENT places
    whole = one.groupBy("id", "variavel", "unidade", number.alias("documento")).agg(series).select(
        "id", "variavel", "unidade",
        F.array(F.struct(F.array().cast("array<struct<id:string,nome:string,categoria:map<string,string>>>")
                         .alias("classificacoes"), "series")).alias("resultados"))
    folder = _landing_folder(spark, "documentos_grandes")
    whole.write.mode("error").json(folder)
    raw = rd.read_nested(spark, folder, mode="FAILFAST", with_file=False, multi_line=False)
    return ds.populacao_municipio(fl.flatten_nested(raw, spread=True))


def _write_lines(df: DataFrame, header: list[str], line, folder: str) -> None:
    """Lines under a header: one text column whose name is the header, with a
    delimiter of the writer's own that no line holds."""
    df.select(line.alias(",".join(header))).write.mode("error").option("header", True).option("sep", "\t").csv(folder)


def _customer_files(spark, sf_dir) -> str:
    """Customers landed as CSV in five layouts, one a market segment: declared
    order, columns swapped, last field missing on odd keys, a field too many on
    keys divisible by three, and a header without a declared column."""
    c = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        F.format_string("%.2f", F.col("c_acctbal")).alias("c_acctbal"), "c_mktsegment",
        F.col("c_custkey").alias("n"), F.lit("x").alias("c_phone"))
    root = _landing_folder(spark, "clientes_largura")
    plain, short = F.concat_ws(",", *CSV_COLUMNS), F.concat_ws(",", *CSV_COLUMNS[:-1])
    layouts = {
        "BUILDING": (CSV_COLUMNS, plain),
        "MACHINERY": (SWAPPED, F.concat_ws(",", *SWAPPED)),
        "HOUSEHOLD": (CSV_COLUMNS, F.when(F.col("n") % 2 == 1, short).otherwise(plain)),
        "AUTOMOBILE": (CSV_COLUMNS, F.when(F.col("n") % 3 == 0, F.concat(plain, F.lit(",x"))).otherwise(plain)),
        "FURNITURE": (LACKING, F.concat_ws(",", *LACKING)),
    }
    for segment, (header, line) in layouts.items():
        _write_lines(c.filter(F.col("c_mktsegment") == segment), header, line, f"{root}/{segment.lower()}")
    return root


def _layout(path: str = "arquivo_caminho"):
    return F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1)


def _imported(spark, sf_dir) -> dl.Delimited:
    return dl.read_delimited(spark, f"{_customer_files(spark, sf_dir)}/*", CSV_COLUMNS)


def csv_checked_import(spark, sf_dir):
    """S7: the sound lines of all layouts, columns matched by header name and
    converted by the contract's types."""
    typed, _ = ct.typed_by_contract(CUSTOMER_CSV_CONTRACT, _imported(spark, sf_dir).rows)
    return typed


def csv_import_report(spark, sf_dir):
    """S7: per layout the lines taken in (``aproveitada``) and refused, by reason."""
    taken = _imported(spark, sf_dir)
    every = taken.rows.select(_layout().alias("lote"), F.lit("aproveitada").alias("motivo")).unionByName(
        taken.rejects.select(_layout().alias("lote"), "motivo"))
    return every.groupBy("lote", "motivo").agg(F.count(F.lit(1)).alias("linhas"))


def file_columns_report(spark, sf_dir):
    """A6, U2: file profile with the column list of each file and its difference
    from the declared columns, summed up by layout (files that differ in layout
    have different column lists)."""
    taken = _imported(spark, sf_dir)
    profile = agg.file_profile(taken.rows, ["c_custkey"], "arquivo_caminho")
    files = agg.with_columns_of_files(profile, taken.files)
    joined = lambda c: F.array_join(c, ",").alias(c)
    return (files.groupBy(_layout().alias("lote"), joined("colunas"), joined("faltam"), joined("sobram"))
            .agg(F.sum("linhas").alias("linhas"), F.sum("chaves_duplicadas").alias("chaves_duplicadas"),
                 F.sum("celulas_nulas").alias("celulas_nulas")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "giant_document_recipe": giant_document_recipe,
    "csv_checked_import": csv_checked_import,
    "csv_import_report": csv_import_report,
    "file_columns_report": file_columns_report,
}

_TAKEN = """(c_mktsegment IN ('BUILDING', 'MACHINERY') OR (c_mktsegment = 'HOUSEHOLD' AND c_custkey % 2 = 0)
   OR (c_mktsegment = 'AUTOMOBILE' AND c_custkey % 3 <> 0))"""

ORACLE_SQL: dict[str, str] = {
    "giant_document_recipe": BASE_SQL["population_recipe"],
    "csv_checked_import": f"""
SELECT c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
       CAST(printf('%.2f', c_acctbal) AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment
FROM customer WHERE {_TAKEN}""",
    "csv_import_report": f"""
SELECT lower(c_mktsegment) AS lote,
       CASE WHEN {_TAKEN} THEN 'aproveitada' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'curta'
            WHEN c_mktsegment = 'AUTOMOBILE' THEN 'longa' ELSE 'cabecalho' END AS motivo, count(*) AS linhas
FROM customer GROUP BY 1, 2""",
    "file_columns_report": f"""
SELECT lower(c_mktsegment) AS lote,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'c_mktsegment,c_acctbal,c_nationkey,c_name,c_custkey'
            WHEN 'FURNITURE' THEN 'c_custkey,c_name,c_nationkey,c_mktsegment,c_phone'
            ELSE 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' END AS colunas,
       CASE c_mktsegment WHEN 'FURNITURE' THEN 'c_acctbal' ELSE '' END AS faltam,
       CASE c_mktsegment WHEN 'FURNITURE' THEN 'c_phone' ELSE '' END AS sobram,
       CAST(count(*) FILTER (WHERE {_TAKEN}) AS BIGINT) AS linhas,
       CAST(0 AS BIGINT) AS chaves_duplicadas, CAST(0 AS BIGINT) AS celulas_nulas
FROM customer GROUP BY c_mktsegment""",
}
