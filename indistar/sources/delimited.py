"""Delimited text taken in by header name and width, with nothing lost quietly.

The files are read as lines and split by the delimiter with quoting off, as
the panel's imports declare it.  Each file's own header says which field is
which column, so files with their columns in another order read right, and each
line's field count is held against its header.  Lines that do not fit
become rows of a reject table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BYTE_ORDER_MARK = "\ufeff"
#: Reject reasons: the header lacks or repeats a declared column or names an
#: undeclared one; the line has fewer or more fields than its header.
BAD_HEADER, SHORT, LONG = "cabecalho", "curta", "longa"
BROADCAST_FILES = 20_000


@dataclass
class Delimited:
    """``rows``: the declared columns as text, with ``arquivo_caminho``;
    ``rejects``: ``(arquivo_caminho, motivo, linha)``; ``files``: per file its
    column list and how it differs from the declared one."""
    rows: DataFrame
    rejects: DataFrame
    files: DataFrame


def _lines(spark: SparkSession, paths) -> DataFrame:
    """Every line with its file, the place of its split in the file and an
    ascending number.  Nothing is pushed below a number, so every plan over
    these lines cuts the files alike and numbers them alike."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.text(paths).select(
        F.col("value").alias("linha"), F.col("_metadata.file_path").alias("arquivo_caminho"),
        F.col("_metadata.file_block_start").alias("_inicio")).withColumn("_numero", F.monotonically_increasing_id())


def split_fields(line: Column, delimiter: str = ",") -> Column:
    """Fields of a line, quoting off; empty fields at the end count."""
    return F.split(line, re.escape(delimiter), -1)


def _headers(lines: DataFrame, delimiter: str) -> DataFrame:
    first = lines.filter(F.col("_inicio") == 0).groupBy("arquivo_caminho").agg(
        F.min_by("linha", "_numero").alias("cabecalho"), F.min("_numero").alias("_primeira"))
    text = F.regexp_replace("cabecalho", f"^{BYTE_ORDER_MARK}", "")
    return first.withColumn("colunas", F.transform(split_fields(text, delimiter), lambda c: F.trim(c)))


def file_headers(spark: SparkSession, paths, delimiter: str = ",") -> DataFrame:
    """``(arquivo_caminho, colunas)``: the column list of each file, from its first line.

    The first line of a file is the first row of the split that starts at byte
    zero; a split is read in order by one task, so its rows have ascending
    numbers.  The aggregate keeps one line a file and is combined before the
    shuffle.  Blank space around names and a byte order mark are removed.  A
    file without a line has no row.
    """
    return _headers(_lines(spark, paths), delimiter).select("arquivo_caminho", "colunas")


def column_differences(files: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column-set difference of each file against the declared columns:
    ``faltam`` (declared, not there), ``sobram`` (there, not declared) and
    ``repetidas``, each sorted."""
    declared = F.array(*[F.lit(c) for c in columns])
    there = F.col("colunas")
    repeated = F.filter(F.array_distinct(there), lambda c: F.size(F.filter(there, lambda x: x == c)) > 1)
    return files.withColumns({"faltam": F.array_sort(F.array_except(declared, there)),
                              "sobram": F.array_sort(F.array_except(there, declared)),
                              "repetidas": F.array_sort(repeated)})


def read_delimited(spark: SparkSession, paths, columns: Sequence[str], delimiter: str = ",") -> Delimited:
    """Files with a header as the declared columns, matched by name.

    Every line but each file's first one is either a row or a reject: one with
    more or fewer fields than its header is ``longa`` or ``curta``, and
    every line of a file whose header is not a permutation of ``columns`` is
    ``cabecalho``.  An empty field is null; a blank line is a line with one
    empty field, as it is for a loader with quoting off.  A line equal to its header
    that comes again further down is data.
    """
    lines = _lines(spark, paths)
    known = column_differences(_headers(lines, delimiter), columns)
    # one small row a file: sent to every task up to BROADCAST_FILES files (the
    # listing that Spark has made says how many), joined by file beyond
    few = len(lines.inputFiles()) <= BROADCAST_FILES
    data = lines.join(F.broadcast(known) if few else known, "arquivo_caminho").filter(F.col("_numero") != F.col("_primeira"))
    fields, wanted = split_fields(F.col("linha"), delimiter), F.size("colunas")
    sound = (F.size("faltam") == 0) & (F.size("sobram") == 0) & (F.size("repetidas") == 0)
    data = data.withColumn("_campos", fields).withColumn(
        "motivo", F.when(~sound, BAD_HEADER).when(F.size("_campos") < wanted, SHORT).when(F.size("_campos") > wanted, LONG))

    def field_of(name: str) -> Column:
        at = F.array_position("colunas", F.lit(name)).cast("int") - 1
        return F.nullif(F.get("_campos", at), F.lit("")).alias(name)
    return Delimited(
        data.filter(F.col("motivo").isNull()).select(*[field_of(c) for c in columns], "arquivo_caminho"),
        data.filter(F.col("motivo").isNotNull()).select("arquivo_caminho", "motivo", "linha"),
        known.drop("cabecalho", "_primeira"))
