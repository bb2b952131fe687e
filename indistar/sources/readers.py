"""File readers.

A landed document is one JSON array.  With ``multiLine`` the JSON reader
turns each array element into one row, so a whole folder of documents is
read by one scan with one task per file (a multi-line file cannot be split;
many files give the parallelism, ``repartition`` spreads a single giant one).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import FLAT_ITEM_SCHEMA, NESTED_VARIABLE_SCHEMA


_FILE_COLUMNS = {"file_name": "arquivo", "file_path": "arquivo_caminho", "file_modification_time": "arquivo_modificado"}


def _paths(paths) -> list[str]:
    if isinstance(paths, str):
        return [paths]
    return [str(p) for p in paths]


def read_json_documents(spark: SparkSession, paths, schema: T.StructType,
                        mode: str = "PERMISSIVE", with_file: bool = True,
                        multi_line: bool = True, recursive: bool = False) -> DataFrame:
    """Read JSON-array documents with an explicit element schema.

    ``PERMISSIVE`` keeps malformed files as one all-null row carrying the
    text in ``_corrupt_record`` (see ``contracts.document_problems``);
    ``FAILFAST`` raises instead.  ``with_file`` adds the source file name,
    path and modification time from the hidden ``_metadata`` column; a
    filter on them prunes files before they are opened.  ``recursive``
    reads every ``*.json`` file below the given folders.
    """
    read_schema = schema
    if mode == "PERMISSIVE":
        read_schema = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    reader = (spark.read.schema(read_schema)
              .option("multiLine", multi_line)
              .option("mode", mode)
              .option("columnNameOfCorruptRecord", "_corrupt_record"))
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    df = reader.json(_paths(paths))
    if with_file:
        df = df.select("*", *[F.col(f"_metadata.{m}").alias(n) for m, n in _FILE_COLUMNS.items()])
    return df


def read_nested(spark: SparkSession, paths, mode: str = "PERMISSIVE",
                with_file: bool = True, multi_line: bool = True) -> DataFrame:
    """Nested indicator documents: one row per variable element.

    ``multi_line=False`` reads JSON Lines (one element per line, as Spark's
    own JSON writer lands them), which splits across tasks.
    """
    return read_json_documents(spark, paths, NESTED_VARIABLE_SCHEMA, mode, with_file, multi_line)


def read_flat_series(spark: SparkSession, paths, mode: str = "PERMISSIVE",
                     with_file: bool = True, multi_line: bool = True,
                     recursive: bool = False) -> DataFrame:
    """Flat daily-series documents: one row per observation.

    One multi-path read replaces a per-file read + union chain, so the plan
    depth does not grow with the number of series.
    """
    return read_json_documents(spark, paths, FLAT_ITEM_SCHEMA, mode, with_file, multi_line, recursive)


def read_landed(spark: SparkSession, paths: Iterable[str], schema: T.StructType, mode: str = "PERMISSIVE") -> DataFrame:
    """Snapshots of both layouts by path: JSON-array documents (``*.json``
    outside run folders) and JSON Lines of run folders."""
    paths = _paths(paths)
    lines = [p for p in paths if "/run=" in p]
    documents = [p for p in paths if "/run=" not in p]
    frames = [read_json_documents(spark, some, schema, mode, multi_line=multi)
              for some, multi in ((documents, True), (lines, False)) if some]
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def read_landing_folder(spark: SparkSession, raw_dir: str, schema: T.StructType, mode: str = "PERMISSIVE") -> DataFrame:
    """All documents and runs below a landing folder; a filter on the file path
    prunes files before they are opened, so no list of paths is needed."""
    def part(glob: str, multi_line: bool) -> DataFrame:
        read_schema = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
        df = (spark.read.schema(read_schema).option("multiLine", multi_line).option("mode", mode)
              .option("columnNameOfCorruptRecord", "_corrupt_record")
              .option("recursiveFileLookup", True).option("pathGlobFilter", glob).json(raw_dir))
        return df.select("*", *[F.col(f"_metadata.{m}").alias(n) for m, n in _FILE_COLUMNS.items()])
    return part("*.json", True).unionByName(part("*.txt", False))


def read_with_file_name(spark: SparkSession, paths, fmt: str = "parquet",
                        **options) -> DataFrame:
    """Any format, every file of a glob, with the file name as a column."""
    reader = spark.read.format(fmt)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(_paths(paths)).select("*", F.col("_metadata.file_name").alias("arquivo"))


def read_csv_typed(spark: SparkSession, paths, schema: T.StructType,
                   date_format: str = "yyyy-MM-dd", mode: str = "FAILFAST") -> DataFrame:
    """Header CSV with a declared schema (UTF-8 BOM in the header is tolerated)."""
    return (spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)  # header names must match the schema
            .option("encoding", "UTF-8")
            .option("dateFormat", date_format)
            .option("mode", mode)
            .csv(_paths(paths)))


def read_csv_strings(spark: SparkSession, paths, columns: Iterable[str] | None = None,
                     delimiter: str = ",", quoting: bool = True) -> DataFrame:
    """CSV read as all-string columns (typed later by a contract).

    ``quoting=False`` treats quote characters as data, like a loader with
    quoting switched off.
    """
    reader = (spark.read.option("header", True)
              .option("delimiter", delimiter)
              .option("encoding", "UTF-8")
              .option("inferSchema", False))
    if not quoting:
        reader = reader.option("quote", "")
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(_paths(paths))
