"""Snapshot discovery and dataset selection.

A landed snapshot is either one document ``<source>_<dataset>_<code>_<stamp>.json``
or a run folder ``fonte=/dataset=/codigo=/run=`` of JSON Lines files, as
``publish.land_series`` writes it.  The listing is a Spark job over file metadata
only (the binary-file source skips file contents when ``content`` is not
selected); the driver receives one path per dataset, a list bounded by the
catalog, never file contents.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Landed file name pattern -> (source, dataset, code, stamp), and
# the datasets whose older files carry LEGACY_NAME instead of their own name.
SNAPSHOT_NAME = r"^([a-z]+)_([a-z0-9_]+?)_(\d+)_(\d{8}_\d{6})\.json$"
LEGACY_NAME = "agregado"
LEGACY_DATASETS = ("populacao", "pib")

RUN_PATH = r"/fonte=([^/]+)/dataset=([^/]+)/codigo=(\d+)/run=([^/]+)/[^/]+$"
LANDED_FILES = "*.{json,txt}"  # documents, and JSON Lines of runs
_FIELDS = {"fonte": 1, "dataset": 2, "codigo": 3, "carimbo": 4}


def snapshot_field(path: Column, field: str) -> Column:
    """``fonte``, ``dataset``, ``codigo`` or ``carimbo`` from the path of a landed
    file; empty where it is no snapshot."""
    group, name = _FIELDS[field], F.regexp_extract(path, r"([^/]+)$", 1)
    run = F.regexp_extract(path, RUN_PATH, group)
    return F.when(run != "", run).otherwise(F.regexp_extract(name, SNAPSHOT_NAME, group))


def snapshot_of(path: Column) -> Column:
    """The snapshot a file belongs to: its run folder, or the file itself."""
    return F.regexp_replace(path, r"(/run=[^/]+)/[^/]+$", "$1")


def dataset_of(path: Column, wanted: Mapping[str, str | int]) -> Column:
    """Dataset of a landed file; a legacy name is resolved by its code."""
    out = named = snapshot_field(path, "dataset")
    for name in LEGACY_DATASETS:
        if name in wanted:
            legacy = (named == LEGACY_NAME) & (snapshot_field(path, "codigo") == str(wanted[name]))
            out = F.when(legacy, name).otherwise(out)
    return out


def _landed(spark: SparkSession, raw_dir: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", LANDED_FILES)
            .option("recursiveFileLookup", True).load(raw_dir))


def empty_documents(spark: SparkSession, raw_dir: str) -> DataFrame:
    """``arquivo_caminho`` of documents of zero bytes.  Scans leave such files
    out, so the names in Spark's file listing are held against a scan."""
    files = _landed(spark, raw_dir)
    plain = lambda c: F.regexp_replace(c, "^([a-z]+):/+", "$1:/")
    every = spark.createDataFrame([(n,) for n in files.inputFiles()], "arquivo_caminho string")
    seen = files.select(plain(F.col("_metadata.file_path")).alias("lido"))
    return every.where(F.col("arquivo_caminho").endswith(".json")).join(
        seen, plain(F.col("arquivo_caminho")) == F.col("lido"), "left_anti")


def snapshot_listing(spark: SparkSession, raw_dir: str, fonte: str | None = None) -> DataFrame:
    """All landed snapshot files with (fonte, dataset, codigo, carimbo, mtime,
    path, snapshot), of one source if given."""
    files = _landed(spark, raw_dir).select("path", "modificationTime", F.col("_metadata.file_path").alias("arquivo_caminho"))
    path = F.col("path")
    listing = (files
               .withColumn("arquivo", F.regexp_extract(path, r"([^/]+)$", 1))
               .withColumns({f: snapshot_field(path, f) for f in _FIELDS})
               .withColumn("instantaneo", snapshot_of(path))
               .filter(F.col("dataset") != ""))
    return listing if fonte is None else listing.filter(F.col("fonte") == fonte)


def newest_snapshot_frame(spark: SparkSession, raw_dir: str, fonte: str | None = None) -> DataFrame:
    """Per (source, dataset, code): the snapshot with the latest modification time."""
    runs = (snapshot_listing(spark, raw_dir, fonte)
            .groupBy("fonte", "dataset", "codigo", "instantaneo", "carimbo")
            .agg(F.max("modificationTime").alias("modificationTime")))
    return (runs.groupBy("fonte", "dataset", "codigo")
            .agg(F.max_by("instantaneo", F.struct("modificationTime", "carimbo", "instantaneo")).alias("path"),
                 F.max("modificationTime").alias("modificationTime")))


def newest_snapshots(spark: SparkSession, raw_dir: str, wanted: Mapping[str, str | int],
                     fonte: str | None = None) -> dict[str, str]:
    """Resolve ``{dataset: code}`` to newest snapshots; missing -> error.  Two
    sources that both hold a wanted dataset are an error unless ``fonte`` says
    which one is meant."""
    rows = (newest_snapshot_frame(spark, raw_dir, fonte)
            .filter(F.col("dataset").isin([*wanted, LEGACY_NAME]))
            .select("fonte", "dataset", "codigo", "path", "modificationTime").collect())
    result, missing = {}, []
    for name, code in wanted.items():
        names = {name, LEGACY_NAME} if name in LEGACY_DATASETS else {name}
        found = [r for r in rows if r["dataset"] in names and r["codigo"] == str(code)]
        if len({r["fonte"] for r in found}) > 1:
            raise ValueError(f"{name} ({code}) was landed by several sources: {sorted({r['fonte'] for r in found})}")
        if not found:
            missing.append(f"{name} ({code})")
        else:
            result[name] = max(found, key=lambda r: (r["modificationTime"], r["path"]))["path"]
    if missing:
        raise FileNotFoundError("no landed snapshot for: " + ", ".join(missing))
    return result


def select_datasets(catalog: Mapping[str, object], names: Iterable[str] | str | None = None) -> dict:
    """Active subset of a catalog; default all, unknown names raise."""
    if names is None or names == "ALL":
        return dict(catalog)
    if isinstance(names, str):
        names = [names]
    names = list(names)
    unknown = [n for n in names if n not in catalog]
    if unknown:
        raise ValueError(f"unknown datasets: {unknown}; known: {sorted(catalog)}")
    return {n: catalog[n] for n in names}
