"""Sinks: checked publish, snapshot upsert, full refresh, per-series output.

Nothing goes through the driver: writes are Spark jobs into new folders, and one
commit (``commits``) makes the new folders of all tables of a change current.
A table lives at ``<root>/<name>``; tables below one root share its commits.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import commits as cm
from .contracts import Contract, assert_contract

MERGES = 5  # times an upsert merges anew when another writer was faster


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), sort_within: Sequence[str] = ()) -> str:
    """Write a frame; CSV gets a header row (UTF-8, no BOM)."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True).option("encoding", "UTF-8")
    w.format(fmt).save(path)
    return path


def _place(table_root: str) -> tuple[str, str]:
    """Root and name of a table."""
    root, _, name = table_root.rstrip("/").rpartition("/")
    if not root or not name or name.startswith(("_", ".")):
        raise ValueError(f"not the place of a table: {table_root}")
    return root, name


def publish(df: DataFrame, path: str, contract: Contract | None = None,
            key: Sequence[str] | None = None, fmt: str = "parquet",
            partition_by: Sequence[str] = (), dims: Mapping[str, DataFrame] | None = None) -> str:
    """Check the key (and the contract when given), then make ``df`` the table
    at ``path``: written once, checked as written, committed.  Other formats
    than Parquet are exports: checked, then written over what is there."""
    spark = df.sparkSession

    def check(out: DataFrame) -> None:
        if contract is not None:
            assert_contract(contract, out, dims)
        elif key and (n := repeated_keys(out, key)):
            raise ValueError(f"{path}: {n} duplicate keys in {list(key)}")
    if fmt != "parquet":
        check(df)
        return write_table(df, path, fmt, partition_by=partition_by)
    root, name = _place(path)
    changes = cm.Changes(spark, root)
    changes.replace(name, df, partition_by)
    check(changes.staged(name))
    changes.commit()
    return path


def repeated_keys(df: DataFrame, key: Sequence[str]) -> int:
    """Rows beyond the first of each key."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d")).first()["d"])


def current_version(spark: SparkSession, root: str) -> int | None:
    """The last commit that wrote to the table at ``root``; None before any."""
    place, name = _place(root)
    now = cm.head(spark, place)
    if name not in now.schemas:
        return None
    last = cm.manifest(spark, now).where(F.col("tabela") == name).agg(F.max("gravado")).first()[0]
    return now.number if last is None else last


def read_current(spark: SparkSession, root: str, number: int | None = None) -> DataFrame | None:
    """The table at ``root`` as of its newest commit, or of an earlier one."""
    place, name = _place(root)
    return cm.read_table(spark, place, name, number)


def merge_snapshot(target: DataFrame | None, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert as a set expression: new rows win, untouched target rows stay.

    ``updates  UNION ALL  (target LEFT ANTI JOIN updates ON keys)``.
    Applying the same updates twice gives the same table (idempotent).
    """
    if target is None:
        return updates
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return updates.unionByName(kept.select(*updates.columns))


def upsert(spark: SparkSession, updates: DataFrame, root: str, keys: Sequence[str],
           partition_by: Sequence[str] = (), sort_within: Sequence[str] = ()) -> int:
    """Merge ``updates`` into the published table at ``root``; the commit's number.

    Duplicate keys inside ``updates`` are refused (an upsert batch must be a
    function of its key).  With ``partition_by`` (columns that follow from the
    key, e.g. the year of a key date) only the partitions that the updates touch
    are rewritten.  When another writer has changed one of them meanwhile, the
    merge is done again on what it left.
    """
    place, name = _place(root)
    for left in range(MERGES - 1, -1, -1):
        changes = cm.Changes(spark, place)
        changes.upsert(name, updates, keys, partition_by, sort_within)
        try:
            return changes.commit()
        except cm.CommitConflict:
            if not left:
                raise


def upsert_partitions(spark: SparkSession, updates: DataFrame, path: str, keys: Sequence[str],
                      partition_by: Sequence[str]) -> int:
    """``upsert`` of a large partitioned table."""
    return upsert(spark, updates, path, keys, partition_by)


def partitions(spark: SparkSession, root: str) -> DataFrame:
    """``valores, pasta, gravado`` of the table at ``root``: the values of each
    partition, its folder and the commit that wrote it."""
    place, name = _place(root)
    return cm.manifest(spark, cm.head(spark, place)).where(F.col("tabela") == name).select("valores", "pasta", "gravado")


def full_refresh(spark: SparkSession, tables: Mapping[str, tuple[DataFrame, Contract | None]],
                 root: str, dims: Mapping[str, DataFrame] | None = None) -> dict[str, int]:
    """Replace a set of tables in one commit.

    Every table is written once, aside; contracts are checked on what was
    written, foreign keys against the new tables of the set and ``dims``.  Only
    when all pass, one commit makes all of them current; before it, and after a
    crash at any point before it, readers see all the old tables.
    """
    changes = cm.Changes(spark, root)
    for name, (df, _) in tables.items():
        changes.replace(name, df)
    known = {**(dims or {}), **{name: changes.staged(name) for name in tables}}
    for name, (_, contract) in tables.items():
        if contract is not None:
            assert_contract(contract, known[name], known)
    number = changes.commit()
    return {name: number for name in tables}


def write_per_series(df: DataFrame, path: str, series_col: str = "serie",
                     fmt: str = "csv", sort_within: Sequence[str] = ()) -> str:
    """One output folder per series value, written by one job."""
    return write_table(df, path, fmt, partition_by=[series_col], sort_within=sort_within)


def land_raw(df: DataFrame, raw_root: str, keys: Sequence[str], order: Sequence[str],
             stamp: str | None = None) -> str:
    """Deterministic raw landing: dedup on keys, sort, write into a run folder.

    The folder holds JSON Lines (one record per line, splittable); read it
    back with ``read_flat_series(..., multi_line=False)``.
    """
    from .reshape import dedup_keep_last
    stamp = stamp or time.strftime("%Y%m%d_%H%M%S")
    out = f"{raw_root.rstrip('/')}/run_{stamp}"
    dedup_keep_last(df, keys, order).orderBy(*order).write.mode("error").json(out)
    return out


def land_series(df: DataFrame, raw_root: str, fonte: str, keys: Sequence[str], order: Sequence[str], stamp: str,
                dataset_col: str = "serie", code_col: str = "codigo") -> str:
    """Land raw records as one run: ``fonte=/dataset=/codigo=/run=`` folders of
    JSON Lines, one for each series, by one job; returns ``raw_root``.

    Records are unique on ``keys`` (the last by ``order``) and sorted within a
    file.  ``stamp`` (``yyyymmdd_hhmmss``) names the run; a run is landed once.
    """
    from .reshape import dedup_keep_last
    spark = df.sparkSession
    place, fs = cm._files(spark, raw_root)
    run = spark._jvm.org.apache.hadoop.fs.Path(f"{raw_root.rstrip('/')}/fonte={fonte}/dataset=*/codigo=*/run={stamp}")
    if fs.exists(place) and len(fs.globStatus(run) or []):
        raise FileExistsError(f"{fonte}: run {stamp} was landed before")
    rows = dedup_keep_last(df, keys, order).withColumns(
        {"fonte": F.lit(fonte), "dataset": F.col(dataset_col), "_codigo": F.col(code_col), "run": F.lit(stamp)})
    # the code stays in the records, too
    record = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")
    (rows.select("fonte", "dataset", F.col("_codigo").alias("codigo"), "run", *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], record)
     .hint("rebalance", "dataset", "codigo")
     .sortWithinPartitions("dataset", "codigo", *[f"_o{i}" for i in range(len(order))])
     .select("fonte", "dataset", "codigo", "run", "value")
     .write.mode("append").partitionBy("fonte", "dataset", "codigo", "run").option("lineSep", "\n").format("text")
     .save(raw_root))
    return raw_root


def post_load_counts(spark: SparkSession, roots: Mapping[str, str]) -> DataFrame:
    """Row count per published table, read back from its current version."""
    from .aggregates import row_counts
    frames = {}
    for name, root in roots.items():
        df = read_current(spark, root)
        if df is None:
            raise FileNotFoundError(f"{name}: nothing published at {root}")
        frames[name] = df
    return row_counts(frames)
