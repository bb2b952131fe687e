"""Numbered commits over a folder of tables.

Data is written to folders that are never changed again.  A manifest (a small
Parquet table written by Spark) says which folder holds each partition of each
table; a commit is one file ``_commits/c_<number>`` that names a manifest.  A
file of that name can be made only once, so of two writers that start from the
same commit one has to look again: ``Changes.commit`` then takes over what the
other did to other partitions, and refuses when both changed the same one.

Readers see one commit, hence either all tables of a change or none.  Folders
of changes that were never committed stay unread.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS, MANIFESTS, STAGED = "_commits", "_manifests", "_staged"
SLOT = "_particao"  # names a partition in folder names
ROWS = "tabela string, particao string, valores string, pasta string, gravado long"
TRIES = 20


class CommitConflict(RuntimeError):
    """Another writer has changed a partition that this change is based on."""


@dataclass(frozen=True)
class Commit:
    number: int = 0
    manifest: str | None = None
    schemas: dict = field(default_factory=dict)  # table -> schema JSON
    partitions: dict = field(default_factory=dict)  # table -> partition columns


def _files(spark: SparkSession, path: str):
    """The path and its file system (driver side, listing and single files only)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    path, fs = _files(spark, f"{root}/{COMMITS}")
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n[2:]) for n in names if n.startswith("c_"))


def head(spark: SparkSession, root: str, number: int | None = None) -> Commit:
    """The newest commit (number 0 before the first), or the one asked for."""
    root = root.rstrip("/")
    if number is None:
        number = max(_numbers(spark, root), default=0)
    if number == 0:
        return Commit()
    text = spark.read.text(f"{root}/{COMMITS}/c_{number:012d}", wholetext=True).first()[0]
    return Commit(**json.loads(text))


def claim_commit(spark: SparkSession, root: str, commit: Commit) -> bool:
    """Make the commit's file; False when another writer has made it.  The
    text is written aside and moved, so a commit file is never half written;
    the move refuses an existing target (at once on HDFS and the like)."""
    text = json.dumps(commit.__dict__)
    aside, fs = _files(spark, f"{root}/{STAGED}/c_{uuid.uuid4().hex}")
    target, _ = _files(spark, f"{root}/{COMMITS}/c_{commit.number:012d}")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    fs.mkdirs(target.getParent())
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration()) \
        if aside.toUri().getScheme() else spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(aside, target, options)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def manifest(spark: SparkSession, commit: Commit) -> DataFrame:
    """``tabela, particao, valores, pasta, gravado``: the folder of each
    partition and the commit that wrote it."""
    return spark.read.schema(ROWS).parquet(commit.manifest) if commit.manifest else spark.createDataFrame([], ROWS)


def _frame(spark: SparkSession, folders: list[str], schema: str) -> DataFrame:
    kind = T.StructType.fromJson(json.loads(schema))
    return spark.read.schema(kind).parquet(*folders) if folders else spark.createDataFrame([], kind)


def read_table(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame | None:
    """A table as of a commit (the newest by default); None if it has none.
    One folder name for each partition reaches the driver."""
    commit = head(spark, root, number)
    if name not in commit.schemas:
        return None
    rows = manifest(spark, commit).where(F.col("tabela") == name).select("pasta").collect()
    return _frame(spark, [r["pasta"] for r in rows], commit.schemas[name])


def _slot(columns: Sequence[str]) -> Column:
    """A folder-safe name of the partition values; one name without any."""
    if not columns:
        return F.lit("p")
    return F.concat(F.lit("p"), F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})))


class Changes:
    """Tables staged against one commit and published by another one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.base = head(spark, self.root)
        self._rows: dict[str, DataFrame] = {}
        self._whole: set[str] = set()
        self._schemas = {}
        self._partitions = {}
        self._evaluated: list[DataFrame] = []

    def _fresh(self, *parts: str) -> str:
        return "/".join((self.root, *parts, f"v_{uuid.uuid4().hex}"))

    def aside(self, kind: str) -> str:
        """A new folder for a table that this change needs but does not publish."""
        return self._fresh(STAGED, kind)

    def evaluated(self, df: DataFrame) -> DataFrame:
        """``df`` written aside and read back, so that its plan runs once."""
        if any(df is seen for seen in self._evaluated):
            return df
        kept = self._fresh(STAGED)
        df.write.parquet(kept)
        back = self.spark.read.schema(df.schema).parquet(kept)
        self._evaluated.append(back)
        return back

    def _write(self, name: str, df: DataFrame, partition_by: Sequence[str], sort_within: Sequence[str]) -> None:
        if name in self._rows:
            raise ValueError(f"{name} is staged twice")
        partition_by, folder = list(partition_by), self._fresh(name)
        out = df
        if partition_by:  # rebalance: few files a partition, a hot one split over tasks
            out = df.withColumn(SLOT, _slot(partition_by)).hint("rebalance", SLOT)
        if sort_within or partition_by:
            out = out.sortWithinPartitions(*([SLOT] if partition_by else []), *sort_within)
        writer = out.write.mode("error")
        if partition_by:
            writer.partitionBy(SLOT).parquet(folder)
            written = self.spark.read.parquet(folder).select(
                SLOT, F.to_json(F.struct(*partition_by), {"ignoreNullFields": "false"}).alias("valores")).distinct()
            rows = written.select(F.lit(name).alias("tabela"), F.col(SLOT).alias("particao"), "valores", F.concat(
                F.lit(f"{folder}/{SLOT}="), F.col(SLOT)).alias("pasta"))
        else:
            writer.parquet(folder)
            rows = self.spark.createDataFrame([(name, "p", "{}", folder)], "tabela string, particao string, valores string, pasta string")
        kept = self._fresh(STAGED)  # the list of new folders, written once
        rows.write.parquet(kept)
        self._rows[name] = self.spark.read.schema(rows.schema).parquet(kept)
        self._schemas[name] = df.schema.json()
        self._partitions[name] = partition_by

    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] = (), sort_within: Sequence[str] = ()) -> None:
        """Stage a table whole."""
        self._write(name, df, partition_by, sort_within)
        self._whole.add(name)

    def upsert(self, name: str, updates: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = (),
               sort_within: Sequence[str] = ()) -> None:
        """Stage a merge of ``updates`` that rewrites only the partitions they
        touch.  The partition columns must follow from the key; an update batch
        must be a function of its key."""
        from .publish import merge_snapshot
        updates = self.evaluated(updates)
        if updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
            raise ValueError(f"upsert batch for {name} repeats keys {list(keys)}")
        target = None
        if name in self.base.schemas:
            if self.base.partitions[name] != list(partition_by):
                raise ValueError(f"{name} is partitioned by {self.base.partitions[name]}")
            touched = updates.select(_slot(partition_by).alias("particao")).distinct()
            folders = manifest(self.spark, self.base).where(F.col("tabela") == name).join(touched, "particao", "left_semi")
            target = _frame(self.spark, [r["pasta"] for r in folders.select("pasta").collect()], self.base.schemas[name])
        self._write(name, merge_snapshot(target, updates, keys), partition_by, sort_within)

    def staged(self, name: str) -> DataFrame:
        """What was written for a table, to be checked before the commit."""
        return _frame(self.spark, [r["pasta"] for r in self._rows[name].select("pasta").collect()], self._schemas[name])

    def _other_writers(self, now: Commit, mine: DataFrame) -> None:
        """Refuse when a staged partition has another folder by now."""
        was, current = manifest(self.spark, self.base), manifest(self.spark, now)
        both = was.select("tabela", "particao", F.col("pasta").alias("antes")).join(
            current.select("tabela", "particao", "pasta"), ["tabela", "particao"], "full").where(
            ~F.col("antes").eqNullSafe(F.col("pasta")))
        lost = both.where(F.col("tabela").isin(list(self._whole))).select("tabela", "particao").union(
            both.join(mine, ["tabela", "particao"], "left_semi").select("tabela", "particao")).limit(1).collect()
        if lost:
            raise CommitConflict(f"{lost[0]['tabela']}: changed by commit {now.number}, this change is based on {self.base.number}")

    def commit(self) -> int:
        """Publish all staged tables at once; returns the commit's number."""
        mine = None
        for rows in self._rows.values():
            mine = rows if mine is None else mine.unionByName(rows)
        if mine is None:
            return self.base.number
        for _ in range(TRIES):
            now = head(self.spark, self.root)
            if now.number != self.base.number:
                self._other_writers(now, mine)
            old = manifest(self.spark, now).where(~F.col("tabela").isin(list(self._whole))).join(
                mine, ["tabela", "particao"], "left_anti").select("tabela", "particao", "valores", "pasta", "gravado")
            path = self._fresh(MANIFESTS)
            old.unionByName(mine.withColumn("gravado", F.lit(now.number + 1).cast("long"))).coalesce(1).write.parquet(path)
            if claim_commit(self.spark, self.root, Commit(
                    now.number + 1, path, {**now.schemas, **self._schemas}, {**now.partitions, **self._partitions})):
                return now.number + 1
        raise CommitConflict(f"{self.root}: no commit in {TRIES} tries")
