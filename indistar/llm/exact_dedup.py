"""Exact duplicates by 128-bit content hash, with the bytes compared.

DataFrame functions only.  Documents are grouped by the hash and by the
normalised text itself, so Spark's grouping compares the bytes inside each
hash group; a group of copies is combined in each task before the shuffle, and
its texts are shuffled once per task, not once per copy.  The result goes back
to the rows by (128-bit hash, SHA-256) only, without text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indistar.llm.common import lower_ascii, text_or_empty


def _digests(docs: DataFrame, id_col: str, norm: Column, content_hash) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm")) \
        .withColumn("h", content_hash("norm")).withColumn("text_sha256", F.sha2("norm", 256))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max",
                 content_hash=lambda c: F.unhex(F.md5(c))) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept,
    text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty.  ``keep`` says which id of a group stays: ``max`` or ``min``.  A
    null id counts in the group and stays only if the group has no other id.
    Rows that repeat an id with the same text are one record: all of them
    carry the decision of that id.  Other columns are not read; an empty table
    gives an empty result.  Different texts with equal 128-bit hashes stay
    apart; should two have an equal SHA-256 as well, the job fails.
    """
    norm = lower_ascii(text_or_empty(text_col))
    rows = _digests(docs, id_col, norm, content_hash)
    pick = F.max if keep == "max" else F.min
    texts = rows.groupBy("h", "text_sha256", "norm").agg(
        pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = texts.groupBy("h", "text_sha256").agg(
        F.count(F.lit(1)).alias("texts"), pick("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    groups = groups.select("h", "text_sha256", "group_size", F.when(
        F.col("texts") > 1, F.raise_error(F.lit("different texts share both hashes"))).otherwise(
        F.col("keep_id")).alias("keep_id"))
    return rows.select("doc_id", "h", "text_sha256").join(groups, ["h", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """``docs`` with one row for each group of equal texts, all columns kept.

    The kept (id, SHA-256) pairs select the rows; copies have different ids,
    so a large group spreads.  Rows repeating both are one record.
    """
    columns = docs.columns

    def key(col: str) -> Column:
        return F.coalesce(F.col(col).cast("string"), F.lit("null"))

    kept = exact_groups(docs, id_col, text_col, keep).where("kept").select(
        key("doc_id").alias("_key"), F.col("text_sha256").alias("_sha")).distinct()
    rows = docs.select(F.struct(*columns).alias("_row"), key(id_col).alias("_key"),
                       F.sha2(lower_ascii(text_or_empty(text_col)), 256).alias("_sha"))
    return rows.join(kept, ["_key", "_sha"], "left_semi").dropDuplicates(["_key", "_sha"]).select("_row.*")
