"""Rendezvous hashing of record keys over weighted shards.

Each record goes to the shard with the highest score, where a shard's score
for a key is ``weight / -ln(u)`` with ``u`` uniform from a hash of key and
shard.  The scores of the old shards do not change when one is added, so the
new shard takes records only into itself, in proportion to its weight.
DataFrame functions only; one narrow pass, then a shuffle of ids and sizes for
the slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indistar.llm.common import text_or_empty


def rendezvous_shard(key: Column, weights: list[float]) -> Column:
    """The shard (0-based) of a key over shards of the given weights."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")

    def score(i: int) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(i)), 11).cast("double") + 0.5) * (2.0 ** -53)
        # -ln(u) / weight is smallest where weight / -ln(u) is highest
        return F.struct((-F.log(u) / F.lit(float(weights[i]))).alias("s"), F.lit(i).alias("i"))

    return F.array_min(F.array(*[score(i) for i in range(len(weights))]))["i"]


def shard_records(docs: DataFrame, weights: list[float], grown_weight: float = 1.0, rows_per_block: int = 100_000,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per record: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard``.

    ``slot`` numbers the records of a shard from 0 without gaps: records are
    ranked inside hashed blocks of a bounded mean size and the blocks' counts
    are summed up, so no shard is numbered in one task.  Null text has no
    bytes (size 16).  A null id hashes like any value; repeated rows go to one
    shard and get a slot each.  Other columns are not read; an empty table
    gives an empty result.  ``grown_shard`` is the shard with one more.
    """
    n = len(weights)
    text = text_or_empty(text_col)
    key = F.col("doc_id")
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.withColumn("shard", rendezvous_shard(key, weights)) \
        .withColumn("grown_shard", rendezvous_shard(key, [*weights, grown_weight]))
    blocks = max(1, -(-docs.count() // (rows_per_block * n)))
    # repeated ids spread over blocks by size and checksum too
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(blocks)).cast("int"))
    counts = rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")
    return rows.withColumn("r", F.row_number().over(inside)).join(starts, ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("r") - 1).alias("slot"), "grown_shard")
