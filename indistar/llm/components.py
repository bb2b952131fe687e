"""Connected components of an edge table by alternating star steps.

Every step is an aggregate and a join over the edges, so no component has to
fit in a task; each round is written to the shared folder to cut the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indistar.llm.common import materialise


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang each node's larger neighbours on its smallest neighbour."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the smallest of them."""
    near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    rest = near.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least.select("a", F.col("m").alias("b")))


def near_labels(edges: DataFrame, hops: int) -> DataFrame:
    """``node, component`` with the smallest node within ``hops`` edges: nodes
    with equal labels are connected, connected ones may still differ."""
    near = _both_ways(edges)
    out = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    for _ in range(hops - 1):
        out = near.join(out.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.least(F.min("m"), F.col("a")).alias("m"))
    return out.select(F.col("a").alias("node"), F.col("m").alias("component"))


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b`` (longs), with
    the smallest node of a component as its name.  Self-loops, repeated edges
    and null ends are ignored; no edges give no rows."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialise(now, "edges")
    before = None
    for _ in range(max_rounds):
        now = materialise(_small_star(_large_star(now)).where("a <> b").distinct(), "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = seen
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
