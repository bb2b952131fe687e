"""Window measures: previous-period change and share of a partition total.

The change runs on already aggregated rows (one per entity and period), so
a window partition holds at most one row per period of one entity, however
skewed the raw facts are.  The share needs no window at all: a grouped
total joined back on the partition keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def previous_period_change(df: DataFrame, entity: Sequence[str], period: str, value: str,
                           prev_name: str = "valor_anterior",
                           change_name: str = "variacao_absoluta",
                           growth_name: str = "crescimento_pct",
                           step: int = 1, digits: int = 2) -> DataFrame:
    """Previous value, absolute change and growth % per entity.

    The previous row counts only when it is exactly ``step`` periods back,
    so a gap in the series gives null instead of a multi-year change.
    """
    w = Window.partitionBy(*entity).orderBy(period)
    prev_period = F.lag(period).over(w)
    prev_value = F.lag(value).over(w)
    prev = F.when(prev_period == F.col(period) - step, prev_value)
    return (df.withColumn(prev_name, prev)
            .withColumn(change_name, F.col(value) - F.col(prev_name))
            .withColumn(growth_name,
                        F.when(F.col(prev_name) != 0,
                               F.round(F.lit(100.0) * F.col(change_name) / F.col(prev_name), digits))))


def share_of_total(df: DataFrame, partition: Sequence[str], value: str,
                   share_name: str = "participacao_pct", digits: int | None = 2) -> DataFrame:
    """``100 * value / sum(value)`` within each partition.

    The totals are a grouped sum (combined map-side) joined back on the
    partition keys rather than a window: a window sends each partition to a
    single task, so a low-cardinality partition (27 states) would cap the
    parallelism and a hot one would sit in one task.  The totals hold one
    row per partition; AQE sees their real size and broadcasts them when
    small, or splits a hot key of the row side in a sort-merge join.  Keys
    match null-safely, as window partitions do.
    """
    keys = list(partition)
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    totals = totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_total")
    on = None
    for i, k in enumerate(keys):
        term = F.col(k).eqNullSafe(F.col(f"_k{i}"))
        on = term if on is None else on & term
    joined = df.join(totals, on, "left")
    share = F.try_divide(F.lit(100.0) * F.col(value), F.col("_total"))  # null for a zero total
    if digits is not None:
        share = F.round(share, digits)
    return joined.select(*[F.col(c) for c in df.columns], share.alias(share_name))
