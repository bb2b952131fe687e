"""Star-schema joins with explicit size discipline.

Dimensions of a fixed, known size (the 27-state table, a calendar over a
date span, a window table) are broadcast by hint.  A side whose size
depends on the data is left to the planner (sort-merge, or a runtime broadcast/skew split chosen by AQE
from real shuffle statistics).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def attach_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left",
                     broadcast: bool = True) -> DataFrame:
    """Many-to-one fact -> dimension join.

    ``broadcast=True`` is for dimensions whose size is fixed by construction;
    pass False for a side that grows with the data, and AQE chooses.
    """
    if broadcast:
        dim = F.broadcast(dim)
    return fact.join(dim, on, how)


def keep_matching(fact: DataFrame, dim: DataFrame, on, broadcast: bool = False) -> DataFrame:
    """Filter propagation: keep fact rows whose key appears in ``dim`` (semi join)."""
    return fact.join(F.broadcast(dim) if broadcast else dim, on, "left_semi")


def propagate_filter(chain: Sequence[tuple[DataFrame, object]], target: DataFrame,
                     target_on) -> DataFrame:
    """Filter a target through a chain of dimensions.

    ``chain`` is ``[(filtered_dim0, None), (dim1, on01), (dim2, on12), ...]``:
    each next dimension is semi-joined to the previous survivor set, the
    last survivor set filters ``target`` on ``target_on``.
    """
    survivors = chain[0][0]
    for dim, on in chain[1:]:
        survivors = dim.join(survivors, on, "left_semi")
    return target.join(survivors, target_on, "left_semi")


def orphans(fact: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Fact rows without a dimension row (foreign-key probe)."""
    return fact.join(dim, on, "left_anti")


def calendar_join(fact: DataFrame, ts_col: str, calendar: DataFrame,
                  date_col: str = "data") -> DataFrame:
    """Fact -> calendar on the date part of a timestamp.  The calendar is
    broadcast: ``calendar_for`` bounds its span."""
    return fact.join(F.broadcast(calendar), F.to_date(F.col(ts_col)) == calendar[date_col], "inner")


def range_join(fact: DataFrame, value: Column, windows: DataFrame,
               start: str = "janela_inicio", end: str = "janela_fim",
               how: str = "inner") -> DataFrame:
    """Fact rows to the window containing them (``start <= v <= end``).

    The window table is small by construction (span / window length rows),
    so it is broadcast and the non-equi join runs map-side with no shuffle.
    """
    w = F.broadcast(windows)
    return fact.join(w, (value >= w[start]) & (value <= w[end]), how)


def window_join(fact: DataFrame, value: str, bounds: DataFrame, keys: Sequence[str], years: int,
                start: str = "inicio", end: str = "fim") -> DataFrame:
    """Fact rows with the window of their own series that holds them.

    ``bounds`` has one row per ``keys`` with the first and last day.  The window
    number is arithmetic on the date, so the join is on the keys alone: no
    range condition, no nested loop, and each row meets one series only.
    Rows outside the bounds, or of a series without bounds, have no window and
    are left out.
    """
    from ..sources.catalog import window_number, window_start
    edges = bounds.select(*keys, F.col(start).alias("_s"), F.col(end).alias("_e"))
    held = fact.join(edges, list(keys), "inner").filter(F.col(value).between(F.col("_s"), F.col("_e")))
    numbered = held.withColumn("janela", window_number(F.col(value), F.col("_s"), years))
    first, nxt = (window_start(F.col("_s"), F.col("janela") + k, years) for k in (0, 1))
    return numbered.withColumns({"janela_inicio": first, "janela_fim": F.least(F.date_sub(nxt, 1), F.col("_e"))}).drop("_s", "_e")
