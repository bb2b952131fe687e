"""Row-shape operators: split, union, column-set checks, pivot, dedup, order."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_by_class(df: DataFrame, class_col: str,
                   classes: Mapping[str, tuple[Sequence, str, str]],
                   value_col: str = "valor", keep: Sequence[str] = ()) -> dict[str, DataFrame]:
    """One long table -> one typed table per value class.

    ``classes`` maps a name to ``(ids, output column, Spark type)``.  The
    outputs are separate filtered projections of the same input; persist the
    input when all of them are written in one run.
    """
    out = {}
    for name, (ids, column, dtype) in classes.items():
        out[name] = (df.filter(F.col(class_col).isin(list(ids)))
                     .select(*keep, F.col(value_col).cast(dtype).alias(column)))
    return out


def union_frames(frames: Iterable[DataFrame]) -> DataFrame:
    """``unionByName`` of several frames; an empty list is an error."""
    frames = list(frames)
    if not frames:
        raise ValueError("no frames to union")
    result = frames[0]
    for f in frames[1:]:
        result = result.unionByName(f)
    return result


def column_set_diff(df: DataFrame, expected: Iterable[str]) -> tuple[list[str], list[str]]:
    """(missing, unexpected) columns of ``df`` against an expected set."""
    expected = list(expected)
    have = set(df.columns)
    missing = [c for c in expected if c not in have]
    unexpected = [c for c in df.columns if c not in set(expected)]
    return missing, unexpected


def require_columns(df: DataFrame, expected: Iterable[str], name: str = "frame") -> DataFrame:
    """Raise when the column set differs; return the frame in contract order."""
    expected = list(expected)
    missing, unexpected = column_set_diff(df, expected)
    if missing or unexpected:
        raise ValueError(f"{name}: missing columns {missing}, unexpected columns {unexpected}")
    return df.select(*expected)


def pivot_values(df: DataFrame, keys: Sequence[str], pivot_col: str, names: Mapping, value_col: str = "valor",
                 conflict: str = "error") -> DataFrame:
    """Long -> wide with a fixed value list: one aggregate, one exchange.

    Each listed pivot value becomes the column ``names[value]``; unlisted
    values are ignored, but their key rows survive with nulls.  Nulls never
    count as a cell's value.  A cell with two different values fails the run;
    ``conflict="max"`` takes the largest one instead.
    """
    if conflict not in ("error", "max"):
        raise ValueError(f"conflict: {conflict}")
    cells = {out: F.when(F.col(pivot_col) == F.lit(v), F.col(value_col)) for v, out in names.items()}
    if conflict == "max":
        return df.groupBy(*keys).agg(*[F.max(c).alias(out) for out, c in cells.items()])
    both = df.groupBy(*keys).agg(*[f(c).alias(f"{tag}{i}") for i, c in enumerate(cells.values())
                                   for tag, f in (("_lo", F.min), ("_hi", F.max))])
    kind = df.schema[value_col].dataType

    def cell(i: int, out: str) -> Column:
        at = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
        refuse = F.raise_error(F.concat(F.lit(f"{out}: two values in one cell: "), at)).cast(kind)
        return F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.col(f"_hi{i}")).when(F.col(f"_hi{i}").isNotNull(), refuse).alias(out)
    return both.select(*keys, *[cell(i, out) for i, out in enumerate(cells)])


def multi_valued_cells(df: DataFrame, keys: Sequence[str], pivot_col: str,
                       value_col: str = "valor") -> DataFrame:
    """Pivot cells holding more than one distinct non-null value."""
    return (df.groupBy(*keys, pivot_col)
            .agg(F.count_distinct(value_col).alias("n_valores"))
            .filter(F.col("n_valores") > 1))


def dedup_keep_last(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple.

    Written as ``max_by(row, order)`` so Spark combines map-side before the
    shuffle: a key holding a third of all rows is reduced per task, not
    gathered into one.  Put a unique column last in ``order`` for a total
    tie-break.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    others = [c for c in df.columns if c not in set(keys)]
    best = F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(*order_cols))
    return (df.groupBy(*keys).agg(best.alias("_best"))
            .select(*keys, *[F.col(f"_best.{c}").alias(c) for c in others])
            .select(*df.columns))


def dedup_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One arbitrary row per key (prefer ``dedup_keep_last`` for determinism)."""
    return df.dropDuplicates(list(keys))


def order_by_measure(df: DataFrame, measure: str, tie_break: Sequence[str] = (),
                     descending: bool = True, drop: Sequence[str] = ()) -> DataFrame:
    """Sort by a measure (optionally one not displayed) with a total tie-break."""
    m: Column = F.col(measure).desc_nulls_last() if descending else F.col(measure).asc_nulls_last()
    out = df.orderBy(m, *[F.col(c).asc() for c in tie_break])
    return out.drop(*drop) if drop else out
