"""Aggregates: profiles, report measures, matrices and hierarchies.

Everything is a ``groupBy``/``groupingSets``/``rollup`` so Spark runs a
partial (map-side) aggregate before each shuffle; the driver only ever sees
the small results it asks for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_key_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total rows, distinct keys, rows beyond the first per key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").cast("bigint").alias("n_linhas"),
        F.count(F.lit(1)).alias("n_chaves"),
        F.sum(F.col("n") - 1).cast("bigint").alias("n_duplicadas"),
        F.count_if(F.col("n") > 1).alias("n_chaves_repetidas"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The repeated keys with their multiplicity."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(tabela, linhas) for several frames as one unioned plan."""
    parts = [f.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
             for name, f in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_profile(df: DataFrame, columns: Sequence[str] | None = None,
                 total_name: str = "total_nulos") -> DataFrame:
    """One row: null count per column plus the sum over all cells."""
    columns = list(columns or df.columns)
    counts = [F.sum(F.col(c).isNull().cast("int")).cast("bigint").alias(c) for c in columns]
    out = df.agg(*counts) if counts else df.agg(F.lit(0).alias(total_name))
    total = None
    for c in columns:
        total = F.col(c) if total is None else total + F.col(c)
    return out.withColumn(total_name, total if total is not None else F.lit(0))


def range_summary(df: DataFrame, ids: Sequence[str], date_col: str) -> DataFrame:
    """Per series: first date, last date, row count."""
    return (df.groupBy(*ids)
            .agg(F.min(date_col).alias("data_inicial"),
                 F.max(date_col).alias("data_final"),
                 F.count(F.lit(1)).alias("registros")))


def file_profile(df: DataFrame, keys: Sequence[str], file_col: str = "arquivo") -> DataFrame:
    """Per source file: rows, null cells and duplicate keys within the file."""
    value_cols = [c for c in df.columns if c != file_col]
    null_cells = None
    for c in value_cols:
        e = F.col(c).isNull().cast("int")
        null_cells = e if null_cells is None else null_cells + e
    per_key = (df.groupBy(file_col, *keys)
               .agg(F.count(F.lit(1)).alias("n"), F.sum(null_cells).alias("nulos")))
    return (per_key.groupBy(file_col)
            .agg(F.sum("n").cast("bigint").alias("linhas"),
                 F.sum(F.col("n") - 1).cast("bigint").alias("chaves_duplicadas"),
                 F.sum("nulos").cast("bigint").alias("celulas_nulas")))


def with_columns_of_files(profile: DataFrame, files: DataFrame, file_col: str = "arquivo_caminho") -> DataFrame:
    """File profile with the column list of each file (``delimited.file_headers``,
    ``column_differences``); a file that has a header and no row counts zeros."""
    zeros = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in profile.columns if c != file_col}
    return files.join(profile, file_col, "left").withColumns(zeros)


def avg_of_avgs(df: DataFrame, groups: Sequence[str], label: str, value,
                alias="media") -> DataFrame:
    """Mean per (groups, label), then mean of those means per group.

    ``value`` / ``alias`` may be lists to compute several measures in the
    same two aggregations.  The label carries no year: unless the year is
    one of ``groups`` the same label from different years merges into one
    inner mean.  A label whose inner mean is null is ignored by the outer one.
    """
    values = [value] if isinstance(value, str) else list(value)
    aliases = [alias] if isinstance(alias, str) else list(alias)
    inner = df.groupBy(*groups, label).agg(*[F.avg(v).alias(f"_m{i}") for i, v in enumerate(values)])
    return inner.groupBy(*groups).agg(*[F.avg(f"_m{i}").alias(a) for i, a in enumerate(aliases)])


def single_value(c) -> Column:
    """The value when exactly one distinct value is in scope, else null; a
    blank counts as a value."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when((F.min(c) == F.max(c)) & (F.count(c) == F.count(F.lit(1))), F.max(c))


def value_list(df: DataFrame, column: str) -> DataFrame:
    """Distinct sorted values (dropdown contents)."""
    return df.select(column).distinct().orderBy(column)


def matrix(df: DataFrame, area: str, group: str, column_key: str, value: str,
           column_values: Sequence, agg: str = "min",
           name_fn=lambda v: f"v_{v}", counted: str | None = None) -> DataFrame:
    """Two-level row hierarchy x pivoted columns with subtotals.

    Spark rejects ``rollup(...).pivot(...)``, so the cells are computed with
    grouping sets ``(area, group, key)``, ``(area, key)``, ``(key)`` and then
    pivoted per row level with a fixed column list.  ``nivel`` is 0 for
    detail rows, 1 for area subtotals and 3 for the grand total.  A key that
    is not listed fails the run; it would have no column to show it.

    ``counted`` carries a hidden measure through the same grouping sets: the
    non-null count of that column over the row, all keys (a null key too), as
    ``contagem``.
    """
    fn = getattr(F, agg)
    key = F.col(column_key)
    unlisted = F.raise_error(F.concat(F.lit(f"matrix: no column for {column_key} = "), key.cast("string")))
    checked = F.when(key.isNull() | key.isin(*column_values), key).otherwise(unlisted.cast(df.schema[column_key].dataType))
    cells = (df.withColumn(column_key, checked).groupingSets([[area, group, column_key], [area, column_key], [column_key]],
                             area, group, column_key)
             .agg(fn(value).alias("_v"),
                  *([F.count(counted).alias("_n")] if counted else []),
                  (F.grouping(area) * 2 + F.grouping(group)).cast("bigint").alias("nivel")))
    rows = cells.groupBy("nivel", area, group)
    if counted:
        shown = [F.max(F.when(key == F.lit(v), F.col("_v"))).alias(name_fn(v)) for v in column_values]
        return rows.agg(*shown, F.sum("_n").alias("contagem"))
    wide = rows.pivot(column_key, list(column_values)).agg(F.max("_v"))
    return wide.withColumnsRenamed({str(v): name_fn(v) for v in column_values})


def date_drill(df: DataFrame, date_col: str, aggs: Sequence[Column], depth: int = 3) -> DataFrame:
    """Year -> quarter -> month (-> day) hierarchy, one row per node.

    ``nivel`` counts the rolled-up levels (0 = leaf, ``depth`` = grand total).
    """
    d = F.col(date_col)
    parts = [F.year(d).alias("ano"), F.quarter(d).alias("trimestre"),
             F.month(d).alias("mes"), F.dayofmonth(d).alias("dia")][:depth]
    names = ["ano", "trimestre", "mes", "dia"][:depth]
    return (df.select(*parts, *[c for c in df.columns])
            .rollup(*names)
            .agg(*aggs, F.grouping_id(*names).alias("_gid"))
            .withColumn("nivel", F.bit_count("_gid").cast("int"))
            .drop("_gid"))


def year_summary(df: DataFrame, year_col: str, value: str, growth: str,
                 change: str, entity: str) -> DataFrame:
    """Per year: total, number of entities, mean growth %, total change."""
    return (df.groupBy(year_col)
            .agg(F.sum(value).alias("total"),
                 F.count(entity).alias("qtd_entidades"),
                 F.avg(growth).alias("crescimento_medio_pct"),
                 F.sum(change).alias("variacao_absoluta_total")))
