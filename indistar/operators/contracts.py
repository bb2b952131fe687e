"""Data contracts: declared keys, foreign keys, ranges and column sets.

``violations`` turns a contract into ONE row-level aggregate pass (null,
range, year/date, fixed value, length, precision, cast failures), one
``groupBy`` for key uniqueness and one anti join per foreign key.  The
result is a small DataFrame ``(tabela, regra, coluna, violacoes)``; only
that reaches the driver in ``assert_contract``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Contract:
    name: str
    schema: T.StructType
    key: Sequence[str]
    not_null: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    foreign_keys: Sequence[tuple[Sequence[str], str, Sequence[str]]] = ()
    year_of_date: tuple[str, str] | None = None
    ranges: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    fixed: Mapping[str, object] = field(default_factory=dict)
    max_length: Mapping[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _count_if(cond: Column, alias: str) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint").alias(alias)


def row_rules(c: Contract, df: DataFrame) -> list[tuple[str, str, Column]]:
    """(rule, column, violating-row condition) for row-local checks."""
    rules: list[tuple[str, str, Column]] = []
    for col in c.not_null:
        rules.append(("not_null", col, F.col(col).isNull()))
    if c.year_of_date:
        y, d = c.year_of_date
        rules.append(("ano_da_data", y, F.col(y) != F.year(F.col(d))))
    for col, (lo, hi) in c.ranges.items():
        rules.append(("faixa", col, ~F.col(col).between(lo, hi)))
    for col, value in c.fixed.items():
        rules.append(("valor_fixo", col, F.col(col) != F.lit(value)))
    for col, n in c.max_length.items():
        rules.append(("tamanho", col, F.length(F.col(col)) > n))
    types = {f.name: f.dataType for f in c.schema.fields}
    for col, dtype in types.items():
        if isinstance(dtype, T.DecimalType) and col in df.columns:
            # a value that does not fit the declared precision
            rules.append(("precisao", col,
                          F.col(col).isNotNull() & F.col(col).try_cast(dtype).isNull()))
    return rules


def violations(c: Contract, df: DataFrame, dims: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Violation counts per rule (zero rows are kept, so the shape is stable)."""
    spark = df.sparkSession
    parts: list[DataFrame] = []
    rules = row_rules(c, df)
    if rules:
        agg = df.agg(*[_count_if(cond, f"r{i}") for i, (_, _, cond) in enumerate(rules)])
        stack = ", ".join(f"'{r}', '{col}', r{i}" for i, (r, col, _) in enumerate(rules))
        parts.append(agg.selectExpr(f"stack({len(rules)}, {stack}) as (regra, coluna, violacoes)"))
    for key in [list(c.key), *[list(u) for u in c.unique]]:
        if not key:
            continue
        dup = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
               .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("violacoes")))
        rule = "chave_primaria" if key == list(c.key) else "unico"
        parts.append(dup.select(F.lit(rule).alias("regra"), F.lit(",".join(key)).alias("coluna"), "violacoes"))
    for cols, dim_name, dim_cols in c.foreign_keys:
        if dims is None or dim_name not in dims:
            raise ValueError(f"{c.name}: the foreign key {','.join(cols)} needs the dimension {dim_name}")
        dim = dims[dim_name].select(*[F.col(d).alias(s) for s, d in zip(cols, dim_cols)]).distinct()
        # count per foreign-key value first: a value held by a third of all
        # rows is combined map-side and reaches the anti join as one row
        probe = df.select(*cols).dropna().groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
        n = (probe.join(dim, list(cols), "left_anti")
             .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("violacoes")))
        parts.append(n.select(F.lit("chave_estrangeira").alias("regra"),
                              F.lit(",".join(cols) + "->" + dim_name).alias("coluna"), "violacoes"))
    if not parts:
        return spark.createDataFrame([], "tabela string, regra string, coluna string, violacoes bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(c.name).alias("tabela"), "regra", "coluna",
                      F.col("violacoes").cast("bigint").alias("violacoes"))


def type_problems(c: Contract, df: DataFrame) -> list[str]:
    """Columns whose type cannot hold the declared values: the declared type
    itself fits, and any number does for a number (range and precision are
    rules on the values)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return [f"{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}" for f in c.schema.fields
            if f.name in have and have[f.name] != f.dataType
            and not (isinstance(have[f.name], T.NumericType) and isinstance(f.dataType, T.NumericType))]


def assert_contract(c: Contract, df: DataFrame, dims: Mapping[str, DataFrame] | None = None) -> None:
    """Raise when the column set or a type differs or any rule is violated."""
    from .reshape import column_set_diff
    missing, unexpected = column_set_diff(df, c.columns)
    if missing or unexpected:
        raise ValueError(f"{c.name}: missing columns {missing}, unexpected columns {unexpected}")
    if wrong := type_problems(c, df):
        raise ValueError(f"{c.name}: {'; '.join(wrong)}")
    bad = [r for r in violations(c, df, dims).collect() if r["violacoes"]]
    if bad:
        detail = "; ".join(f"{r['regra']}({r['coluna']})={r['violacoes']}" for r in bad)
        raise ValueError(f"{c.name}: contract violated: {detail}")


def typed_by_contract(c: Contract, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All-string frame -> typed frame + per-column count of failed casts.

    A failed cast is a non-empty text that does not convert to the declared
    type (it would silently become null otherwise).
    """
    typed = raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in c.schema.fields])
    fails = raw.agg(*[
        F.sum(F.when(F.col(f.name).isNotNull() & (F.trim(F.col(f.name)) != "")
                     & F.col(f.name).try_cast(f.dataType).isNull(), 1).otherwise(0))
        .cast("bigint").alias(f.name) for f in c.schema.fields])
    return typed, fails


def document_problems(raw: DataFrame, expected_files: Sequence[str] | None = None,
                      file_col: str = "arquivo") -> DataFrame:
    """Per file: rows, malformed records and rows with data.

    A malformed multi-line document reads as one all-null row carrying
    ``_corrupt_record``; an empty array yields no row at all, so files that
    were expected but not seen are reported with ``linhas = 0``.
    """
    spark = raw.sparkSession
    # Spark refuses a raw-file query that references only the corrupt-record
    # column, so a data column is read alongside it.
    data_col = next(c for c in raw.columns if c not in ("_corrupt_record", file_col))
    seen = (raw.groupBy(file_col)
            .agg(F.count(F.lit(1)).alias("linhas"),
                 F.count("_corrupt_record").alias("corrompidos"),
                 F.count(data_col).alias("preenchidos")))
    if expected_files is None:
        return seen
    exp = spark.createDataFrame([(f,) for f in expected_files], f"{file_col} string")
    return (exp.join(seen, file_col, "left")
            .select(file_col, F.coalesce("linhas", F.lit(0)).alias("linhas"),
                    F.coalesce("corrompidos", F.lit(0)).alias("corrompidos"),
                    F.coalesce("preenchidos", F.lit(0)).alias("preenchidos")))
