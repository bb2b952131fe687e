"""Accounting of landed input: every file and record is used, or named.

One job parses the raw records, marks the ones that cannot be used, counts them
on the way (``observe``) and writes all of them aside; what follows reads that
table, so raw documents are parsed once.  By default a problem stops the run
and names the snapshots; otherwise the unusable records stay in a quarantine
table and the report goes to the caller.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .snapshots import snapshot_of

CORRUPT, EMPTY, UNKNOWN, NO_RECORD = "corrompido", "sem_dados", "serie_desconhecida", "sem_registro"
SHOWN = 20  # snapshots that an error names


class IntakeError(ValueError):
    """Landed input that cannot be used."""


@dataclass
class Intake:
    good: DataFrame  # usable records, with their file columns
    quarantine: DataFrame  # the others, with their problem and text
    report: DataFrame  # instantaneo, problema, linhas
    counts: dict  # records read, and records of each problem


def take_in(raw: DataFrame, folder: str, known: DataFrame | None = None, keys: Sequence[str] = (),
            listed: DataFrame | None = None, on_problem: str = "fail") -> Intake:
    """Account for ``raw``, a permissive read with file columns.

    A record is ``corrompido`` if it does not parse, ``sem_dados`` if all its
    fields are null, ``serie_desconhecida`` if ``known`` (a catalog of fixed
    size, unique on ``keys``) has no such ``keys``.  A snapshot of ``listed``
    (``arquivo_caminho`` of its files) from which no record came is
    ``sem_registro``.  ``on_problem``: ``fail`` or ``quarantine``.  ``folder``
    must be new."""
    if on_problem not in ("fail", "quarantine"):
        raise ValueError(f"on_problem: {on_problem}")
    spark = raw.sparkSession
    files = ("_corrupt_record", "arquivo", "arquivo_caminho", "arquivo_modificado")
    fields = [c for c in raw.columns if c not in files]
    strange = F.lit(False)
    rows = raw
    if known is not None:
        marked = F.broadcast(known.select(*keys).distinct().withColumn("_conhecida", F.lit(True)))
        rows, strange = raw.join(marked, list(keys), "left"), F.col("_conhecida").isNull()
    problem = (F.when(F.col("_corrupt_record").isNotNull(), CORRUPT)
               .when(~F.greatest(*[F.col(c).isNotNull() for c in fields], F.lit(False)), EMPTY)
               .when(strange, UNKNOWN))
    seen = Observation()
    marked = rows.withColumn("problema", problem).select(*raw.columns, "problema").observe(
        seen, F.count(F.lit(1)).alias("registros"),
        *[F.count_if(F.col("problema") == p).alias(p) for p in (CORRUPT, EMPTY, UNKNOWN)])
    marked.write.mode("error").parquet(folder)
    counts = seen.get
    back = spark.read.schema(marked.schema).parquet(folder)
    snapshot = snapshot_of(F.col("arquivo_caminho")).alias("instantaneo")
    report = (back.where(F.col("problema").isNotNull()).groupBy(snapshot, "problema")
              .agg(F.count(F.lit(1)).alias("linhas")))
    if listed is not None:
        silent = listed.select(snapshot).distinct().join(back.select(snapshot).distinct(), "instantaneo", "left_anti")
        report = report.unionByName(silent.select("instantaneo", F.lit(NO_RECORD).alias("problema"), F.lit(0).cast("long").alias("linhas")))
    if on_problem == "fail":
        shown = report.orderBy("instantaneo", "problema").limit(SHOWN).collect()
        if shown:
            detail = "; ".join(f"{r['instantaneo']}: {r['problema']} ({r['linhas']})" for r in shown)
            raise IntakeError(f"unusable input among {counts['registros']} records: {detail}")
    return Intake(back.where(F.col("problema").isNull()).drop("problema", "_corrupt_record"),
                  back.where(F.col("problema").isNotNull()), report, counts)
