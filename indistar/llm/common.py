"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indistar.session import checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def utf8(col: str = "text") -> Column:
    """The text's UTF-8 bytes; null stays null."""
    return F.col(col).cast("string").cast("binary")


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` equals that on pure ASCII and is much
    faster there; other texts go through ``translate``."""
    return F.when(F.length(col) == F.octet_length(col), F.lower(col)).otherwise(
        F.translate(col, UPPER, LOWER))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written intermediate table, below the shared
    folder the cluster names in ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: evaluated once,
    and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts(text: str, size: int, blanks: str = " \t\n\r") -> Iterator[str]:
    """Cut a long text into parts of about ``size`` characters, each cut in
    front of a single space between two non-blank characters."""
    start, n = 0, len(text)
    while n - start > size:
        at = text.find(" ", start + size)
        while 0 < at < n - 1 and (text[at - 1].isspace() or text[at + 1].isspace()
                                  or text[at - 1] in blanks or text[at + 1] in blanks):
            at = text.find(" ", at + 1)
        if at <= 0 or at >= n - 1:
            break
        yield text[start:at]
        start = at
    yield text[start:]


_held: dict = {}


def claim(owner: str, clear=lambda: None) -> None:
    """Caches of one operator at a time: a reused Python worker drops those
    of the operator that ran in it before."""
    for other in [o for o in _held if o != owner]:
        _held.pop(other)()
    _held[owner] = clear


def _give_back() -> None:
    """Return freed memory of this process to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


BATCH_BYTES = 4 << 20


def map_texts(rows: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` over rows with whole texts: batches are bounded by their
    bytes, unless the session sets a bound of its own, and the Python worker,
    which Spark keeps for later tasks, gives back what the task has freed."""
    conf, name = rows.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name, None) is None:
        conf.set(name, str(BATCH_BYTES))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _give_back()
    return rows.mapInArrow(whole, schema)
