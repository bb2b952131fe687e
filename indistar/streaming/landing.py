"""Landing-zone ingest: new snapshot files -> merged published table.

A file-stream source over file metadata picks up only files not seen before
(tracked in the query checkpoint).  Each micro-batch reads its files with the
batch reader, accounts for every record (``take_in``), types them with the same
recipe as the batch job and merges them into the published table.  A file that
cannot be used stops the query before anything of its batch is published and
the checkpoint has not moved, so nothing is lost; ``on_problem="quarantine"``
sets such records aside and goes on.  The upsert is idempotent, so a micro-batch
replayed after an executor or driver failure leaves the table unchanged.  The
checkpoint lives under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import publish as pb
from ..plans import datasets as ds
from ..session import checkpoint_dir
from ..sources import catalog as cat
from ..sources import readers as rd
from ..sources.intake import SHOWN, IntakeError, take_in
from ..sources.schemas import FLAT_ITEM_SCHEMA
from ..sources.snapshots import LANDED_FILES, empty_documents

KEYS = ["serie_id", "data_referencia"]
FILES_A_BATCH = 1000  # paths that the driver handles at a time


def landed_files_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int = FILES_A_BATCH) -> DataFrame:
    """Stream of newly landed files: ``path, arquivo_caminho``; contents are not read."""
    return (spark.readStream.format("binaryFile")
            .schema("path string, modificationTime timestamp, length long, content binary")
            .option("pathGlobFilter", LANDED_FILES)
            .option("recursiveFileLookup", True)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .load(landing_dir)
            .select("path", F.col("_metadata.file_path").alias("arquivo_caminho")))


def ingest_landed_series(spark: SparkSession, landing_dir: str, table_root: str,
                         checkpoint: str | None = None, series: dict | None = None,
                         available_now: bool = True, keys: Sequence[str] = KEYS,
                         partition_by: Sequence[str] | None = None, on_problem: str = "fail",
                         max_files_per_trigger: int = FILES_A_BATCH):
    """Start the ingest query; with ``available_now`` it drains what is
    landed and stops (a scheduled incremental job).

    By default each micro-batch writes the whole table anew.  For a large
    table pass ``partition_by`` (e.g. ``["ano"]``, a function of the key date):
    a micro-batch then rewrites only the partitions its keys fall in.
    Quarantined records lie below ``<table>_quarentena`` beside the table.
    """
    series = cat.SERIES if series is None else series
    if checkpoint is None:
        # stable across processes (str hash is salted per interpreter)
        tag = hashlib.sha1(table_root.encode("utf-8")).hexdigest()[:16]
        checkpoint = f"{checkpoint_dir(spark).rstrip('/')}/landing_{tag}"

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        empty = [r[0] for r in empty_documents(session, landing_dir).limit(SHOWN).collect()]
        if empty and on_problem == "fail":
            raise IntakeError(f"documents of zero bytes: {empty}")
        paths = [r["path"] for r in batch.select("path").collect()]  # at most max_files_per_trigger
        if not paths:
            return
        known = session.createDataFrame([(n, c["codigo"]) for n, c in series.items()], "serie string, codigo int")
        folder = f"{table_root.rstrip('/')}_quarentena/lote_{epoch_id}_{uuid.uuid4().hex}"
        taken = take_in(rd.read_landed(session, paths, FLAT_ITEM_SCHEMA), folder, known, ["serie", "codigo"],
                        batch.select("arquivo_caminho"), on_problem)
        typed = ds.bacen_from_raw(taken.good, series)
        pb.upsert(session, typed, table_root, list(keys), list(partition_by or ()))

    writer = (landed_files_stream(spark, landing_dir, max_files_per_trigger)
              .writeStream.foreachBatch(merge_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
