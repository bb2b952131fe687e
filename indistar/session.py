"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings a job relies on; cluster deployments may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "indistar",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with AQE on and a UTC session zone.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster
    leave them unset so the submit-time settings win.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, total_cores: int,
               partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Sizing for a cluster run over ``input_bytes`` of Parquet.

    Scan splits and post-shuffle partitions target ``partition_bytes`` so a
    task's working set fits executor memory; the initial shuffle partition
    count covers the whole input at that size (at least two waves of the
    cores) and AQE coalesces what turns out smaller and splits skewed
    partitions of sort-merge joins.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // partition_bytes))
    mb = f"{partition_bytes // (1024 * 1024)}m"
    return {
        "spark.sql.files.maxPartitionBytes": mb,
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": mb,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * partition_bytes // (1024 * 1024)}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster setting always wins.  Only when it is unset and the master is
    ``local[...]`` (tests) a private scratch folder is created; on a cluster
    an unset value is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: checkpoints in a "
                           "machine-local folder do not survive the loss of an executor")
    local = tempfile.mkdtemp(prefix="indistar-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
