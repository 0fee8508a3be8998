"""Session settings and the shared folder that eager intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# A table is broadcast only after it was counted and found within both bounds.
BROADCAST_ROWS_CONF = "tidemark.broadcast.maxRows"
BROADCAST_ROWS_DEFAULT = 1_000_000
BROADCAST_BYTES_CONF = "tidemark.broadcast.maxBytes"
BROADCAST_BYTES_DEFAULT = 128 << 20


def build_session(master: str = "local[*]", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(master)
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors can reach.

    Only a local-mode session may leave it unset; a temporary folder serves then.
    """
    context = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not base:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="tidemark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return base


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` now and cut its lineage through the reliable checkpoint folder.

    For small intermediate tables that several later steps read: the values are
    fixed, survive the loss of executors and are not derived again per reader.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_BYTES_CONF, str(BROADCAST_BYTES_DEFAULT)))


def broadcast_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_ROWS_CONF, str(BROADCAST_ROWS_DEFAULT)))
