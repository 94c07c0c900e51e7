"""Session helpers: a local session for tests and lineage cutting that survives executor loss."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every plan relies on. On a cluster they belong in spark-defaults.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when a later operator then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Flattened keys that collide: the later one wins.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def local_session(cores: int | str = 8, app: str = "sluice", **extra: str) -> SparkSession:
    """A session for tests and the benchmark; production jobs bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SLUICE_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and stage tables.

    ``spark.checkpoint.dir`` names the shared folder on a cluster. Only a session without that
    setting (tests) falls back to a folder of its own.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if configured is None:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            configured = tempfile.mkdtemp(prefix="sluice-checkpoint-")
        spark.sparkContext.setCheckpointDir(configured)
        current = configured
    return configured or current


def reliable(df: DataFrame) -> DataFrame:
    """Cut the lineage into replicated storage; partition numbers and row order are kept."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: only its columns are stored, and later scans
    read those they need. Like a checkpoint, it cuts the lineage and survives lost executors."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/tables/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
