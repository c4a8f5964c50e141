"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings every job relies on. They are applied to whatever session the caller brings.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Small inputs still spread over the cores; large ones are split by the advisory size anyway.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot book or user keeps its skew split even when a later step needs another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benches."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("foliospark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = prepare(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """A fresh folder under the shared checkpoint folder, which ``spark.checkpoint.dir`` names.

    Only a local-mode session may fall back to a temporary folder: on a cluster the executors
    would not share it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix="run-", dir="/tmp")
    jvm = spark.sparkContext._jvm
    return f"{shared.rstrip('/')}/foliospark-{jvm.java.util.UUID.randomUUID().toString()}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder; keep a folder already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or work_folder(spark))
