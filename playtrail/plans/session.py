"""Session settings the jobs are written for."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings for every job: AQE re-plans joins and partition counts from
# runtime sizes and splits skewed join partitions; times are zone-less.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Chunk summaries are joined by more keys than the rows are shuffled by: the rows stay in place.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # RDD checkpoints go once nothing refers to them; tables written beside them stay.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "playtrail") -> SparkSession:
    """A local session for tests and the benchmark.

    A checkpoint folder is only created here, and only when the session
    does not name one already; on a cluster ``spark.checkpoint.dir`` must
    point at shared storage.
    """
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # Small local data: let AQE keep one shuffle partition per core for the
    # window stages instead of merging them into one or two (1 MB minimum).
    builder = builder.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    builder = builder.config("spark.driver.memory", os.environ.get("PLAYTRAIL_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_local_checkpoint_dir(spark)
    return spark


def ensure_local_checkpoint_dir(spark: SparkSession) -> None:
    """Local sessions only: use a fresh scratch folder when no checkpoint folder is
    set, and remove it when the program ends. On a cluster, a folder of the
    driver's own machine would be invisible to the executors: that is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return
    if not re.match(r"local($|\[)", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder that every executor can reach")
    scratch = tempfile.mkdtemp(prefix="playtrail-ckpt-")
    atexit.register(shutil.rmtree, scratch, ignore_errors=True)
    sc.setCheckpointDir(scratch)
