"""Session helpers: reliable checkpoints that outlive an executor."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for reliable checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without
    that setting gets a temporary folder; a cluster without it is an error, since a
    folder on one machine would be lost with that machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="assayer-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def keep_last_of_repeated_keys(spark: SparkSession) -> None:
    """Let JSON objects that repeat a key be read; the last value counts, as in most JSON readers."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files and cleanable checkpoints of finished steps now.

    It does so once the driver's JVM finds that nothing refers to them, and a driver with little to do may not look for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
