"""Session settings the plans are written for."""

import os
import tempfile

from pyspark.sql import SparkSession

# Skew splitting also where it costs one more exchange; everything else is Spark's
# default or has to be sized for the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Sets what the plans rely on in a session that the cluster gave; static settings stay."""
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Single-machine session for tests and the bench."""
    cpus = cpus or os.cpu_count() or 1
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("regforge")
        .config("spark.driver.memory", os.environ.get("REGFORGE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        # One machine, so its temporary folder is shared by all that runs.
        .config("spark.checkpoint.dir", os.path.join(tempfile.gettempdir(), f"regforge-{os.getpid()}"))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
