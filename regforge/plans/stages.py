"""Stage boundaries: results that several later steps read."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def stage_folder(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``.

    That folder has to be one that all executors share, so that a lost executor loses
    nothing. Only a session on one machine may leave the setting out.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), f"regforge-{os.getpid()}")
    return f"{folder.rstrip('/')}/stage-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once as Parquet to a ``stage_folder`` and read back.

    This is an action: it runs the jobs of ``df`` now, and later steps read what they wrote.
    """
    spark = df.sparkSession
    path = stage_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
