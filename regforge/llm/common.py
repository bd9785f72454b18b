"""Helpers shared by the operators: tables, staged results, folds, words."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The blanks that separate words, as a regular expression class.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share.

    Only a session on one machine may leave that setting out; it then gets a folder in
    the machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.gettempdir()}/regforge-{os.getpid()}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(frame: DataFrame, name: str) -> DataFrame:
    """The rows of ``frame``, written once to the shared folder and read from there.

    This runs a job. Later steps read files instead of repeating the work, also after an
    executor is lost.
    """
    spark = frame.sparkSession
    path = scratch(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside hand Python ``rows`` rows at a time, for rows that may be large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new shared folder as a path for plain file access, for memory-mapped arrays."""
    uri = urlparse(scratch(spark, name))
    if uri.scheme not in ("", "file"):
        raise ValueError("memory-mapped arrays need spark.checkpoint.dir on a mounted file system")
    os.makedirs(uri.path, exist_ok=True)
    return uri.path


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``: decides what is held out."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds).cast("long"))


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Words between blanks, without an array of them."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def shards_for(rows: int, per_shard: int) -> int:
    return max(1, -(-rows // per_shard))
