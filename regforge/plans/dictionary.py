"""A stored look-up dictionary: names are asked once, answers stay in a bucketed table."""

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regforge.functions.text import clean_name
from regforge.operators.enrich import enrich
from regforge.plans.stages import staged

KEY, TIME = "drug_name", "answered_at"


class StoredDictionary:
    """Answers by name in a folder, bucketed by name.

    A join or an aggregate by name reads the table without an exchange: only the (few) names
    that are asked for are dealt out. ``buckets`` should be no less than the shuffle
    partitions of the session, or Spark prefers to deal out both sides. Answers are appended;
    of several for one name the newest counts (``answered_at``, then the attributes), until
    ``compact`` leaves only that one. A name without an answer is stored with NULL attributes,
    so it is not asked again.
    """

    def __init__(self, spark: SparkSession, path: str, attributes: T.StructType, buckets: int = 200):
        self.spark, self.path, self.attributes, self.buckets = spark, path, attributes, buckets
        self.table = "stored_dictionary_" + hashlib.sha256(path.encode()).hexdigest()[:16]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [T.StructField(KEY, T.StringType()), *attributes, T.StructField(TIME, T.LongType())])
        # Describes the folder to this session; files that are there stay.
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}) USING parquet "
            f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def answers(self) -> DataFrame:
        """All answers, also the ones that were replaced."""
        return self.spark.table(self.table)

    def newest(self) -> DataFrame:
        """One row per name."""
        row = F.max(F.struct(TIME, *self.attributes.names)).alias("_row")
        return self.answers().groupBy(KEY).agg(row).select(KEY, *[f"_row.{n}" for n in self.attributes.names], f"_row.{TIME}")

    def unknown(self, df: DataFrame, name: str) -> DataFrame:
        """The distinct usable names of ``df`` that were never asked."""
        names = df.select(clean_name(name).alias(KEY)).filter(F.col(KEY).isNotNull()).distinct()
        return names.join(self.answers().select(KEY), KEY, "left_anti")

    def _write(self, rows: DataFrame, overwrite: bool = False) -> None:
        placed = rows.select(KEY, *self.attributes.names, TIME).repartition(self.buckets, KEY).sortWithinPartitions(KEY)
        placed.write.insertInto(self.table, overwrite=overwrite)

    def add(self, answers: DataFrame, at: int) -> None:
        """Appends answers (name and attributes), given at time ``at``."""
        self._write(answers.withColumn(TIME, F.lit(at).cast("long")))

    def ask(self, df: DataFrame, name: str, source: Callable[[DataFrame], DataFrame], at: int) -> int:
        """Asks ``source`` for the unknown names of ``df`` and stores what it answers; returns
        how many were asked. ``source`` gets one column of names and returns names with
        attributes, at most one row each."""
        names = staged(self.unknown(df, name))
        found = names.join(source(names), KEY, "left")
        self.add(found, at)
        return names.count()

    def compact(self) -> None:
        """Keeps the newest answer of every name. The rows are staged before the table is
        rewritten, so they survive a run that is broken off."""
        self._write(staged(self.newest()), overwrite=True)

    def look_up(self, df: DataFrame, name: str) -> DataFrame:
        """The distinct usable names of ``df`` with their newest answer; NULLs without one."""
        names = df.select(clean_name(name).alias(KEY)).filter(F.col(KEY).isNotNull()).distinct()
        return names.join(self.newest(), KEY, "left")

    def enrich(self, df: DataFrame, name: str) -> DataFrame:
        """All rows of ``df`` with the attributes of their name. The table is read for the
        distinct names only; those answers then meet the rows, where a hot name can be split."""
        return enrich(df, name, self.look_up(df, name).drop(TIME), KEY)
