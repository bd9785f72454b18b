"""Stored tables: optional CSV, JSONL, row limits, and the source summary."""

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_or_empty(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """CSV with header; a missing path and a file without rows are an empty table.

    Values with line ends need ``multi_line``, which reads a file in one task; without it
    large files are split.
    """
    try:
        return (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .option("escape", '"')
            .option("multiLine", multi_line)
            .csv(path)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def parse_jsonl(df: DataFrame, line: str | Column, schema: T.StructType) -> DataFrame:
    """The same for lines that already are a text column; blank ones are skipped."""
    line = line if isinstance(line, Column) else F.col(line)
    rows = df.filter(F.trim(line) != "").select(F.from_json(line, schema).alias("_row"))
    return rows.select("_row.*")


def first_rows(df: DataFrame, limit: int, *order: str | Column) -> DataFrame:
    """The first ``limit`` rows in a stated order (top-k per task, then merged)."""
    return df.orderBy(*order).limit(limit)


def source_summary(
    spark: SparkSession, sources: Mapping[str, DataFrame | Callable[[], DataFrame]]
) -> DataFrame:
    """Row count and availability per source.

    A source is a DataFrame or a function that opens one. Status is ``Available``, or
    ``Not downloaded`` (path missing), or ``Error`` (the source cannot be opened).
    """
    parts = []
    for name, source in sources.items():
        status, df = "Available", None
        try:
            df = source() if callable(source) else source
        except AnalysisException as error:
            missing = error.getCondition() == "PATH_NOT_FOUND"
            status = "Not downloaded" if missing else "Error"
        if df is None:
            part = spark.range(1).select(F.lit(None).cast("long").alias("records"))
        else:
            part = df.agg(F.count(F.lit(1)).alias("records"))
        parts.append(part.select(F.lit(name).alias("source"), "records", F.lit(status).alias("status")))
    return reduce(DataFrame.unionByName, parts)


def select_optional(df: DataFrame, required: Sequence[str], optional: Sequence[str]) -> DataFrame:
    """Required columns and those optional ones that exist."""
    return df.select(*required, *[name for name in optional if name in df.columns])
