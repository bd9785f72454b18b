"""Batch generation with a generator the caller brings, also in several attempts."""

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUEST, ATTEMPT = "request", "attempt"


def batch_generate(
    df: DataFrame,
    make_generator: Callable[..., Callable[[pd.DataFrame], Sequence[str]]],
    name: str = "response",
    **options: Any,
) -> DataFrame:
    """All columns of ``df`` plus the generated text.

    ``make_generator(**options)`` runs once per task, so that a model is loaded once,
    and returns a function from a batch of rows to one text per row. Rows stay in their
    partitions; batches are Arrow record batches.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generate = make_generator(**options)
        for batch in batches:
            yield batch.assign(**{name: list(generate(batch))})

    return df.mapInPandas(run, schema)


def with_request(df: DataFrame, columns: Sequence[str], name: str = REQUEST) -> DataFrame:
    """A key per request: the digest of what is asked."""
    return df.withColumn(name, F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256))


def stored_responses(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per request that was answered, of repeated ones that of the earliest attempt.
    ``schema`` is that of the answered rows."""
    stored = T.StructType([*schema.fields, T.StructField(ATTEMPT, T.IntegerType())])
    try:
        rows = spark.read.schema(stored).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], stored)
    rest = [c for c in rows.columns if c not in (REQUEST, ATTEMPT)]
    first = rows.groupBy(REQUEST).agg(F.min(F.struct(ATTEMPT, *rest)).alias("_row"))
    return first.select(*[F.col(c) if c == REQUEST else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def generate_rest(
    df: DataFrame,
    columns: Sequence[str],
    make_generator: Callable[..., Callable[[pd.DataFrame], Sequence[str]]],
    path: str,
    attempt: int,
    name: str = "response",
    **options: Any,
) -> DataFrame:
    """Answers the requests of ``df`` that are not yet below ``path``; returns all stored ones.

    ``columns`` make up a request; equal requests are asked once. Every task publishes its
    answers when it ends, so a run that breaks off keeps what its finished tasks made, and
    the next one (with a higher ``attempt``) asks for the rest only. A task that is run twice
    may leave an answer twice; reading removes repeats. Runs the job.
    """
    requests = with_request(df.select(*columns), columns).dropDuplicates([REQUEST])
    schema = T.StructType([*requests.schema.fields, T.StructField(name, T.StringType())])
    done = stored_responses(df.sparkSession, path, schema).select(REQUEST)
    answered = batch_generate(requests.join(done, REQUEST, "left_anti").select(*requests.columns), make_generator, name, **options)
    writer = answered.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.parquet(f"{path.rstrip('/')}/{ATTEMPT}={attempt}")
    return stored_responses(df.sparkSession, path, schema)
