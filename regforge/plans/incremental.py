"""Names kept up to date while extracts land one after another.

The state of a name is what later landings can be merged into: the sources as a bit mask, the
first known status with its place, and of every value list the first k distinct values with
their places. Each part is a union, a minimum or the head of an ordered set, so landings may
come in any order, and one that is merged twice changes nothing: a run that was broken off is
repeated as it is.

The state lies in a folder with one sub-folder per bucket of names (by hash). A landing is
aggregated by name first, so a name with a third of its rows is one row; only the buckets it
touches are read and rewritten.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regforge import constants as C
from regforge.operators.names import merged_names, rendered_names
from regforge.operators.topk import first_k_places, rendered_places
from regforge.plans.stages import staged

_BUCKET = "bucket"


@dataclass(frozen=True)
class NameState:
    """Where the state lies and what it holds: the ranked sources, and per value list its k."""

    path: str
    order: Sequence[str] = (C.REGISTRY_SOURCE, C.LABEL_SOURCE, C.TRIAL_SOURCE)
    values: Mapping[str, int] = field(default_factory=lambda: {"adverse_reactions": C.MAX_REACTIONS, "failure_reason": C.MAX_REASONS})
    buckets: int = 64


def landing(state: NameState, names: Sequence[DataFrame], values: Mapping[str, DataFrame]) -> DataFrame:
    """The state of one landing alone.

    ``names`` are tagged clean names as ``names_from_columns`` and ``names_from_lists`` return
    them, ``values`` has (drug_name, value, position) per value list; both may lack parts.
    """
    parts = [merged_names(names, state.order, clean=False)] if names else []
    parts += [first_k_places(rows, "drug_name", "value", "position", state.values[name]).withColumnRenamed("values", name) for name, rows in values.items()]
    return _merged(state, reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts))


def _merged(state: NameState, rows: DataFrame) -> DataFrame:
    """One row per name from the rows of several states; a part that is missing is empty."""
    kinds = {"mask": "long", "first": "struct<rank:int,position:long,status:string>"}
    kinds |= {name: "array<struct<position:long,value:string>>" for name in state.values}
    rows = rows.select("drug_name", *[(F.col(c) if c in rows.columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()])
    rows = rows.withColumn(_BUCKET, F.pmod(F.xxhash64("drug_name"), F.lit(state.buckets)).cast("int")).repartition(_BUCKET)
    lists = [F.array_sort(F.flatten(F.collect_list(name))).alias(name) for name in state.values]
    found = rows.groupBy(_BUCKET, "drug_name").agg(F.bit_or(F.coalesce("mask", F.lit(0))).alias("mask"), F.min("first").alias("first"), *lists)
    return found.withColumns({name: F.slice(_distinct(F.col(name)), 1, k) for name, k in state.values.items()})


def _distinct(places: Column) -> Column:
    """Of equal values the first place."""
    values = F.transform(places, lambda y: y["value"])
    return F.filter(places, lambda x, i: F.array_position(values, x["value"]) == i + 1)


def _stored(spark: SparkSession, state: NameState, like: DataFrame) -> DataFrame:
    try:
        return spark.read.schema(like.schema).parquet(state.path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], like.schema)


def merge_landing(spark: SparkSession, state: NameState, new: DataFrame) -> None:
    """Merges the state of a landing into the stored one. Runs jobs; may be repeated."""
    new = staged(new)
    # At most as many numbers as there are buckets.
    touched = [r[0] for r in new.select(_BUCKET).distinct().collect()]
    if not touched:
        return
    old = _stored(spark, state, new).filter(F.col(_BUCKET).isin(touched))
    merged = staged(_merged(state, old.unionByName(new)))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(state.path)


def current_names(spark: SparkSession, state: NameState) -> DataFrame:
    """``(drug_name, source, status)`` and the value lists, as one full build gives them.
    Names that only occur with values, not in a source, are left out, as in the joins of a
    full build."""
    like = _merged(state, spark.createDataFrame([], "drug_name string"))
    rows = _stored(spark, state, like).filter("mask <> 0")
    named = rendered_names(rows, state.order, keep=list(state.values))
    return named.select("drug_name", "source", "status", *[rendered_places(name).alias(name) for name in state.values])
