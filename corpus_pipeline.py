"""The pipeline over ``documents``: toxicity, near-dedup, decontamination, mixing, shards.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame. Every stage works on all rows its predecessor kept, and all but the last return
the columns of the documents. Documents that are toxic with a score of 0.3 or more go; of
documents linked by a five-word shingle similarity of 0.8 or more, the one with the lowest
id stays; documents that hold a benchmark passage go; the mix repeats or leaves out whole
documents; the last stage gives every document left its shard and slot.

Documents are told apart by id and text: different texts under one id, or without an id,
are different documents. Of rows that repeat both, one stays in the second stage, except
texts without words under a NULL id, which all stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regforge.llm import toxicity
from regforge.llm.common import small_batches, staged, table, text_of
from regforge.llm.decontaminate import contaminated_documents
from regforge.llm.mixing import mixed_documents
from regforge.llm.near_dedup import near_duplicates
from regforge.llm.sharding import kd_shards

TOXIC = 0.3
NEAR_PERCENT = 80
BROADCAST_ROWS = 1_000_000
TEXT_ROWS = 500

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    # Whole texts go through Python: few at a time, here and not when the stage is written.
    with small_batches(spark, TEXT_ROWS):
        return staged(toxicity.scored(docs, model).filter(F.col("__score") < TOXIC).drop("__score"), "not-toxic")


def key_of() -> Column:
    """One number per id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), text_of())


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` but for the documents in ``keys`` (a staged column ``__id``).

    The keys are broadcast up to a counted bound; beyond it the join shuffles.
    """
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return docs.join(keys, key_of() == F.col("__id"), "left_anti")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = docs.select(key_of().alias("doc_id"), text_of().alias("text"))
    found = near_duplicates(keyed, NEAR_PERCENT).groupBy(F.col("doc_id").alias("__id"))
    found = found.agg(F.max("component_id").alias("component"), F.max("n_shingles").alias("words"), F.count(F.lit(1)).alias("n"))
    ids = docs.select(key_of().alias("__id"), F.col("doc_id").cast("long").alias("id")).distinct()
    found = staged(found.join(ids, "__id"), "group-keys")
    # The lowest id of a component stays, a NULL id only if there is no other.
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "__id")).alias("first")
    kept = found.filter("words > 0").groupBy("component").agg(first).select(F.col("first.__id").alias("kept"))
    found = found.join(kept, F.col("__id") == F.col("kept"), "left").withColumn("stays", (F.col("words") == 0) | F.col("kept").isNotNull())
    found = staged(found.filter("not stays or (n > 1 and (words > 0 or id is not null))").select("__id", "stays"), "group-ids")
    single = without(docs, found.select("__id"))
    repeated = found.filter("stays").select("__id")
    if repeated.isEmpty():
        return single
    several = docs.withColumn("__key", key_of()).join(repeated, F.col("__key") == F.col("__id"), "left_semi")
    one = several.groupBy("__key").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("__row"))
    return single.unionByName(one.select("__row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = docs.select(key_of().alias("doc_id"), "text")
    found = contaminated_documents(keyed, table(spark, sf_dir, "benchmark"))
    return without(docs, staged(found.select(F.col("doc_id").alias("__id")).distinct(), "contaminated"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kd_shards(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", one_of_each_group),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Models, draws and a tree of medians: SQL cannot express them; the tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
