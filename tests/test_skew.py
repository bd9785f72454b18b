"""One key, source or text holds a third of all rows or more; results stay whole, and no
plan has a cross join or an unpartitioned step over the rows."""

import pytest
from pyspark.sql import functions as F

from regforge.operators import enrich, instruct, joins, metrics, names, split, topk
from workloads.queries import QUERIES


def hot(spark, n=30000):
    """A third of the rows are 'hot'; the others are spread."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), (F.col("id") % 500).cast("string"))).alias("name"),
        F.col("id").alias("position"),
        F.concat(F.lit("v"), (F.col("id") % 1000).cast("string")).alias("value"),
        F.when(F.col("id") % 7 == 0, "COMPLETED").otherwise("WITHDRAWN").alias("status"),
    )


def test_hot_name_in_dictionary_and_first_values(spark):
    df = hot(spark)
    listed = names.names_from_lists(df, "name", "tri", "status", "position")
    got = {r["drug_name"]: r["status"] for r in names.name_dictionary([listed], ["tri"]).collect()}
    assert got["hot"] == "COMPLETED" and len(got) == 501
    first = topk.first_k_distinct(df, "name", "value", "position", 5, "name", "values")
    values = {r["name"]: r["values"] for r in first.collect()}
    assert values["hot"] == "v0; v3; v6; v9; v12" and len(values) == 501


def test_partial_aggregation_leaves_few_rows_of_a_hot_name(spark):
    df = hot(spark).withColumn("value", F.col("status"))
    plan = topk.first_k_distinct(df, "name", "value", "position", 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange")  # below the shuffle


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_hot_name_in_joins(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = hot(spark)
        dictionary = df.groupBy("name").agg(F.min("position").alias("cid")).filter("name <> 'n1'")
        assert enrich.enrich(df, "name", dictionary, "name").count() == 30000
        # The hot name repeats on the right side of a left join.
        left = df.select("name").distinct().union(spark.createDataFrame([("alone",)], "name string"))
        many = joins.left_join_many(left, df.select("name", "position"), "name")
        assert many.count() == 30001
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_entity_in_an_exact_split(spark):
    """A key with a third of the rows is one row where the boundary is looked for."""
    df = hot(spark)
    got = split.split_exact(df.select("name"), "name").groupBy("name").agg(F.countDistinct("split").alias("n")).filter("n > 1")
    assert got.count() == 0
    plan = split.split_exact(df.select("name"), "name")._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan


def test_copies_of_one_structure(spark):
    df = hot(spark).select(
        F.concat(F.lit("d"), F.lpad(F.col("position").cast("string"), 9, "0")).alias("drug_name"),
        F.col("name").alias("canonical_smiles"), "status",
    )
    got = {r["canonical_smiles"]: r["drug_name"] for r in instruct.classification_rows(df).collect()}
    assert got["hot"] == "d000000000" and len(got) == 501


def test_hot_candidate(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "CCCCCCO x CCCCCCO").otherwise(F.concat(F.lit("NNNNNN"), F.col("id").cast("string"))).alias("prediction"))
    known = spark.createDataFrame([("CCCCCCO",)], "canonical_smiles string")
    got = metrics.known_structure_rate(df, known, reference=None).first()
    assert (got["candidates"], got["valid_smiles_count"]) == (4000, 2000)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_in_any_query(spark, smoke_folder, name):
    plan = QUERIES[name](spark, smoke_folder)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python


def test_adaptive_join_splits_the_hot_name_on_either_side(spark):
    """With thresholds scaled down to the test data: the partition of the hot name is
    split in the look-up join (left side) and in the fan-out join (right side)."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = hot(spark, 200000).repartition(16)
        dictionary = df.groupBy("name").agg(F.min("position").alias("cid"))
        left = df.select("name").distinct()
        for joined in (enrich.enrich(df, "name", dictionary, "name"), joins.left_join_many(left, df, "name")):
            assert len(joined.collect()) == 200000
            assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
