import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from regforge.operators import split


def frame(spark, n, labels=None):
    df = spark.range(n).withColumnRenamed("id", "key")
    return df if labels is None else df.join(spark.createDataFrame(list(enumerate(labels)), "key long, label int"), "key")


def sides(df):
    return {r["key"]: r["split"] for r in df.select("key", "split").collect()}


def expected_sizes(n):
    held = math.ceil((1 - 0.8) * n)
    test = math.ceil(held * 0.5)
    return {k: v for k, v in {"train": n - held, "val": held - test, "test": test}.items() if v}


@pytest.mark.parametrize("n", [1, 2, 3, 10, 15, 100, 5913])
def test_exact_sizes(spark, n):
    got = sides(split.split_exact(frame(spark, n), "key"))
    assert len(got) == n and dict(Counter(got.values())) == expected_sizes(n)


def test_recorded_sizes():
    assert expected_sizes(5913) == {"train": 4730, "val": 591, "test": 592}


def test_exact_follows_the_hash_order(spark):
    got = sides(split.split_exact(frame(spark, 1000), "key"))
    order = sorted(range(1000), key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), str(k)))
    want = ["train"] * 800 + ["val"] * 100 + ["test"] * 100
    assert got == dict(zip(order, want))


def test_splits_do_not_depend_on_partitioning(spark):
    labels = [i % 3 == 0 for i in range(700)]
    for make in (
        lambda df: split.split_by_hash(df, "key"),
        lambda df: split.split_exact(df, "key"),
        lambda df: split.split_stratified(df, "key", "label"),
    ):
        df = frame(spark, 700, [int(x) for x in labels])
        assert sides(make(df.repartition(1))) == sides(make(df.repartition(23, F.rand(3))))


def test_rows_of_one_key_stay_together(spark):
    df = frame(spark, 300).withColumn("copy", F.explode(F.array(*[F.lit(i) for i in range(3)])))
    per_key = split.split_exact(df, "key").groupBy("key").agg(F.countDistinct("split").alias("n"))
    assert per_key.filter("n > 1").count() == 0


def test_hash_split_is_stable_and_roughly_right(spark):
    got = sides(split.split_by_hash(frame(spark, 5000), "key"))
    more = sides(split.split_by_hash(frame(spark, 6000), "key"))
    assert all(more[k] == v for k, v in got.items())
    counts = Counter(got.values())
    assert abs(counts["train"] - 4000) < 150 and abs(counts["val"] - 500) < 100


def test_hash_split_limits(spark):
    assert split._hash_limit(0.5) == "80000000" and split._hash_limit(1.0) == "g" and split._hash_limit(0.0) == "00000000"
    df = frame(spark, 200)
    assert set(sides(split.split_by_hash(df, "key", 1.0, 0.0)).values()) == {"train"}
    assert set(sides(split.split_by_hash(df, "key", 0.0, 1.0)).values()) == {"val"}


def test_other_seed_other_split(spark):
    df = frame(spark, 500)
    assert sides(split.split_exact(df, "key")) != sides(split.split_exact(df, "key", seed=7))


def largest_remainder(counts, draws):
    total = sum(counts.values())
    exact = {k: c * draws / total for k, c in counts.items()}
    out = {k: math.floor(v) for k, v in exact.items()}
    rest = draws - sum(out.values())
    for k in sorted(counts, key=lambda k: (-(exact[k] - out[k]), k))[:rest]:
        out[k] += 1
    return out


@pytest.mark.parametrize("counts", [{0: 300, 1: 700}, {0: 33, 1: 34, 2: 33}, {0: 11, 1: 13}, {0: 6, 1: 9}])
def test_stratified_sizes(spark, counts):
    labels = [label for label, n in counts.items() for _ in range(n)]
    df = split.split_stratified(frame(spark, len(labels), labels), "key", "label")
    got = Counter((r["label"], r["split"]) for r in df.collect())
    n = len(labels)
    sizes = expected_sizes(n)
    train = largest_remainder(counts, sizes["train"])
    held = {k: counts[k] - train[k] for k in counts}
    val = largest_remainder(held, sizes["val"])
    for label in counts:
        assert got[(label, "train")] == train[label]
        assert got[(label, "val")] == val[label]
        assert got[(label, "test")] == held[label] - val[label]


@pytest.mark.parametrize("counts", [{0: 5, 1: 105}, {0: 4, 1: 5}, {0: 1, 1: 60}])
def test_too_small_to_split(spark, counts):
    labels = [label for label, n in counts.items() for _ in range(n)]
    got = sides(split.split_stratified(frame(spark, len(labels), labels), "key", "label"))
    assert len(got) == len(labels) and set(got.values()) == {"all"}


def main_plan(df):
    """The lines of a plan outside its subqueries."""
    lines = df._jdf.queryExecution().sparkPlan().toString().split("\n")
    return [line for line in lines if ":" not in line[: len(line) - len(line.lstrip(" :+-"))]]


def test_hot_label_is_not_shuffled(spark):
    """Nearly all rows share a label: the rows are not joined or shuffled at all."""
    rows = spark.range(2000).selectExpr("id as key", "cast(id >= 100 as int) as label")
    df = split.split_stratified(rows, "key", "label")
    assert not any(step in line for line in main_plan(df) for step in ("Exchange", "Join", "Cartesian"))
    assert df.count() == 2000


def test_exact_split_does_not_shuffle_the_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("key"), F.lit("x").alias("payload"))
    plan = split.split_exact(df, "key")._jdf.queryExecution().executedPlan().toString()
    outer = plan[: plan.index("Subquery")] if "Subquery" in plan else plan
    assert "Exchange" not in outer


def test_split_counts(spark):
    got = split.split_counts(split.split_exact(frame(spark, 100), "key"), "d")
    assert {r["split"]: r["rows"] for r in got.collect()} == {"train": 80, "val": 10, "test": 10}


def test_more_labels_than_are_broadcast(spark, monkeypatch):
    """Beyond the bound the labels are joined, with the same result."""
    df = spark.range(3000).select(F.col("id").alias("key"), (F.col("id") % 12).cast("string").alias("label"))
    df = df.union(spark.createDataFrame([(9999, None)], "key long, label string"))
    want = {(r["key"], r["split"]) for r in split.split_stratified(df, "key", "label").collect()}
    monkeypatch.setattr(split, "MAX_LABELS", 3)
    joined = split.split_stratified(df, "key", "label")
    assert joined.columns == ["key", "label", "split"] and {(r["key"], r["split"]) for r in joined.collect()} == want and len(want) == 3001
