"""Order that nothing but files carries: row numbers, page bounds, sorted output."""

import json

import pytest
from pyspark.sql import functions as F

from regforge import sinks
from regforge.operators import metrics
from regforge.operators.running import with_running_totals
from regforge.plans.stages import stage_folder
from regforge.sources import positions, registry


def test_running_totals(spark):
    rows = [(i * 7 % 1000, i % 5, 1) for i in range(1000)]
    got = with_running_totals(spark.createDataFrame(rows, "k int, v int, one int").repartition(7), ["k"], {"v": "before", "one": "n"}).collect()
    total = 0
    for place, r in enumerate(sorted(got, key=lambda r: r["k"])):
        assert (r["before"], r["n"]) == (total, place)
        total += r["v"]
    plan = with_running_totals(spark.createDataFrame(rows, "k int, v int, one int"), ["k"], {"v": "b"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1  # the sums of the ranges only
    assert with_running_totals(spark.createDataFrame([], "k int, v int"), ["k"], {"v": "b"}).count() == 0


@pytest.fixture
def numbers(spark):
    """Numbers 0 .. 4999 in order over part files."""
    return spark.range(0, 5000, 1, 6).select(F.concat(F.lit("value "), F.col("id").cast("string")).alias("v"))


@pytest.mark.parametrize("fmt", ["parquet", "json", "text", "csv"])
@pytest.mark.parametrize("split", ["4k", "128m"])
def test_numbers_follow_the_files(spark, numbers, fmt, split):
    path = stage_folder(spark)
    numbers.write.format(fmt).save(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        frame = spark.read.parquet(path) if fmt == "parquet" else spark.read.format(fmt).schema("v string").load(path)
        got = positions.numbered_rows(frame).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["row_number"], r["v"]) for r in got) == [(i, f"value {i}") for i in range(5000)]


def test_numbers_without_a_broadcast(spark, numbers, monkeypatch):
    monkeypatch.setattr(positions, "BROADCAST_SPLITS", 0)
    path = stage_folder(spark)
    numbers.write.parquet(path)
    assert sorted((r["row_number"], r["v"]) for r in positions.numbered_rows(spark.read.parquet(path)).collect()) == [(i, f"value {i}") for i in range(5000)]


def test_numbering_shuffles_no_row(spark, numbers):
    path = stage_folder(spark)
    numbers.write.parquet(path)
    plan = positions.numbered_rows(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "") and "BroadcastHashJoin" in plan


def test_pairs_by_position(spark, numbers):
    first, second = stage_folder(spark), stage_folder(spark)
    numbers.withColumnRenamed("v", "prediction").write.parquet(first)
    numbers.limit(3000).coalesce(1).select(F.upper("v").alias("reference")).write.json(second)
    tables = spark.read.parquet(first), spark.read.schema("reference string").json(second)
    pairs = metrics.paired_by_position(*tables)
    assert pairs.filter(F.upper("prediction") == F.col("reference")).count() == pairs.count() == 3000
    left = metrics.paired_by_position(*tables, how="left")
    summary = metrics.exact_match_summary(metrics.with_exact_match(left)).first()
    assert (summary["exact_match"], summary["exact_match_count"]) == (0.6, 3000)


def pages(spark, sizes):
    rows = [(number, [f"{number}.{i}" for i in range(n)] if n is not None else None) for number, n in sizes]
    return spark.createDataFrame(rows, "page long, results array<string>").repartition(3)


def loop(sizes, limit):
    """The page loop."""
    out = []
    for number, n in sorted(sizes):
        if not n or (limit is not None and len(out) >= limit):
            break
        out += [f"{number}.{i}" for i in range(n)]
    return out if limit is None else out[:limit]


@pytest.mark.parametrize("limit", [None, 0, 1, 5, 6, 11, 13, 500])
def test_pages_as_a_loop_reads_them(spark, limit):
    for sizes in ([(i, 3) for i in range(9)], [(0, 3), (1, 3), (4, 5), (5, 0), (6, 9)], [(0, 2), (1, None), (2, 2)], [(0, 0), (1, 4)], []):
        got = registry.bounded_pages(pages(spark, sizes), "page", limit=limit).select(F.explode("results")).collect()
        assert sorted(r[0] for r in got) == sorted(loop(sizes, limit))


def test_the_end_of_the_pages_is_a_pushed_filter(spark):
    path = stage_folder(spark)
    pages(spark, [(i, 3) for i in range(50)]).write.parquet(path)
    bounded = registry.bounded_pages(spark.read.parquet(path), "page", limit=40)
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(page), LessThanOrEqual(page,13)]" in plan and "Exchange" not in plan


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_sorted_output_with_a_hot_key(spark, fmt):
    path = stage_folder(spark)
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "m").otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("key"), F.col("id").alias("tie"))
    sinks.write_sorted(rows.repartition(5), path, ["key"], ["tie"], files=8, fmt=fmt)
    frame = spark.read.schema("key string, tie long").format(fmt).load(path)
    got = [(r["key"], r["tie"]) for r in sorted(positions.numbered_rows(frame).collect(), key=lambda r: r["row_number"])]
    assert got == sorted((r["key"], r["tie"]) for r in rows.collect())
    files = frame.filter("key = 'm'").select("_metadata.file_name").distinct().count()
    assert files >= 2, json.dumps(files)
