"""Broken batch runs go on where they stopped; bootstrap intervals against plain Python."""

import hashlib
import math
import os
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from regforge.operators import bootstrap
from regforge.operators.generate import ATTEMPT, REQUEST, generate_rest, stored_responses
from regforge.plans.stages import stage_folder


def maker(log, fail_on=None):
    def make_generator():
        def generate(batch):
            with open(os.path.join(log, f"{os.getpid()}-{os.urandom(4).hex()}"), "w") as out:
                out.write("\n".join(batch["q"]) + "\n")
            if fail_on is not None and (batch["q"] == fail_on).any():
                raise RuntimeError("broken off")
            return [f"answer to {q}" for q in batch["q"]]

        return generate

    return make_generator


def asked(log):
    lines = []
    for name in os.listdir(log):
        with open(os.path.join(log, name)) as held:
            lines += held.read().split()
    return lines


def test_a_broken_run_goes_on(spark, tmp_path):
    first, second = tmp_path / "first", tmp_path / "second"
    first.mkdir(), second.mkdir()
    path = stage_folder(spark)
    rows = spark.range(400).select(F.concat(F.lit("q"), F.col("id") % 300).alias("q"), "id")
    with pytest.raises(Exception, match="broken off"):
        generate_rest(rows.coalesce(1).union(rows.limit(0)), ["q"], maker(str(first), fail_on="q7"), path, attempt=1)
    schema = spark.createDataFrame([], f"{REQUEST} string, q string, response string").schema
    kept = {r["q"] for r in stored_responses(spark, path, schema).collect()}
    got = generate_rest(rows, ["q"], maker(str(second)), path, attempt=2).collect()
    again = asked(str(second))
    assert sorted(again) == sorted({f"q{i}" for i in range(300)} - kept)  # the rest only, once each
    assert sorted((r["q"], r["response"]) for r in got) == sorted((f"q{i}", f"answer to q{i}") for i in range(300))
    assert {r["q"] for r in got if r[ATTEMPT] == 1} == kept and "q7" not in kept
    third = tmp_path / "third"
    third.mkdir()
    assert generate_rest(rows, ["q"], maker(str(third)), path, attempt=3).count() == 300 and asked(str(third)) == []


def test_finished_tasks_publish_their_answers(spark, tmp_path):
    """Of four tasks one fails; what the others answered is there afterwards."""
    path = stage_folder(spark)
    rows = spark.range(0, 400, 1, 4).select(F.concat(F.lit("q"), "id").alias("q"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(Exception, match="broken off"):
            generate_rest(rows, ["q"], maker(str(tmp_path), fail_on="q0"), path, attempt=1)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    schema = spark.createDataFrame([], f"{REQUEST} string, q string, response string").schema
    kept = stored_responses(spark, path, schema)
    assert kept.filter("q = 'q0'").count() == 0


def test_repeated_answers_count_once(spark):
    path = stage_folder(spark)
    rows = spark.createDataFrame([("k", "q", "early"), ("k", "q", "early")], f"{REQUEST} string, q string, response string")
    rows.write.parquet(f"{path}/{ATTEMPT}=1")
    rows.withColumn("response", F.lit("late")).write.parquet(f"{path}/{ATTEMPT}=2")
    got = stored_responses(spark, path, rows.schema).collect()
    assert [(r["response"], r[ATTEMPT]) for r in got] == [("early", 1)]


def weight(sample, replicate, seed=42):
    """Poisson(1) by inversion."""
    u = int(hashlib.md5(f"{seed}:{replicate}:{sample}".encode()).hexdigest()[:8], 16)
    share, k = 0.0, 0
    while True:
        share += math.exp(-1) / math.factorial(k)
        if u < round(share * 2**32):
            return k
        k += 1


def test_intervals_against_plain_python(spark):
    rows = [(f"s{i}", f"t{i % 2}", (i * 37 % 101) / 100, float(i % 3 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, task string, x double, y double")
    want = {}
    for task in ("t0", "t1"):
        own = [r for r in rows if r[1] == task]
        for at, name in ((2, "x"), (3, "y")):
            means = []
            for replicate in range(1, 51):
                weights = [weight(r[0], replicate) for r in own]
                means.append(sum(w * r[at] for w, r in zip(weights, own, strict=True)) / sum(weights))
            cuts = statistics.quantiles(means, n=40, method="inclusive")
            want[task, name] = statistics.fmean(r[at] for r in own), cuts[0], cuts[-1]
    for frame in (df, df.repartition(7)):
        got = {(r["task"], r["metric"]): (r["value"], r["low"], r["high"]) for r in bootstrap.bootstrap_means(frame, "id", ["x", "y"], ["task"], replicates=50).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_weights_are_poisson(spark):
    sums = bootstrap.replicate_sums(spark.range(20000).selectExpr("id", "1.0 as one"), "id", ["one"], replicates=20).collect()
    drawn = [r["weight"] for r in sums if r["replicate"] > 0]
    assert len(drawn) == 20 and all(abs(w - 20000) < 5 * math.sqrt(20000) for w in drawn)
    groups = defaultdict(int)
    for i in range(20000):
        groups[weight(i, 1)] += 1
    assert abs(groups[0] / 20000 - math.exp(-1)) < 0.02 and next(r["weight"] for r in sums if r["replicate"] == 1) == sum(k * n for k, n in groups.items())


def test_no_rows(spark):
    assert bootstrap.bootstrap_means(spark.createDataFrame([], "id string, x double"), "id", ["x"], ["id"]).count() == 0


def test_replicates_combine_before_the_shuffle(spark):
    plan = bootstrap.replicate_sums(spark.range(10).selectExpr("id", "1.0 as x"), "id", ["x"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") >= 2 and plan.index("partial_sum") > plan.index("Exchange")
