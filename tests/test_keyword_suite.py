"""A table of keywords against every text equals one search per keyword."""

import random

import pytest
from pyspark.sql import functions as F

from regforge.operators import scoring


def plain(text, keywords):
    low = (text or "").lower()
    return sum(k.lower() in low for k in keywords if k is not None)


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_equals_one_search_per_keyword(spark, monkeypatch, bound):
    monkeypatch.setattr(scoring, "BROADCAST_KEYWORDS", bound)
    rng = random.Random(6)
    words = ["a", "É", "ab", "abc", "ABCD", "b c", "ca", "x\ny", "zzz", "zzzz", "\U0001d400", "aba" * 5, None, "abc"]
    texts = ["".join(rng.choice(["a", "b", "c", " ", "é", "z", "\n", "x", "y", "\U0001d400"]) for _ in range(rng.randrange(60))) for _ in range(60)] + [None, "", "abaabaabaabaaba"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for keywords in (words, [*words, ""], [""], ["zzz"], []):
        suite = spark.createDataFrame([(k,) for k in keywords], "keyword string")
        got = {r["id"]: (r["keyword_matches"], r["total_keywords"]) for r in scoring.suite_scores(df, "id", "text", suite).collect()}
        listed = [k for k in keywords if k is not None]
        assert got == {i: (plain(t, listed), len(listed)) for i, t in enumerate(texts)}


def test_agrees_with_the_row_operator(spark):
    df = spark.createDataFrame([(i, f"Value {i} of tion {i * 7}") for i in range(50)], "id int, text string")
    words = ["VALUE", "ion 4", "of", "missing"]
    suite = spark.createDataFrame([(w,) for w in words], "keyword string")
    want = scoring.with_keyword_score(df, "text", F.array(*map(F.lit, words))).select("id", "keyword_matches", "total_keywords", "relevance_score")
    got = scoring.suite_scores(df, "id", "text", suite)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_no_text_meets_every_keyword(spark):
    """Ten thousand keywords: the join goes by the first characters."""
    suite = spark.range(10_000).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("keyword"))
    df = spark.range(20).select("id", F.concat(F.lit("x k00017 y k0"), F.col("id")).alias("text"))
    scored = scoring.suite_scores(df, "id", "text", suite)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert {(r["keyword_matches"], r["total_keywords"]) for r in scored.collect()} == {(1, 10_000)}
