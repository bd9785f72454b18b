import pytest

from regforge.operators import compare

SUITE = [(1, "info", ["Liver", "glucose"]), (2, "dose", ["mg"]), (3, "none", []), (4, "late", ["x"])]
ANSWERS = [
    (1, "base", "the liver", 2.0), (1, "finetuned", "GLUCOSE in the liver", 1.0),
    (2, "base", "5 mg", 4.0), (2, "finetuned", "five", 1.0),
    (3, "base", "a" * 301, 3.0), (3, "finetuned", "b", 1.0),
    (4, "base", "x", 3.0), (4, "finetuned", "x", 1.0),
]


@pytest.fixture
def scored(spark):
    suite = spark.createDataFrame(SUITE, "prompt_id int, task string, expected_keywords array<string>")
    answers = spark.createDataFrame(ANSWERS, "prompt_id int, model string, response string, latency double")
    return compare.scored_responses(answers, suite)


def test_winners(scored):
    got = {r["prompt_id"]: (r["base_score"], r["tuned_score"], r["winner"]) for r in compare.winners(scored).collect()}
    assert got == {1: (0.5, 1.0, "finetuned"), 2: (1.0, 0.0, "base"), 3: (0.0, 0.0, "Tie"), 4: (1.0, 1.0, "Tie")}


def test_summary(scored):
    got = compare.comparison_summary(scored).first().asDict()
    base, tuned = (0.5 + 1 + 0 + 1) / 4, (1 + 0 + 0 + 1) / 4
    assert got["base_relevance"] == pytest.approx(base) and got["finetuned_relevance"] == pytest.approx(tuned)
    assert got["improvement_percent"] == pytest.approx((tuned - base) / base * 100)
    assert (got["base_matches"], got["finetuned_matches"], got["total_keywords"]) == (3, 3, 4)
    assert got["matches_percent"] == 0.0 and got["latency_percent"] == pytest.approx((1 - 3) / 3 * 100)
    assert got["base_keyword_accuracy"] == pytest.approx(0.75) and got["verdict"] == "worse"


def test_summary_guards(spark, scored):
    zero = scored.selectExpr("prompt_id", "model", "0.0D relevance_score", "0.0D latency", "0L keyword_matches", "0L total_keywords")
    got = compare.comparison_summary(zero).first().asDict()
    assert got["improvement_percent"] == 0.0 and got["latency_percent"] is None
    assert got["verdict"] == "similar" and got["base_keyword_accuracy"] == 0.0


def test_samples(scored):
    rows = compare.sample_responses(scored).orderBy("prompt_id").collect()
    assert [r["prompt_id"] for r in rows] == [1, 2, 3]
    assert rows[2]["base_response"] == "a" * 300 + "..." and rows[2]["tuned_response"] == "b"
    assert (rows[0]["tuned_score"], rows[1]["base_latency"]) == (1.0, 4.0)
