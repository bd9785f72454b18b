import math
import random
import re
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from regforge import constants as C
from regforge.operators import metrics, scoring
from regforge.plans.evaluation import all_metrics, evaluation_by_task, metric_report

PAIRS = [
    ("The drug lowers sugar made by the liver.", "It lowers liver sugar production!", "a"),
    ("Side effects: nausea, pain\nand a rash.", "Side effects may include rash\nand nausea.", "b"),
    ("", "nothing was said", "a"),
    ("something was said", "", None),
    ("Same Words", "same, words", "b"),
    ("naïve Café 薬 ½", "NAÏVE café 薬 ½", "c"),
    ("the the the cat sat on the mat", "the cat sat the the", "c"),
]


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame(PAIRS, "prediction string, reference string, task string").repartition(3)


def norm(text):
    return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", text.lower())).strip()


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def word_f1(p, r):
    p, r = set(norm(p).split()), set(norm(r).split())
    if not p or not r:
        return 0.0, 0.0, 0.0
    precision, recall = len(p & r) / len(p), len(p & r) / len(r)
    return precision, recall, 2 * precision * recall / (precision + recall) if p & r else 0.0


def test_exact_match(pairs):
    got = only(metrics.exact_match_summary(metrics.with_exact_match(pairs)))
    count = sum(norm(p) == norm(r) for p, r, _ in PAIRS)
    assert got == {"exact_match": count / len(PAIRS), "exact_match_count": count} and count == 2


def test_exact_match_of_nothing(pairs):
    got = only(metrics.exact_match_summary(metrics.with_exact_match(pairs.limit(0))))
    assert got == {"exact_match": 0.0, "exact_match_count": 0}


def test_word_f1(pairs):
    got = only(metrics.word_f1_summary(metrics.with_word_f1(pairs)))
    scores = [word_f1(p, r) for p, r, _ in PAIRS]
    for i, name in enumerate(("word_precision", "word_recall", "word_f1")):
        assert got[name] == pytest.approx(statistics.fmean(s[i] for s in scores))


def test_word_f1_by_task(pairs):
    got = {r["task"]: (r["f1"], r["count"]) for r in metrics.word_f1_by_task(metrics.with_word_f1(pairs)).collect()}
    assert set(got) == {"a", "b", "c", "unknown"}
    want = [word_f1(p, r)[2] for p, r, t in PAIRS if t == "c"]
    assert got["c"] == (pytest.approx(statistics.fmean(want)), 2)


def test_lengths(pairs):
    got = only(metrics.length_summary(metrics.with_lengths(pairs)))
    p, r = ([len(x[i].split()) for x in PAIRS] for i in (0, 1))
    assert got["avg_pred_length"] == pytest.approx(statistics.fmean(p))
    assert got["avg_ref_length"] == pytest.approx(statistics.fmean(r))
    assert got["length_ratio"] == pytest.approx(statistics.fmean(a / b if b else 0 for a, b in zip(p, r)))
    assert got["length_std"] == pytest.approx(statistics.pstdev(p))


def grams(words, n):
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def bleu(pairs):
    match, possible, c, r = [0] * 4, [0] * 4, 0, 0
    for p_text, r_text in pairs:
        p, ref = p_text.split(), r_text.split()
        c, r = c + len(p), r + len(ref)
        for n in range(1, 5):
            match[n - 1] += sum((grams(p, n) & grams(ref, n)).values())
            possible[n - 1] += max(len(p) - n + 1, 0)
    precisions = [m / q if q else 0.0 for m, q in zip(match, possible)]
    score = 0.0
    if min(precisions) > 0:
        score = math.exp(sum(map(math.log, precisions)) / 4) * (1.0 if c > r else math.exp(1 - r / c))
    return score, precisions


@pytest.mark.parametrize("longer", ["prediction", "reference"])
def test_bleu(spark, longer):
    rng = random.Random(5)
    words = "a b c d e".split()
    data = [(" ".join(rng.choices(words, k=rng.randrange(0, 30))), " ".join(rng.choices(words, k=rng.randrange(0, 22)))) for _ in range(40)]
    if longer == "reference":
        data = [(r, p) for p, r in data]
    df = spark.createDataFrame(data, "prediction string, reference string").repartition(4)
    got = only(metrics.bleu_summary(metrics.with_bleu_counts(df)))
    score, precisions = bleu(data)
    assert score > 0 and got["bleu"] == pytest.approx(score)
    assert [got[f"bleu_{n}"] for n in range(1, 5)] == pytest.approx(precisions)


def test_bleu_is_zero_without_long_matches(spark):
    for data in ([("a b", "a b")], [("", "")], [("", "x")]):
        df = spark.createDataFrame(data, "prediction string, reference string")
        assert only(metrics.bleu_summary(metrics.with_bleu_counts(df)))["bleu"] == 0.0


def rouge_words(text):
    return re.findall("[a-z0-9]+", text.lower())


def f_of(overlap, p, r):
    return 2 * overlap / (p + r) if overlap else 0.0


def test_rouge_n(pairs):
    got = only(metrics.mean_summary(metrics.with_rouge_n(pairs), ["rouge1", "rouge2"]))
    for n in (1, 2):
        scores = []
        for p, r, _ in PAIRS:
            gp, gr = grams(rouge_words(p), n), grams(rouge_words(r), n)
            scores.append(f_of(sum((gp & gr).values()), sum(gp.values()), sum(gr.values())))
        assert got[f"rouge{n}"] == pytest.approx(statistics.fmean(scores))


def test_rouge_l(pairs):
    from test_functions import brute_line_hits, table_of

    rows = metrics.with_rouge_l(pairs).collect()
    for row in rows:
        p, r = rouge_words(row["prediction"]), rouge_words(row["reference"])
        lines = [[rouge_words(x) for x in t.split("\n")] for t in (row["prediction"], row["reference"])]
        assert row["rougeL"] == pytest.approx(f_of(table_of(r, p)[-1][-1], len(p), len(r)))
        assert row["rougeLsum"] == pytest.approx(f_of(brute_line_hits(lines[1], lines[0]), len(p), len(r)))


def test_cosine(spark):
    df = spark.createDataFrame(
        [([1.0, 0.0], [1.0, 1.0]), ([1.0, 2.0], [2.0, 4.0]), ([0.0, 0.0], [1.0, 1.0])],
        "prediction_vector array<float>, reference_vector array<float>",
    )
    got = only(metrics.cosine_summary(metrics.with_cosine(df)))
    values = [1 / math.sqrt(2), 1.0, 0.0]
    assert got["semantic_similarity"] == pytest.approx(statistics.fmean(values))
    assert got["semantic_similarity_std"] == pytest.approx(statistics.pstdev(values))
    assert (got["semantic_similarity_min"], got["semantic_similarity_max"]) == (0.0, pytest.approx(1.0))


def test_known_structure_rate(spark):
    df = spark.createDataFrame(
        [("CC(=O)OC1 is CC(=O)OC1", "CCCCCCO"), ("NNNNNN=O? short CCO", "none")], "prediction string, reference string"
    )
    known = spark.createDataFrame([("CC(=O)OC1",), ("CC(=O)OC1",), ("CCCCCCO",), (None,)], "canonical_smiles string")
    got = only(metrics.known_structure_rate(df, known))
    assert got == {"candidates": 3, "valid_smiles_count": 2, "reference_smiles_count": 1, "smiles_validity_rate": pytest.approx(2 / 3)}
    none = only(metrics.known_structure_rate(df.limit(0), known))
    assert none["smiles_validity_rate"] is None and none["candidates"] == 0


def test_all_metrics_equal_the_single_ones(pairs):
    wide = only(all_metrics(pairs))
    parts = {}
    parts |= only(metrics.exact_match_summary(metrics.with_exact_match(pairs)))
    parts |= only(metrics.word_f1_summary(metrics.with_word_f1(pairs)))
    parts |= only(metrics.length_summary(metrics.with_lengths(pairs)))
    parts |= only(metrics.mean_summary(metrics.with_rouge_n(pairs), ["rouge1", "rouge2"]))
    parts |= only(metrics.mean_summary(metrics.with_rouge_l(pairs), ["rougeL", "rougeLsum"]))
    score = only(metrics.bleu_summary(metrics.with_bleu_counts(pairs)))
    parts |= {k: score[k] for k in ("bleu", "bleu_1", "bleu_2")}
    assert wide == {k: pytest.approx(v) for k, v in parts.items()}


def test_all_metrics_need_no_shuffle_but_the_last(pairs):
    plan = all_metrics(pairs)._jdf.queryExecution().executedPlan().toString()
    # One exchange is the repartition of the fixture, one the final single row.
    assert plan.count("Exchange") == 2


def test_long_form_puts_priority_first(spark):
    wide = spark.createDataFrame([(1.0, 2.0, 3, None)], "length_std double, word_f1 double, exact_match int, bleu double")
    got = [(r["rank"], r["metric"], r["value"]) for r in metrics.to_long(wide).orderBy("rank").collect()]
    assert got == [(1, "exact_match", 3.0), (2, "word_f1", 2.0), (8, "length_std", 1.0)]


def test_report_holds_what_can_be_computed(spark, pairs):
    vectors = pairs.withColumn("v", F.array(F.lit(1.0), F.lit(2.0)))
    known = spark.createDataFrame([("production",)], "canonical_smiles string")
    full = metric_report(vectors, task="task", structures=known, vectors=("v", "v"))
    got = {r["metric"]: (r["rank"], r["value"]) for r in full.collect()}
    assert got["semantic_similarity"] == (6, pytest.approx(1.0))
    assert got["c_count"] == (8, 2.0) and got["unknown_f1"] == (8, 0.0)
    assert "smiles_validity_rate" not in got  # no known candidate in a prediction
    assert {r["metric"] for r in metric_report(pairs).collect()} < set(got)
    shown = metric_report(pairs, prediction="reference", reference="prediction", structures=known)
    assert {r["metric"]: r["value"] for r in shown.collect()}["valid_smiles_count"] == 1.0


def test_evaluation_by_task_equals_single_metrics(pairs):
    got = {(r["task"], r["is_total"]): r for r in evaluation_by_task(pairs).collect()}
    assert set(got) == {("a", 0), ("b", 0), ("c", 0), ("unknown", 0), (None, 1)}
    for task, total in got:
        part = pairs if total else pairs.filter(F.coalesce("task", F.lit("unknown")) == task)
        row = got[(task, total)]
        assert row["bleu"] == pytest.approx(only(metrics.bleu_summary(metrics.with_bleu_counts(part)))["bleu"])
        rouge = only(metrics.mean_summary(metrics.with_rouge_n(part), ["rouge1", "rouge2"]))
        assert (row["rouge1"], row["rouge2"]) == (pytest.approx(rouge["rouge1"]), pytest.approx(rouge["rouge2"]))
        assert row["task_specific_accuracy"] == pytest.approx(
            scoring.with_task_score(part).agg(F.avg("score")).first()[0]
        )
    assert got[(None, 1)]["samples"] == len(PAIRS)


# --- scores per row --------------------------------------------------------------
def score(spark, task, prediction, reference, **options):
    df = spark.createDataFrame([(prediction, reference, task)], "prediction string, reference string, task string")
    return scoring.with_task_score(df, **options).first()["score"]


def test_status_rule(spark):
    assert score(spark, C.TASK_STATUS, "It was APPROVED.", "unapproved?") == 1.0  # substring
    assert score(spark, C.TASK_STATUS, "terminated", "withdrawn") == 0.0
    assert score(spark, C.TASK_STATUS, "none", "none") == 0.0


def test_word_share_rule(spark):
    assert score(spark, C.TASK_REACTIONS, "rash and Pain", "pain, rash and") == pytest.approx(2 / 3)
    assert score(spark, "other", "a b", "A a b c") == pytest.approx(2 / 3)
    assert score(spark, None, "", "") == 0.0
    assert score(spark, None, None, "a") == 0.0


def test_any_word_rule_is_an_option(spark):
    pair = (C.TASK_IDENTIFY, "aspirinate", "is aspirin here")
    assert score(spark, *pair) == 0.0
    assert score(spark, *pair, rules={C.TASK_IDENTIFY: scoring.ANY_WORD_RULE}) == 1.0


def test_accuracy_rollup(spark):
    df = spark.createDataFrame([("a", True), ("a", False), (None, True)], "task string, correct boolean")
    got = {(r["task"], r["is_total"]): (r["correct"], r["total"], r["accuracy"]) for r in scoring.accuracy_rollup(df).collect()}
    assert got == {("a", 0): (1, 2, 0.5), ("unknown", 0): (1, 1, 1.0), (None, 1): (2, 3, pytest.approx(2 / 3))}


def test_strict_match_keeps_punctuation(spark):
    df = spark.createDataFrame([(" A b\n", "a B"), ("a.", "a"), (None, "a")], "p string, r string")
    assert [r[0] for r in df.select(scoring.strict_match("p", "r")).collect()] == [True, False, False]


def test_score_by_task(pairs):
    got = {r["task"]: r for r in scoring.score_by_task(scoring.with_task_score(pairs)).collect()}
    assert got["a"]["samples"] == 2 and got["unknown"]["task_specific_accuracy"] == 0.0
    assert got["a"]["avg_ref_length"] == pytest.approx((5 + 3) / 2)


def test_cosine_of_texts(spark):
    """Against the formula; a text without words, an equal pair, and a word that all texts have."""
    rows = [(1, "the cat", "the cat"), (2, "the dog the", "the bird"), (3, "", "the"), (4, None, None), (5, "sun", "moon the")]
    texts = [t.split() if t else [] for _, p, r in rows for t in (p, r)]
    held = Counter(w for t in texts for w in set(t))

    def vector(text):
        return {w: n * (math.log((1 + len(texts)) / (1 + held[w])) + 1) for w, n in Counter((text or "").split()).items()}

    def cosine(a, b):
        size = math.sqrt(sum(x * x for x in a.values())) * math.sqrt(sum(x * x for x in b.values()))
        return sum(a[w] * b.get(w, 0) for w in a) / size if size else 0.0

    got = {r["id"]: r["similarity"] for r in metrics.text_cosine(spark.createDataFrame(rows, "id int, prediction string, reference string").repartition(3), "id").collect()}
    assert got == {i: pytest.approx(cosine(vector(p), vector(r))) for i, p, r in rows} and got[1] == pytest.approx(1) and got[4] == 0
