import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from regforge.functions import text as X
from regforge.functions.columns import blank_to_null, fill, packed_position
from regforge.functions.multiset import multiset_overlap, ngrams
from regforge.functions.subsequence import subsequence_counts

SAMPLES = [
    "", " ", "Plain words here", "Ünïcode — naïve café, ½ Ⅳ", "一つ の 薬、二つ", "tab\tnew\nline\x0bfeed",
    "nbsp thin ideographic　end", "under_score and-hyphen", "!!!", "  Lead and trail  ",
    "ΑΒΓ ДЕЖ ß", "a\x1cb", "100% of 3.5mg; (twice)",
]


def one_column(spark, values, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(column).collect()]


def test_normalized_equals_the_definition(spark):
    def definition(text):
        text = re.sub(r"[^\w\s]", " ", text.lower())
        return re.sub(r"\s+", " ", text).strip()

    assert one_column(spark, SAMPLES, X.normalized("t")) == [definition(s) for s in SAMPLES]
    assert one_column(spark, SAMPLES, X.word_tokens("t")) == [definition(s).split() for s in SAMPLES]


def test_tokens_split_on_unicode_whitespace(spark):
    assert one_column(spark, SAMPLES, X.tokens("t")) == [s.split() for s in SAMPLES]
    assert one_column(spark, [None], X.tokens("t")) == [[]]


def test_folded_trims_all_whitespace(spark):
    values = ["  A b\n", "x", "　"]
    assert one_column(spark, values, X.folded("t")) == ["a b", "x", ""]


def test_structure_candidates(spark):
    found = one_column(spark, ["see CC(=O)OC1=CC=CC=C1 or CCO, again"], X.structure_candidates("t"))
    assert found == [["CC(=O)OC1=CC=CC=C1"]]


def test_keyword_hits_ignore_case_and_null(spark):
    keywords = F.array(F.lit("Liver"), F.lit("GLUC"), F.lit("none"))
    assert one_column(spark, ["the LIVER and glucose", None], X.keyword_hits("t", keywords)) == [2, 0]
    empty = F.lit(None).cast("array<string>")
    assert one_column(spark, ["x"], X.keyword_hits("t", empty)) == [0]


def test_prompt_and_response_part(spark):
    with_input = X.prompt("t", F.lit("ctx"), F.lit(" yes \n"))
    rendered = one_column(spark, ["Q?"], with_input)[0]
    assert rendered == "### Instruction:\nQ?\n\n### Input:\nctx\n\n### Response:\n yes \n"
    assert one_column(spark, ["Q?"], X.prompt("t", F.lit(None).cast("string")))[0] == (
        "### Instruction:\nQ?\n\n### Response:\n"
    )
    assert one_column(spark, [rendered, "no marker "], X.response_part("t")) == ["yes", "no marker "]


def test_excerpt(spark):
    assert one_column(spark, ["abcd", "abc"], X.excerpt("t", 3)) == ["abc...", "abc"]


def test_fill_and_blank(spark):
    assert one_column(spark, ["x", None], fill("<{a}|{a}>", a="t")) == ["<x|x>", None]
    assert one_column(spark, ["", " ", "a "], blank_to_null("t")) == [None, " ", "a "]
    assert one_column(spark, ["", " ", "a "], blank_to_null("t", trim=True)) == [None, None, "a"]


def test_packed_position_orders_and_refuses_overflow(spark):
    rows = spark.createDataFrame([(0, 5), (1, 0), (1, 3)], "a long, b int")
    values = [r[0] for r in rows.orderBy("a", "b").select(packed_position("a", "b", 4)).collect()]
    assert values == sorted(values) and len(set(values)) == 3
    with pytest.raises(Exception, match="position out of range"):
        spark.createDataFrame([(0, 16)], "a long, b int").select(packed_position("a", "b", 4)).collect()


def random_texts(count, vocabulary, longest, seed):
    rng = random.Random(seed)
    return [" ".join(rng.choices(vocabulary, k=rng.randrange(longest + 1))) for _ in range(count)]


def test_ngrams_and_multiset_overlap_equal_counters(spark):
    left, right = (random_texts(120, list("abcd"), 25, seed) for seed in (1, 2))
    rows = spark.createDataFrame(list(zip(range(120), left, right)), "i int, l string, r string")
    for n in (1, 2, 3, 4):
        overlap = multiset_overlap(ngrams(X.tokens("l"), n), ngrams(X.tokens("r"), n))
        got = [r[0] for r in rows.orderBy("i").select(overlap).collect()]

        def grams(text):
            words = text.split()
            return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))

        assert got == [sum((grams(a) & grams(b)).values()) for a, b in zip(left, right)]


def table_of(ref, pred):
    table = [[0] * (len(pred) + 1) for _ in range(len(ref) + 1)]
    for i, a in enumerate(ref, 1):
        for j, b in enumerate(pred, 1):
            table[i][j] = table[i - 1][j - 1] + 1 if a == b else max(table[i - 1][j], table[i][j - 1])
    return table


def brute_line_hits(ref_lines, pred_lines):
    """Union of the reference positions hit per line, counts clipped."""
    left = Counter(t for line in ref_lines for t in line), Counter(t for line in pred_lines for t in line)
    hits = 0
    for ref in ref_lines:
        union = set()
        for pred in pred_lines:
            table, i, j = table_of(ref, pred), len(ref), len(pred)
            while i and j:
                if ref[i - 1] == pred[j - 1]:
                    union.add(i - 1)
                    i, j = i - 1, j - 1
                elif table[i][j - 1] > table[i - 1][j]:
                    j -= 1
                else:
                    i -= 1
        for i in sorted(union):
            if all(counts[ref[i]] > 0 for counts in left):
                hits += 1
                for counts in left:
                    counts[ref[i]] -= 1
    return hits


def test_subsequence_counts_equal_the_full_table(spark):
    rng = random.Random(7)

    def text():
        lines = random_texts(rng.randrange(1, 5), list("abcde"), 14, rng.random())
        return "\n".join(lines)

    pairs = [(i, text(), text()) for i in range(80)] + [(80, "", "a b"), (81, "a b", ""), (82, None, "a"), (83, "É.a", "a é")]
    rows = spark.createDataFrame(pairs, "i int, p string, r string").repartition(4)
    got = {r["i"]: r["s"] for r in rows.select("i", subsequence_counts("p", "r").alias("s")).collect()}
    for i, prediction, reference in pairs:
        lines = [
            [re.findall("[a-z0-9]+", line) for line in (t or "").lower().split("\n")]
            for t in (prediction, reference)
        ]
        pred, ref = ([t for line in side for t in line] for side in lines)
        assert got[i]["lcs"] == table_of(ref, pred)[-1][-1]
        assert got[i]["line_hits"] == brute_line_hits(lines[1], lines[0])
        assert (got[i]["prediction_tokens"], got[i]["reference_tokens"]) == (len(pred), len(ref))


def test_subsequence_has_no_token_cap(spark):
    long = " ".join(f"w{i}" for i in range(6000))
    rows = spark.createDataFrame([(long, "x " + long)], "p string, r string")
    assert rows.select(subsequence_counts("p", "r").alias("s")).first()["s"]["lcs"] == 6000
