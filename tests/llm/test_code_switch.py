"""Language labels: probabilities against all label sequences, features against plain
definitions, and held-out accuracy on whole and on spliced texts."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from regforge.llm import code_switch as C
from regforge.llm.common import table
from regforge.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_probabilities_equal_all_label_sequences():
    rng = np.random.default_rng(1)
    counts, size = np.array([4, 0, 1, 5, 3]), 3
    evidence, initial, moves = rng.normal(size=(13, size)), rng.normal(size=size), rng.normal(size=(size, size))
    start, length = C.chains_of(counts, 3)
    assert sorted(zip(start.tolist(), length.tolist(), strict=True)) == [(0, 3), (3, 1), (4, 1), (5, 3), (8, 2), (10, 3)]
    got, firsts, moved = C.forward_backward(evidence, start, length, initial, moves)
    want, want_firsts, want_moved = np.zeros_like(evidence), np.zeros(size), np.zeros((size, size))
    for s, n in zip(start, length, strict=True):
        paths = list(itertools.product(range(size), repeat=n))
        scores = np.array([np.exp(initial[p[0]] + sum(evidence[s + i, k] for i, k in enumerate(p)) + sum(moves[a, b] for a, b in itertools.pairwise(p))) for p in paths])
        for p, chance in zip(paths, scores / scores.sum(), strict=True):
            want_firsts[p[0]] += chance
            for i, k in enumerate(p):
                want[s + i, k] += chance
            for a, b in itertools.pairwise(p):
                want_moved[a, b] += chance
    assert np.allclose(got, want) and np.allclose(firsts, want_firsts) and np.allclose(moved, want_moved)


def test_ngrams_belong_to_their_word():
    """Two words share an n-gram with the same edges if and only if they share its bucket."""
    data = b" ab abc  zabc, x "
    words = C.Words.of(data)
    assert [data[a:b] for a, b in zip(words.starts, words.ends, strict=True)] == [b"ab", b"abc", b"zabc", b"x"]
    buckets = 1 << 20
    named = {}
    for grams, n in zip(words.ngrams(buckets), C.ORDERS, strict=True):
        for i, bucket in enumerate(grams.tolist()):
            text = "".join(chr(c) if C._LETTER[c] else "_" for c in data[i : i + n])
            whole = len(text) == n and "_" not in text[1:-1] and text.strip("_") != ""
            assert (bucket < buckets) == whole
            if whole:
                assert named.setdefault(text, bucket) == bucket
    assert len(set(named.values())) == len(named)
    rows = np.ones((len(data), 1))
    assert words.sums(rows).ravel().tolist() == [3, 4, 5, 2]
    assert len(set(words.hashes().tolist())) == 4 and C.Words.of(b" abc ").hashes()[0] == words.hashes()[1]


@pytest.fixture(scope="module")
def model(spark):
    return C.fit(table(spark, FOLDER, "documents"))


def test_held_out_accuracy(spark):
    docs = table(spark, FOLDER, "documents")
    got = QUERIES["op11_code_switch_language"](spark, FOLDER)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and got.count() == docs.count()
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_switches_inside_a_text(spark, model):
    """Held-out texts of two languages joined: nearly every word gets its own language."""
    held = [r for r in table(spark, FOLDER, "documents").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 and 500 < r["n_chars"] < 4000]
    rng = random.Random(0)
    right = total = 0
    for _ in range(30):
        a, b = rng.sample(held, 2)
        parts = [(r["lang"], len(C.Words.of(t).starts), t) for r in (a, b) for t in [b" " + r["text"].lower()[:400].encode() + b" "]]
        spans = C.text_spans(model, [b"".join(t for _, _, t in parts)])[0]
        found = [s["language"] for s in spans for _ in range(s["words"])]
        want = [lang for lang, n, _ in parts for _ in range(n)]
        assert len(found) == len(want)
        right, total = right + sum(map(str.__eq__, found, want)), total + len(want)
    assert right / total > 0.93


def test_pieces_and_batches_change_nothing(model, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "ering", "der", "und", "la", "que"]) for _ in range(n)).encode() for n in (1, 0, 5, 300, 40, 7)]
    names, scores = C.text_languages(model, texts)
    for text, name, score in zip(texts, names, scores, strict=True):
        alone, one = C.text_languages(model, [text])
        assert alone == [name] and np.allclose(one, [score])
    monkeypatch.setattr(C, "CELLS", 1 << 14)
    long = b" ".join(texts * 60)
    name, score = C.text_languages(model, [b"x", long, b""])
    assert name[2] == C.UNDETERMINED and score[2] == 0 and sum(s["words"] for s in C.text_spans(model, [long])[0]) == len(C.Words.of(b" " + long + b" ").starts)


def test_edges(spark, docs, empty):
    got = C.languages(docs).collect()
    assert len(got) == docs.count()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        if not any(c.isalpha() for c in texts[r["doc_id"]] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "de")
    assert C.languages(empty).count() == 0
    unknown = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in C.languages(unknown).collect()} == {("und", 0.0)}
    odd = spark.createDataFrame([(1, "xx yy", "a", 5, "k"), (2, "É", "b", 5, "k"), (3, "12 !", "a", 5, "k"), (None, "xx", None, 5, "k")], "doc_id long, text string, lang string, h int, score string")
    odd = odd.union(odd)  # repeated rows, clashing names, one or two languages
    assert C.languages(odd).count() == 8
    model = C.fit(odd)
    spans = odd.select("doc_id", C.spans_of(model, F.col("text")).alias("runs")).filter("doc_id = 1").first()["runs"]
    assert sum(r["words"] for r in spans) == 2
