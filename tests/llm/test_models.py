import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from regforge.llm import quality as q
from regforge.llm import toxicity as tx
from regforge.llm.language_model import score_held_out
from regforge.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def discounts(counts):
    n = [sum(1 for c in counts if c == k) for k in (1, 2, 3, 4)]
    if not n[0] or not n[1]:
        return [0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    out = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * 0.5 for k in (1, 2, 3)]
    return [min(max(d, 0.05 * k), k * 0.98) for k, d in enumerate(out, 1)]


def test_kneser_ney_against_a_plain_model(docs, rows):
    held = lambda i: zlib.crc32(str(i if i is not None else "").encode()) % 10 == 0
    words, pairs = Counter(), Counter()
    for i, t, *_ in rows:
        if not held(i):
            w = tokens(t)
            words.update(w)
            pairs.update(zip(["<s>", *w], w))
    n, v, follows = sum(words.values()), len(words), Counter(w for _, w in pairs)
    upper, lower = discounts(pairs.values()), discounts(follows.values())
    cut = lambda c, d: c - d[min(c, 3) - 1] if c else 0.0
    given = defaultdict(lambda: [0, 0, 0, 0])
    for (a, _), c in pairs.items():
        given[a][0] += c
        given[a][min(c, 3)] += 1
    rest = sum(lower[min(c, 3) - 1] for c in follows.values()) / len(pairs)
    low = lambda w: cut(follows[w], lower) / len(pairs) + rest / (v + 1)

    def p(a, b):
        if a not in given:
            return low(b)
        total, *kinds = given[a]
        return cut(pairs[a, b], upper) / total + sum(d * k for d, k in zip(upper, kinds)) / total * low(b)

    assert math.isclose(sum(p("one", w) for w in words) + p("one", "never seen"), 1, rel_tol=1e-9)
    want = Counter()
    for i, t, *_ in rows:
        w = tokens(t)
        base = sum(math.log10((words[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        score = sum(math.log10(p(a, b)) for a, b in zip(["<s>", *w], w))
        want[i, held(i), len(w), sum(words[x] > 0 for x in w), n, f"{base:.6g}", f"{score:.6g}"] += 1
    have = Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], f"{r['base_score']:.6g}", f"{r['score']:.6g}") for r in score_held_out(docs).collect())
    assert have == want


def test_language_model_without_rows(empty, docs):
    assert score_held_out(empty).count() == 0
    from regforge.llm.language_model import score, train

    assert {r["score"] for r in score(docs.limit(3), train(empty)).collect()} == {0.0}


def test_additive_model_finds_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = q.fit_tables(x[:3000], y[:3000])
    assert (1, 0) in model.pairs and ((model.scores(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
    alone = model.base + sum(t[b] for t, b in zip(model.tables, model.bins(x[3000:]), strict=True))
    assert ((alone > 0) == y[3000:]).mean() < 0.7


def auc(good, bad):
    return (np.array(good)[:, None] > np.array(bad)[None]).mean()


def test_quality_of_held_out_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    out = [r for r in QUERIES["op2_additive_quality"](spark, SMALL).collect()]
    assert len(out) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in out)
    held = [(r["score"], labels[r["doc_id"]]) for r in out if r["held_out"] and r["doc_id"] in labels]
    assert auc([s for s, y in held if y], [s for s, y in held if not y]) > 0.95


def test_toxicity_of_held_out_documents(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    out = [r for r in QUERIES["op4_noisy_channel_toxicity"](spark, SMALL).collect()]
    assert len(out) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in out if r["held_out"] and r["doc_id"] in labels]
    assert not any(p and not y for p, y in held) and sum(p for p, y in held if y) >= 0.5 * sum(y for _, y in held)


def test_scores_of_edge_rows(spark, docs, empty):
    some = docs.withColumnRenamed("size", "quality")
    labels = spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(40)] + [(1, None, None), (1, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for found in (q.quality(some, labels).collect(), tx.toxicity(some, labels).collect()):
        assert len(found) == docs.count() and all(r["score"] is not None for r in found)
    none = labels.limit(0)
    assert {r["score"] for r in q.quality(some, none).collect()} == {0.5} and {r["score"] for r in tx.toxicity(some, none).collect()} == {0.0}
    assert q.quality(empty, labels).count() == 0 and tx.toxicity(empty, labels).count() == 0


def test_hidden_words_are_restored(spark):
    plain = spark.createDataFrame([(i, "that man is an idiot and a moron , the clown was pathetic stupid worthless") for i in range(30)], "doc_id long, text string")
    model = tx.character_model(plain)
    reader = tx.Reader(model)
    for hidden, word in {"1d10t": "idiot", "i d i o t": "idiot", "m0r000n": "moron", "p@thet1c!!": "pathetic", "$tup1d": "stupid", "w.o.r.t.h.l.e.s.s": "worthless"}.items():
        assert word in reader.words(f"what a {hidden} he is"), hidden
    assert tx.suspicious("a plain text, with words... and 2024 numbers") == set()


def test_long_runs_are_read_in_pieces(spark):
    reader = tx.Reader(np.zeros((tx.ALPHABET,) * 3, np.float32))
    assert len(reader.words("a1b" * 5_000)) > 0


def test_each_spelling_of_the_channel_is_restored(spark):
    plain = spark.createDataFrame([(i, "that man is an idiot and a moron , the ass was dumb and a fool or a pathetic clown") for i in range(30)], "doc_id long, text string")
    reader = tx.Reader(tx.character_model(plain))
    spelled = {
        "idi07": "idiot", "a55": "ass", "dum8": "dumb", "foo1": "fool", "iiddiioott": "idiot", "moorroonn": "moron", "id-iot": "idiot",
        "i.d.i.o.t.": "idiot", "i.d.i.o.t,": "idiot", "i.d.i.o.t!": "idiot", '"i.d.i.o.t"': "idiot", "i d i o t!": "idiot",
    }
    assert not [hidden for hidden, word in spelled.items() if word not in reader.words(f"what an {hidden} he is")]
    assert tx.suspicious("a plain text, with words... and 2024 numbers from 2024-10-12") == set()


def test_runs_with_one_doubled_letter_need_no_search():
    """The short cut returns what the search returns."""
    rng = np.random.default_rng(4)
    model = rng.normal(size=(tx.ALPHABET,) * 3).astype(np.float32)
    for run in ("anntly", "ssay", "will", "aab", "öffne", "übber", "x" * 2):
        assert set(tx.few_readings(run)) == set(tx.readings(run, model))
    for run in ("idioot!", "i.d", "aaab", "boottee", "b00k", "plain"):
        assert tx.few_readings(run) is None
