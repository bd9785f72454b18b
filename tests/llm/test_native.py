import re
from collections import defaultdict

import numpy as np
import pytest

from regforge.llm.decontaminate import contaminated_documents
from regforge.llm.mixing import WEIGHTS, mix, mixed_documents
from regforge.llm.queries import QUERIES
from regforge.llm.url_filter import RULES, judge_urls

SMALL = "/root/testdata/sf0.01"


def targets(sizes, share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= most * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full


def test_mixing_meets_its_targets(docs, rows):
    sizes, source = defaultdict(int), {}
    for i, t, _, s, *_ in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        source[i] = s
    want, have = targets(sizes), defaultdict(int)
    out = mix(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        s = source[r["doc_id"]]
        have[s] += r["taken"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s]) and 0 <= r["taken"] <= 2 * r["size"]
    # A repeated row is taken twice or not at all, so its source may be off by its size.
    assert all(abs(have[s] - want[s]) <= 201 for s in sizes)
    assert sorted(out, key=str) == sorted(mix(docs.repartition(5)).collect(), key=str)


def test_inclusion_follows_the_fractions(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('w ', cast(20 + id % 7 as int)) as text", "concat('s', id % 3) as source")
    taken = mix(docs).selectExpr("doc_id % 3 as s", "sum(taken) over (partition by doc_id % 3) / max(target) over (partition by doc_id % 3) as r", "taken / size as k").collect()
    assert all(abs(r["r"] - 1) < 1e-3 for r in taken)
    for s in range(3):
        copies = np.array([r["k"] for r in taken if r["s"] == s])
        assert copies.std() < 0.51 and (np.minimum(np.abs(copies - np.floor(copies)), 0.5) > 0).sum() <= 1


def test_mixed_documents_keep_their_columns(docs, empty):
    out = mixed_documents(docs)
    assert out.columns == docs.columns and out.count() > 0
    assert mix(empty).count() == 0 and mixed_documents(empty).count() == 0


def expected_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(re.match(r"[^/?#]*", rest)[0]) :])[0]
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


@pytest.mark.parametrize("extra", [[], [None, "", "no scheme", "HTTP://Example.ORG/en/1x", "http://example.org/es/", "http://notexample.org/es/?a#b", "x://a.com?fr/", "http://a.com/fr/" + "z" * 5000, "http://a.com/fr/1"] * 2])
def test_urls_follow_the_rules(spark, extra):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()
    urls = [*[(r[0], r[1]) for r in pages], *[(10_000 + i, u) for i, u in enumerate(extra)]]
    frame = spark.createDataFrame(urls, "page_id long, url string").selectExpr("page_id", "url", "'x' as score", "1 as text")
    out = {r["page_id"]: r for r in judge_urls(frame).collect()}
    assert len(out) == len(urls)
    for page, url in urls:
        host, path, rule, verdict = expected_rule(url)
        r = out[page]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] == (verdict or r["verdict"])
        assert r["verdict"] in ("allow", "block") and r["score"] is not None


def test_url_models_tell_kinds_apart(spark):
    good = [(i, f"http://library{i}.net/books/{i}") for i in range(60)]
    bad = [(100 + i, f"http://casino-win{i}.net/bonus/{i}") for i in range(60)]
    pages = spark.createDataFrame(good[:10] + bad[:10], "page_id long, url string")
    known = spark.createDataFrame([(u, True) for _, u in good[10:]] + [(u, False) for _, u in bad[10:]], "url string, accepted boolean")
    verdicts = {r["page_id"]: r["verdict"] for r in judge_urls(pages, examples=known).collect()}
    assert all(verdicts[i] == "allow" for i, _ in good[:10]) and all(verdicts[i] == "block" for i, _ in bad[:10])
    assert {r["verdict"] for r in judge_urls(pages, examples=known.limit(0)).collect()} == {"allow"}
    assert judge_urls(pages.limit(0)).count() == 0


def test_contamination_against_brute_force(spark):
    """Every document that holds a whole passage, however it is set, and no other."""
    clean = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    docs = [(r["doc_id"], clean(r["text"])) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r["item_id"], clean(r["text"])) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = {(d, i) for d, t in docs for i, p in items if p in t}
    have = {(r["doc_id"], r["item_id"]) for r in QUERIES["op7_template_decontamination"](spark, SMALL).collect()}
    assert want and have == want


def test_other_numbers_and_names_are_caught(spark, empty):
    items = [(1, "if a train goes from Paris to Rome in 12 hours and from Rome to Oslo in 30 hours how far is it"), (2, None), (3, ""), (4, "short one")]
    texts = [
        (1, "so if a train goes from Lima to Cairo in 7 hours and from Cairo to Quito in 55 hours how far is it ?"),
        (2, "so if a train goes from Lima to Cairo in 7 hours and from Lima to Quito in 55 hours how far did you walk today"),
        (3, "if a plane flies to Rome in two days and back home again then nobody knows how far it is"),
        (4, None), (5, ""), (6, "a short one"), (7, "short one"), (7, "short one"), (None, "short one"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("doc_id", "text", "1 as item_id", "2 as window")
    found = {(r["doc_id"], r["item_id"]) for r in contaminated_documents(docs, bench).collect()}
    assert (1, 1) in found and (7, 4) in found and (None, 4) in found and not {d for d, _ in found} & {3, 4, 5, 6}
    # The inconsistent names of document 2 leave it only the windows before them.
    by = {r["doc_id"]: r["matched"] for r in contaminated_documents(docs, bench, cover=0.01).filter("item_id = 1").collect()}
    assert by[2] < by[1]
    assert contaminated_documents(empty, bench).count() == 0 and contaminated_documents(docs, bench.limit(0)).count() == 0


def test_short_items_are_found_inside_documents(spark):
    items = [(1, "What is 12 times 7?"), (2, "name the capital of France"), (3, "12 + 7")]
    texts = [
        (1, "a quiz for children asks them : what is 12 times 7 ? and then they go home for the day"),
        (2, "a quiz for children asks them : what is 9 times 4 ? and then they go home for the day"),
        (3, "now name the capital of France please"), (4, "the numbers 5 + 3 and 9 and 12 + 8 are all in one text here"), (5, "name the capital"),
    ]
    bench, docs = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(texts, "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in contaminated_documents(docs, bench).collect()} == {(1, 1), (2, 1), (3, 2)}


def test_copies_in_any_case_and_layout_are_found(spark):
    item = "if a train goes from Paris to Rome in 12 hours and from Rome to Oslo in 30 hours how far is it from Paris to Oslo"
    texts = [item.lower(), item.title(), item.upper(), item.replace(" Paris", "\n Paris").replace(" Rome", "  Rome").replace(" Oslo", "\t Oslo"), item.replace("12 hours", "12hours")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = contaminated_documents(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert len(found) == len(texts) and all(r["matched"] == r["windows"] for r in found)


def test_names_that_begin_sentences_are_slots(spark):
    item = "Alice has 5 apples. Alice buys 3 more apples. Alice then eats 2 apples. How many are left?"
    texts = [
        (1, "so here it is. Bruno has 7 apples. Bruno buys 4 more apples. Bruno then eats 6 apples. How many are left?"),
        (2, "so here it is. Bruno has 7 apples. Carla buys 4 more apples. Diego then eats 6 apples. How many were they?"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = contaminated_documents(docs, spark.createDataFrame([(1, item)], "item_id long, text string"), cover=0.5).collect()
    assert [r["doc_id"] for r in found] == [1]


@pytest.mark.parametrize("ident", ["if(id % 2 = 0, null, id)", "id % 10", "cast(null as bigint)"])
def test_targets_are_met_with_missing_and_repeated_ids(spark, ident):
    """Different texts under one id, or without an id, are drawn one by one."""
    docs = spark.range(4000).selectExpr(f"{ident} as doc_id", "concat('t', id, repeat(' w', cast(20 + id % 50 as int))) as text", "concat('s', id % 3) as source")
    got = mix(docs).groupBy("source_size", "target").sum("taken").collect()
    assert len(got) == 3 and all(abs(r["sum(taken)"] - r["target"]) <= 1 for r in got)
