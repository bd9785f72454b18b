import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from regforge.llm import near_dedup as nd
from regforge.llm.components import connected_components
from regforge.llm.tokens import hash_words, shingle_set


def brute_force(rows, percent=85):
    nodes, sizes = defaultdict(list), []
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        s = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
        nodes[i].append(s)
        sizes.append((i, len(s)))
    parent = {i: i for i in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(nodes, key=lambda i: -1 if i is None else i)
    for a in ids:
        for b in ids:
            for x in nodes[a]:
                for y in nodes[b]:
                    c = len(x & y)
                    if a != b and c and 100 * c >= percent * len(x | y):
                        u, v = sorted((find(a), find(b)), key=lambda i: -1 if i is None else i)
                        parent[v] = u
    return sorted(((i, n, find(i), i == find(i)) for i, n in sizes), key=str)


def test_near_duplicates_against_brute_force(docs, rows):
    usable = [r for r in rows if r[0] is not None]
    have = sorted((tuple(r) for r in nd.near_duplicates(docs.filter("doc_id is not null")).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)
    assert have == brute_force(usable)


def test_a_large_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1 :])) for i, k in ((i, 5 + i % 50) for i in range(60))]
    docs = spark.createDataFrame([*rows, (900, "other words are here for a while")], "doc_id long, text string")
    have = sorted((tuple(r) for r in nd.near_duplicates(docs, 80).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)
    assert have == brute_force([*rows, (900, "other words are here for a while")], 80)


def test_null_ids_and_empty_tables(docs, empty):
    out = nd.near_duplicates(docs.filter("doc_id is null or doc_id > 48")).collect()
    assert {r["doc_id"] for r in out if r["n_shingles"] == 0} == {51, 52, 53} and all(r["kept"] for r in out if r["n_shingles"] == 0)
    assert nd.near_duplicates(empty).count() == 0


def test_long_chains_have_one_root(spark):
    edges = spark.range(300).selectExpr("id as a", "id + 1 as b").union(spark.createDataFrame([(1000, 1001), (7, 7)], "a long, b long"))
    roots = connected_components(edges).collect()
    assert len(roots) == 303 and len({r["root"] for r in roots if r["node"] <= 300}) == 1 and len({r["root"] for r in roots}) == 2


def test_pruning_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    least = nd.least_matches(85)
    draws = rng.random((20_000, nd.HASHES)) < 0.85
    seen = draws.cumsum(1)[:, nd.BATCH - 1 :: nd.BATCH]
    assert (seen < np.array(least)).any(1).mean() < 1e-3 and least[-1] > 0.6 * nd.HASHES


@pytest.mark.parametrize("percent", [80, 85, 90])
def test_bands_miss_little(percent):
    r = nd.band_rows(percent)
    assert (1 - (percent / 100) ** r) ** (nd.HASHES // r) <= nd.BAND_MISS


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    texts = [b"", b" a", b"Word word WORD", ("x" * 50 + " y ").encode() * 40, "größe é".encode()]
    whole = hash_words(texts)
    monkeypatch.setattr("regforge.llm.tokens.PIECE", 64)
    parts = hash_words(texts)
    assert all((x == y).all() for x, y in zip(whole, parts, strict=True))
    w, b = whole
    assert np.diff(b).tolist() == [0, 1, 3, 80, 2] and w[b[2]] == w[b[2] + 1] == w[b[2] + 2]
    assert len(shingle_set(w[b[2] : b[3]], 5)) == 1
    assert Counter(w[b[3] : b[4]].tolist()).most_common(1)[0][1] == 40


def test_texts_that_share_a_passage_meet_by_rare_shingles(spark):
    """A bucket of more than FEW classes that stay apart, near copies among them."""
    passage = [f"p{k}" for k in range(60)]
    rows = [(i, " ".join([f"own{i}x{k}" for k in range(12)] + passage)) for i in range(40)]
    rows += [(100 + i, rows[i][1] + f" end{i}") for i in range(0, 40, 4)]
    rows += [(200 + i, " ".join([*passage[:i], f"in{i}", *passage[i + 1 :]])) for i in range(5, 55, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    have = sorted((tuple(r) for r in nd.near_duplicates(docs, 80).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)
    assert have == brute_force(rows, 80)


def test_rare_buckets_keep_every_similar_pair(spark):
    """Brute force: two sets at the threshold share a bucket, at places that allow the pair."""
    rng = np.random.default_rng(3)
    common = rng.integers(1, 500, 80)
    sets = {c: np.unique(np.concatenate([rng.choice(common, 60), rng.integers(1, 5000, rng.integers(1, 12))])).astype(np.uint64) for c in range(60)}
    sets |= {100 + c: np.unique(np.append(sets[c], np.uint64(9000 + c))) for c in range(20)}
    facts = spark.createDataFrame([(c, bytearray(s.tobytes())) for c, s in sets.items()], "cls long, shingles binary")
    classes = facts.selectExpr("cls", "cls as comp")
    for percent in (80, 85):
        live = nd.rare_buckets(classes, facts, percent).withColumn("comp", nd.F.col("cls")).withColumn("hub", nd.F.lit(True))
        have = {(r["a"], r["b"]) for r in nd._pairs(live, percent).collect()}
        similar = lambda x, y: 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y))  # noqa: B023, E731
        want = {(a, b) for a in sets for b in sets if a < b and similar(sets[a], sets[b])}
        assert len(want) >= 20 and want <= have
