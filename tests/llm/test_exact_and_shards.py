import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

from regforge.llm import exact_dedup as ed
from regforge.llm.sharding import kd_shards


def test_perfect_hash_is_minimal():
    raw = b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(5_000))
    digests = np.frombuffer(raw, np.uint8)
    sizes, bits, slots = ed.perfect_hash(digests)
    assert sorted(slots.tolist()) == list(range(5_000))
    assert (ed.find_slots(digests, np.array(sizes), bits) == slots).all()


def test_exact_dedup_against_brute_force(docs, rows):
    groups = defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    for i, t, *_ in rows:
        groups[norm(t)].append((-len(t or ""), i is None, i))
    want = []
    for i, t, *_ in rows:
        keep = min(groups[norm(t)], key=lambda x: (x[0], x[1], x[2] or 0))[2]
        want.append((i, keep, len(groups[norm(t)]), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    have = [tuple(r) for r in ed.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    assert sorted(have, key=str) == sorted(want, key=str)


def test_small_index_shards_give_the_same(docs):
    rows = ed.digests(docs)
    old, new = rows.filter("id < 20"), rows.filter("id >= 20 or id is null")
    one = {(bytes(r[0]), *r[1:]) for r in ed.dedup(old, new).collect()}
    many = {(bytes(r[0]), *r[1:]) for r in ed.dedup(old, new, shard_rows=5).collect()}
    assert one == many and len(one) == rows.select("digest").distinct().count()


def test_look_up_rejects_what_only_shares_a_slot(docs):
    old = ed.winners(ed.digests(docs.filter("doc_id < 10")))
    found = ed.look_up(ed.winners(ed.digests(docs)), ed.build_index(old, 1), 1)
    assert found.filter("member").count() == old.count()


def test_shards(docs, rows):
    out = [r.asDict() for r in kd_shards(docs.filter("doc_id <> 54 or doc_id is null"), shards=4, part=0.05).collect()]
    assert len(out) == len(rows) - 1 and {r["law"] for r in out} == {"bytes"}
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r)
    assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in by.values())
    total = sum(r["size"] for r in out)
    assert all(abs(sum(r["size"] for r in s) / (total / 4) - 1) < 0.2 for s in by.values())
    text = {i: t or "" for i, t, *_ in rows}
    assert all(r["size"] == len(text[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) for r in out)
    assert len({r["shard"] for r in out if text[r["doc_id"]] == ""}) == 1


def test_a_hot_text_is_dealt_to_several_shards(spark):
    hot = spark.range(900).selectExpr("id as doc_id", "case when id % 3 = 0 then repeat('a', 500) else repeat(cast(id as string), 100) end as text", "'en' as lang", "'s' as source")
    sizes = [r["b"] for r in kd_shards(hot, shards=8).groupBy("shard").agg({"size": "sum"}).toDF("shard", "b").collect()]
    assert len(sizes) == 8 and max(sizes) / min(sizes) < 1.1


def test_empty(empty):
    assert ed.exact_dedup(empty).count() == 0 and kd_shards(empty).count() == 0


def test_groups_of_equal_texts_stay_together(spark):
    """Copies that weigh up to 4 % of a shard share one, whatever their ids; bytes stay near equal."""
    rows = [(i, f"text {i} " + "x " * (200 + i * 37 % 300)) for i in range(1500)]
    rows += [(10_000 + i, f"copied {i // 3} " + "y " * 50) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = kd_shards(docs).collect()
    shards, groups = defaultdict(int), defaultdict(set)
    texts = dict(rows)
    for r in got:
        shards[r["shard"]] += r["size"]
        groups[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(g) == 1 for g in groups.values())
    assert max(shards.values()) < 1.05 * min(shards.values())
