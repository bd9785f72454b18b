"""Hard negatives against the definition, and exact products against Python integers."""

import random

import numpy as np
import pytest
from oracle_check import difference, duck
from pyspark.sql import functions as F

from regforge.llm import hard_negatives as H
from regforge.llm.oracle import ORACLE_SQL
from regforge.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, score string, row string"


@pytest.mark.parametrize(("low", "width"), [(-3, 1), (-300, 64), (-40_000, 2500)])
def test_products_are_exact(low, width):
    rng = np.random.default_rng(width)
    a, b = rng.integers(low, -low + 1, (7, width)), rng.integers(low, -low + 1, (9, width))
    primes = H.primes_for(width * low * low)
    got = H.exact_products(H.residues(a, primes), H.residues(b, primes), primes)
    assert (got.astype(object) == a.astype(object) @ b.astype(object).T).all()


def test_extreme_products():
    primes = H.primes_for(1 << 40)
    a = np.array([[1 << 20], [-(1 << 20)], [0]])
    assert H.exact_products(H.residues(a, primes), H.residues(a, primes), primes).tolist() == [[1 << 40, -(1 << 40), 0], [-(1 << 40), 1 << 40, 0], [0, 0, 0]]
    with pytest.raises(ValueError, match="64 bits"):
        H.primes_for(1 << 62)


def expected(rows):
    held = []
    for place, (ident, vector, label, *_) in enumerate(rows):
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        ints = [int(np.floor(256 * float(np.float32(x)))) for x in vector]
        held.append((place, ident, ints, (label + 1) % 10 if ident is not None and ident % 7 == 0 else label))
    out = []
    for place, anchor, vector, label in held:
        if anchor is None or anchor % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v, strict=False)), i is None, i or 0, p, lab) for p, i, v, lab in held if p != place]
        scored.sort()
        for score, none, ident, _, lab in [s for s in scored if s[4] == label][:5]:
            window = [s for s in scored if s[4] != label and 30 * -score <= 100 * -s[0] <= 90 * -score][:10]
            for rank, s in enumerate(window, 1):
                out.append((anchor, None if none else ident, rank, None if s[1] else s[2], -score, -s[0]))
    return sorted(out, key=str)


def cases():
    rng = random.Random(3)
    rows = [(i, [round(rng.uniform(-0.2, 1), 2) for _ in range(6)], rng.randrange(3), "x", None) for i in range(320)]
    same = rows[17][1]
    rows += [(1000 + i, same, i % 3, None, None) for i in range(40)]  # ties
    rows += [rows[100], rows[100], (100, rows[5][1], 1, None, None)]  # repeated anchors
    rows += [(None, same, 1, None, None), (None, same, 2, None, None), (400, None, 1, None, None), (500, same, None, None, None)]
    rows += [(600, [0.1, None], 1, None, None), (700, [float("nan")] * 6, 1, None, None), (800, [float("inf")] * 6, 1, None, None)]
    rows += [(900, [], 1, None, None), (901, [5.0], 0, None, None), (1200, [-1.0] * 6, 0, None, None)]
    return rows


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_equals_the_definition(spark, monkeypatch):
    rows = cases()
    frame = spark.createDataFrame(rows, SCHEMA)
    want = expected(rows)
    assert len(want) > 100
    assert got(H.hard_negatives(frame.repartition(3))) == want
    monkeypatch.setattr(H, "CELLS", 50)  # many small pieces
    monkeypatch.setattr(H, "ANCHOR_BLOCK", 2)  # several blocks
    assert got(H.hard_negatives(frame.repartition(2))) == want


def test_empty_and_without_anchors(spark):
    assert got(H.hard_negatives(spark.createDataFrame([], SCHEMA))) == []
    assert got(H.hard_negatives(spark.createDataFrame([(1, [1.0], 0, None, None)], SCHEMA))) == []
    assert got(H.hard_negatives(spark.createDataFrame([(0, [1.0], 0, None, None)], SCHEMA))) == []


def test_too_large_scores_are_an_error(spark):
    with pytest.raises(ValueError, match="64 bits"):
        H.hard_negatives(spark.createDataFrame([(0, [1e9], 0, None, None)], SCHEMA).filter(F.lit(True)))


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert difference(QUERIES["op13_hard_negatives"](spark, folder), duck(folder), ORACLE_SQL["op13_hard_negatives"]) is None
