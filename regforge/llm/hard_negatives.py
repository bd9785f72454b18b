"""Hard-negative mining: exact inner products by residue-number-system GEMM.

Components become integers. Integer matrices are multiplied modulo several small primes in
float32: residues lie around 0, and so few columns are added before the next reduction that
no sum leaves the integers a float32 holds. The residues of a score are put together by
Chinese remaindering (mixed radix), which gives the exact signed score; as many primes are
taken as the largest possible score needs.

Anchors come in blocks of about ``ANCHOR_BLOCK`` rows. A block is sent to all tasks, and
every partition of the rows is read against it twice: once for the positives of each anchor,
once, with their scores known, for the negatives inside each positive's window. A partition
returns at most ``positives`` rows per anchor and ``negatives`` rows per anchor and positive,
whatever its size; Spark ranks these. So memory depends on the block and on the batch, and a
hot label, anchor or vector stays spread over all partitions.

Rows with a NULL label, a NULL vector or a NULL or non-finite component take no part. A
shorter vector counts as filled up with zeros. Rows are told apart by place, not by id: of
repeated ids every row is an anchor, a positive or a negative of its own. A NULL id is no
anchor; as a negative it comes last among ties. An anchor without positives, and a window
without rows, give no rows. Empty tables give an empty result; other columns are ignored.
Scores that could leave 64 bits (times 100) are an error, not a wrong result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regforge.llm.common import staged

ANCHOR_BLOCK = 4096
CELLS = 1 << 20
PRIMES = (251, 241, 239, 233, 229, 227, 223, 211, 199, 197)
#: Columns that may be added up: this many squares of 125 stay below 2 ** 24.
COLUMNS = 1024
_NONE = np.iinfo(np.int64).min


def primes_for(bound: int) -> tuple[int, ...]:
    """As many primes as scores from ``-bound`` to ``bound`` need."""
    product, taken = 1, []
    for p in PRIMES:
        if product > 2 * bound:
            break
        taken.append(p)
        product *= p
    if product <= 2 * bound or product >= 1 << 63:
        raise ValueError(f"scores up to {bound} do not fit into 64 bits")
    return tuple(taken)


def residues(matrix: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    """Residues around 0 of an integer matrix, one float32 matrix per prime."""
    return [((matrix + p // 2) % p - p // 2).astype(np.float32) for p in primes]


def exact_products(left: list[np.ndarray], right: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """``left @ right.T`` as int64, from the residues of two integer matrices."""
    digits: list[np.ndarray] = []
    for p, a, b in zip(primes, left, right, strict=True):
        total = np.zeros((len(a), len(b)), np.int32)
        for at in range(0, a.shape[1], COLUMNS):
            total = (total + (a[:, at : at + COLUMNS] @ b[:, at : at + COLUMNS].T).astype(np.int32)) % np.int32(p)
        # The next mixed-radix digit: what the digits so far leave open modulo p.
        base = 1
        for q, digit in zip(primes, digits, strict=False):
            total -= digit * np.int32(base % p) % np.int32(p)
            base *= q
        digits.append(total * np.int32(pow(base % p, -1, p)) % np.int32(p))
    value, base = np.zeros((len(left[0]), len(right[0])), np.int64), 1
    for p, digit in zip(primes, digits, strict=True):
        value += digit.astype(np.int64) * base
        base *= p
    value[value > base // 2] -= base
    return value


@dataclass(frozen=True)
class Block:
    """Anchors of one block, sorted by label; ``windows`` are positive scores (anchor, k)."""

    row: np.ndarray
    ident: np.ndarray
    label: np.ndarray
    vectors: list[np.ndarray]
    primes: tuple[int, ...]
    windows: np.ndarray | None = None
    known: np.ndarray | None = None


def _ordered(score: np.ndarray, none: np.ndarray, ident: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The first ``k`` along the last axis: higher score, then smaller id (NULL last), then place."""
    order = np.lexsort((row, ident, none, -score), axis=-1)[..., :k]
    return tuple(np.take_along_axis(x, order, -1) for x in (score, none, ident, row))


class _Best:
    """The best ``k`` rows of every slot, batch after batch."""

    def __init__(self, slots: tuple[int, ...], k: int):
        self.k = k
        self.parts = tuple(np.full((*slots, k), v, t) for v, t in ((_NONE + 1, np.int64), (True, bool), (0, np.int64), (-1, np.int64)))

    def add(self, at: slice, score: np.ndarray, none: np.ndarray, ident: np.ndarray, row: np.ndarray) -> None:
        joined = [np.concatenate([old[at], new], -1) for old, new in zip(self.parts, (score, none, ident, row), strict=True)]
        for old, new in zip(self.parts, _ordered(*joined, self.k), strict=True):
            old[at] = new


def _rows(batches: Iterator[pd.DataFrame], block: Block) -> Iterator[tuple]:
    """Batches as (row, id, NULL id, label, residues), sorted by id and place."""
    width = block.vectors[0].shape[1]
    for batch in batches:
        step = max(1, CELLS // max(1, width))
        for at in range(0, len(batch), step):
            part = batch.iloc[at : at + step]
            vector = np.zeros((len(part), width), np.int64)
            for i, v in enumerate(part["vector"]):
                vector[i, : len(v)] = v
            ident, none, row = part["ident"].to_numpy(np.int64), part["no_id"].to_numpy(bool), part["row"].to_numpy(np.int64)
            order = np.lexsort((row, ident, none))
            yield row[order], ident[order], none[order], part["label"].to_numpy(np.int64)[order], residues(vector[order], block.primes)


def _label_runs(block: Block) -> list[tuple[int, slice]]:
    edges = np.flatnonzero(np.diff(block.label, prepend=block.label[0] - 1)).tolist() + [len(block.label)]
    return [(int(block.label[a]), slice(a, b)) for a, b in zip(edges, edges[1:], strict=False)]


def _pieces(at: slice, width: int) -> Iterator[slice]:
    step = max(1, CELLS // max(1, width))
    for a in range(at.start, at.stop, step):
        yield slice(a, min(a + step, at.stop))


def _positives_of(block: Block, k: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = _Best((len(block.row),), k)
        for row, ident, none, label, vectors in _rows(batches, block):
            for wanted, run in _label_runs(block):
                same = np.flatnonzero(label == wanted)
                right = [v[same] for v in vectors]
                for at in _pieces(run, len(same)) if len(same) else ():
                    score = exact_products([v[at] for v in block.vectors], right, block.primes)
                    score[block.row[at][:, None] == row[same][None]] = _NONE + 1
                    # Rows are in order of id, so a stable sort by score breaks ties by id.
                    top = np.argsort(-score, axis=1, kind="stable")[:, :k]
                    kept = np.take_along_axis(score, top, 1)
                    place = np.where(kept == _NONE + 1, -1, row[same][top])
                    best.add(at, kept, none[same][top], ident[same][top], place)
        score, none, ident, row = best.parts
        a, j = np.nonzero(row >= 0)
        yield pd.DataFrame({"anchor_row": block.row[a], "anchor_id": block.ident[a], "row": row[a, j], "ident": ident[a, j], "no_id": none[a, j], "score": score[a, j]})

    return find


def _negatives_of(block: Block, k: int, low: int, high: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows of another label with ``low * positive <= 100 * score <= high * positive``."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots = block.windows.shape
        best = _Best(slots, k)
        for row, ident, none, label, vectors in _rows(batches, block):
            for wanted, run in _label_runs(block):
                other = np.flatnonzero(label != wanted)
                right = [v[other] for v in vectors]
                for at in _pieces(run, len(other)) if len(other) else ():
                    score = exact_products([v[at] for v in block.vectors], right, block.primes)
                    order = np.argsort(-score, axis=1, kind="stable")
                    down = -np.take_along_axis(score, order, 1) * 100
                    shape = (at.stop - at.start, slots[1], k)
                    place = np.full(shape, -1, np.int64)
                    for i in range(shape[0]):
                        window = block.windows[at.start + i]
                        first = np.searchsorted(down[i], -high * window, side="left")
                        after = np.searchsorted(down[i], -low * window, side="right")
                        spots = first[:, None] + np.arange(k)
                        good = (spots < after[:, None]) & block.known[at.start + i][:, None]
                        place[i] = np.where(good, order[i][np.minimum(spots, len(other) - 1)], -1)
                    safe = np.maximum(place, 0)
                    found = np.where(place < 0, _NONE + 1, np.take_along_axis(score[:, None, :], safe, 2))
                    best.add(at, found, none[other][safe], ident[other][safe], np.where(place < 0, -1, row[other][safe]))
        score, none, ident, row = best.parts
        a, p, j = np.nonzero(row >= 0)
        yield pd.DataFrame(
            {"anchor_row": block.row[a], "window": p, "row": row[a, p, j], "ident": ident[a, p, j], "no_id": none[a, p, j], "score": score[a, p, j]}
        )

    return find


FOUND = "row long, ident long, no_id boolean, score long"


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "no_id", "ident", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def prepared(vectors: DataFrame, scale: int, label: Column) -> DataFrame:
    """(row, ident, no_id, label, vector): the rows that take part, with their place, staged."""
    parts = F.col("embedding").cast("array<double>")
    sound = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col("vec_id").cast("long"), F.lit(0)).alias("ident"),
        F.col("vec_id").isNull().alias("no_id"),
        label.cast("long").alias("label"),
        F.transform(parts, lambda x: F.floor(x * scale)).alias("vector"),
    )
    return staged(rows, "vectors")


def mine(
    vectors: DataFrame, anchor: Column, label: Column, scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """Hard negatives of every anchor and positive.

    ``anchor`` (over ``ident``) says which rows ask, ``label`` is the class of a row. Returns
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score, staged.
    """
    spark = vectors.sparkSession
    rows = prepared(vectors, scale, label)
    largest = F.max(F.array_max(F.transform("vector", lambda x: F.abs(x))))
    size = rows.agg(F.max(F.size("vector")).alias("width"), largest.alias("top")).first()
    width, top = size["width"] or 0, size["top"] or 0
    primes = primes_for(max(1, width * top * top * 100) // 100)
    if width * top * top * 100 >= 1 << 62:
        raise ValueError("scores times 100 do not fit into 64 bits")
    asking = rows.filter(~F.col("no_id") & F.coalesce(anchor, F.lit(False))).withColumn("block", F.lit(0))
    blocks = -(-asking.count() // ANCHOR_BLOCK)
    if blocks > 1:
        # Blocks by hash, a little smaller on average, so that none is much larger.
        asking = staged(asking.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks + blocks // 8 + 1))), "anchors")
        blocks += blocks // 8 + 1
    narrow = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    results = spark.createDataFrame([], narrow)
    for number in range(blocks):
        held = asking.filter(F.col("block") == number).select("row", "ident", "label", "vector").toPandas().sort_values(["label", "row"])
        if held.empty:
            continue
        vector = np.zeros((len(held), width), np.int64)
        for i, v in enumerate(held["vector"]):
            vector[i, : len(v)] = v
        block = Block(*(held[c].to_numpy(np.int64) for c in ("row", "ident", "label")), residues(vector, primes), primes)
        found = rows.mapInPandas(_positives_of(block, positives), "anchor_row long, anchor_id long, " + FOUND)
        best = staged(_ranked(found, ["anchor_row"], positives).select(F.col("rank").alias("window"), "anchor_row", "anchor_id", F.col("ident").alias("positive_id"), F.col("no_id").alias("no_positive_id"), F.col("score").alias("positive_score")), "positives")
        at = {r: i for i, r in enumerate(block.row.tolist())}
        windows, known = np.zeros((len(held), positives), np.int64), np.zeros((len(held), positives), bool)
        for r in best.select("anchor_row", "window", "positive_score").collect():
            spot = at[r["anchor_row"]], r["window"] - 1
            windows[spot], known[spot] = r["positive_score"], True
        block = replace(block, windows=windows, known=known)
        found = rows.mapInPandas(_negatives_of(block, negatives, low, high), "anchor_row long, window int, " + FOUND).withColumn("window", F.col("window") + 1)
        kept = _ranked(found, ["anchor_row", "window"], negatives).join(best, ["anchor_row", "window"])
        kept = kept.select(
            "anchor_id", F.when(~F.col("no_positive_id"), F.col("positive_id")).alias("positive_id"), F.col("rank").cast("int").alias("rank"),
            F.when(~F.col("no_id"), F.col("ident")).alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
        )
        results = results.unionByName(staged(kept, "negatives"))
    return results


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """The anchors are the ids divisible by 100; every seventh id has the next label."""
    moved = F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False))
    label = F.when(moved, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(vectors, F.col("ident") % 100 == 0, label)
