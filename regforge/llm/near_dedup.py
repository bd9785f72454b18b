"""MinHash near-dedup with sequential Bayesian verification.

1. Each text becomes its set of five-word shingles, hashed, and a MinHash signature.
   Texts with equal sets form a class; only its band hashes are kept, and only classes go on.
2. Banding: classes that share a band of the signature meet in a bucket.
3. First, a bucket of few classes pairs them all, a larger one pairs the class that meets
   most others (the original of a group of near copies, as a rule) with the rest. Links
   join components.
4. The classes of larger buckets that are still apart meet again by their rare shingles:
   with shingles in ascending order of frequency, texts of similarity t share one of the
   first n - ceil(t n) + 1 of each. Texts that share a passage beside as many shingles of
   their own have none of these in common. The place of the common shingle bounds the overlap, and pairs that it rules out are not made.
   This is exact. In rounds, each of these buckets takes hubs from outside its largest
   component, all of them or a number that doubles with the round, and pairs them with the
   classes of other components; hubs then leave the bucket. Connected classes are not
   compared again, so a bucket of near copies costs pairs in proportion to its size, and no
   bucket ends before each of its classes has met or joined all that it may resemble.
5. A pair's signatures are compared batch by batch. It is pruned as soon as the posterior
   probability (uniform prior) that its similarity reaches the threshold is below
   ``MISS``. Survivors are compared on their full sets.
6. Links join components.

Rows with equal ids count as one document. Texts without words are linked with nothing and
stay. A null id takes part as a value of its own. Empty tables give no row; other columns
are ignored. The functions run jobs and stage their results.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regforge.functions.columns import explode_rows
from regforge.llm.common import small_batches, staged, text_of
from regforge.llm.components import connected_components
from regforge.llm.tokens import hash_words, mix, shingle_set
from regforge.operators.joins import splittable_join

HASHES = 256
#: The largest chance that the bands miss a pair at the threshold.
BAND_MISS = 1e-5
BATCH = 32
MISS = 1e-6
BROADCAST_ROWS = 1_000_000
#: Texts that are handed to Python at a time.
TEXT_ROWS = 500
#: Classes of a band bucket that are all paired.
FEW = 16
#: Hubs that a bucket of a rare shingle takes at once, and the first draw of a larger one.
MANY = 512
HUBS = 6
_FACTORS = np.random.default_rng(7).integers(1, 2**63, HASHES // 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """``HASHES`` minima; each 64-bit product gives two 32-bit hashes."""
    low = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048, None] * _FACTORS[None, :]
        np.minimum(low, part.view(np.uint32).min(axis=0), out=low)
    return low


def _texts(column: pa.Array) -> list[bytes]:
    return pc.fill_null(pc.cast(column, pa.binary()), b"").to_pylist()


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def class_of(shingles: np.ndarray) -> int | None:
    """One id for equal sets; the shingles are distinct and sorted."""
    if not len(shingles):
        return None
    return int(mix(mix(shingles).sum(keepdims=True) + np.uint64(len(shingles)))[0].view(np.int64))


def _sketch(size: int, height: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        words, bounds = hash_words(_texts(batch.column("text")))
        n, cls, bands = [], [], []
        for i in range(batch.num_rows):
            found = shingle_set(words[bounds[i] : bounds[i + 1]], size)
            n.append(len(found))
            cls.append(class_of(found))
            bands.append(band_keys(signature(found), height) if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", "n", "cls", "bands"],
        )


def sketches(docs: DataFrame, percent: int = 85, size: int = 5) -> DataFrame:
    """(doc_id, n, cls, bands) per row; cls and bands are NULL without words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(functools.partial(_sketch, size, band_rows(percent)), "doc_id long, n long, cls long, bands array<long>")


def _facts(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        words, bounds = hash_words(_texts(batch.column("text")))
        sets = [shingle_set(words[bounds[i] : bounds[i + 1]], size) for i in range(batch.num_rows)]
        # A repeated id brings texts of other classes along.
        fits = pa.array([class_of(s) == c for s, c in zip(sets, batch.column("cls").to_pylist(), strict=True)], pa.bool_())
        found = [pa.array([x.tobytes() for x in column], pa.binary()) for column in (map(signature, sets), sets)]
        yield pa.RecordBatch.from_arrays([batch.column("cls"), *found], ["cls", "signature", "shingles"]).filter(fits)


def band_rows(percent: int) -> int:
    """The most rows per band that keep the chance of a miss within ``BAND_MISS``."""
    fits = [r for r in range(1, 33) if (1 - (percent / 100) ** r) ** (HASHES // r) <= BAND_MISS]
    return max(fits, default=1)


_WEIGHTS = np.random.default_rng(11).integers(1, 2**63, 32, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(minima: np.ndarray, height: int) -> np.ndarray:
    """One hash per band of ``height`` minima."""
    count = HASHES // height
    bands = minima[: count * height].reshape(count, height).astype(np.uint64)
    return mix(mix((bands * _WEIGHTS[:height]).sum(axis=1)) + np.arange(count, dtype=np.uint64)).view(np.int64)


def buckets(rows: DataFrame) -> DataFrame:
    """(bucket, cls, n) for the buckets in which two or more classes meet."""
    every = explode_rows(rows.filter("cls is not null"), "bands", "bucket", keep=["cls", "n"])
    shared = every.groupBy("bucket").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).filter("low <> high")
    return every.join(shared.select("bucket"), "bucket").select("bucket", "cls", "n").distinct()


@functools.lru_cache(maxsize=8)
def least_matches(percent: int, miss: float = MISS) -> list[int]:
    """For 1, 2, ... batches: the fewest matches that do not prune a pair.

    The posterior of the similarity after m matches of n is Beta(m + 1, n - m + 1); its mass
    at or above the threshold t is P(Binomial(n + 1, t) <= m).
    """
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        mass, m = 0.0, -1
        while mass < miss:
            m += 1
            mass += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def _prune(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    least = least_matches(percent)
    for batch in _slices(batches, 4096):
        left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("sa", "sb"))
        alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
        for k, need in enumerate(least):
            part = slice(k * BATCH, (k + 1) * BATCH)
            matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
            alive = alive[matches[alive] >= need]
        yield batch.select(["a", "b"]).take(pa.array(alive))


def _compare(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches, 256):
        keep = []
        for x, y in zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * common >= percent * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verify(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough, staged."""
    for end in "ab":
        pairs = pairs.join(facts.select(F.col("cls").alias(end), F.col("signature").alias("s" + end)), end)
    with small_batches(pairs.sparkSession, 4 * TEXT_ROWS):
        rest = staged(pairs.mapInArrow(functools.partial(_prune, percent), "a long, b long"), "pairs-alive")
    for end in "ab":
        rest = rest.join(facts.select(F.col("cls").alias(end), F.col("shingles").alias("x" + end)), end)
    with small_batches(pairs.sparkSession, 256):
        return staged(rest.mapInArrow(functools.partial(_compare, percent), "a long, b long"), "pairs-linked")


def _first_round(members: DataFrame) -> DataFrame:
    """The members with a mark ``hub`` (and ``done`` where all of a bucket are hubs), staged."""
    sized = members.join(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")), "bucket")
    sized = staged(sized.join(sized.groupBy("cls").agg(F.sum("size").alias("meets")), "cls"), "meets")
    first = sized.filter(F.col("size") > FEW).groupBy("bucket").agg(F.max(F.struct("meets", "cls")).getField("cls").alias("first"))
    live = sized.join(first, "bucket", "left").withColumn("done", F.col("first").isNull())
    return staged(live.select("bucket", "cls", "n", "comp", "at", "done", (F.col("done") | (F.col("cls") == F.col("first"))).alias("hub")), "members")


def _later_round(members: DataFrame, turn: int) -> DataFrame:
    """As ``_first_round``, for the buckets whose classes are still apart."""
    live = members.join(_apart(members), "bucket")
    done = F.col("outside") <= MANY
    # The draw does not depend on the bucket, so the buckets of one group share their hubs and pairs.
    drawn = F.pmod(F.xxhash64("cls", F.lit(turn)), F.lit(1 << 20)) < F.lit(float(HUBS << min(turn, 40))) / F.col("outside") * (1 << 20)
    return staged(live.withColumn("done", done).withColumn("hub", (F.col("comp") != F.col("top")) & (done | drawn)), "members")


def _apart(members: DataFrame) -> DataFrame:
    """(bucket, top, outside): the largest component of a bucket and the classes outside it."""
    parts = members.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("size"))
    state = parts.groupBy("bucket").agg(F.max(F.struct("size", "comp")).alias("top"), F.sum("size").alias("all"), F.count(F.lit(1)).alias("parts"))
    return state.filter("parts > 1").select("bucket", F.col("top.comp").alias("top"), (F.col("all") - F.col("top.size")).alias("outside"))


def _pairs(live: DataFrame, percent: int) -> DataFrame:
    """Hubs with the classes of other components, where places and sizes allow the similarity."""
    hubs = live.filter("hub").selectExpr("bucket", "cls as hub_cls", "comp as hub_comp", "n as hub_n", "at as hub_at")
    overlap = F.least(F.col("n") - F.col("at"), F.col("hub_n") - F.col("hub_at"))
    fits = overlap * (100 + percent) >= (F.col("n") + F.col("hub_n")) * percent
    # A pair of two hubs comes once.
    once = ~F.col("hub") | (F.col("cls") < F.col("hub_cls"))
    met = live.join(hubs, "bucket").filter((F.col("comp") != F.col("hub_comp")) & fits & once)
    return met.select(F.least("cls", "hub_cls").alias("a"), F.greatest("cls", "hub_cls").alias("b")).distinct()


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for cls, shingles in zip(batch.column("cls").to_pylist(), batch.column("shingles").to_pylist(), strict=True):
            found = np.frombuffer(shingles, np.int64)
            same = (np.full(len(found), value, np.int64) for value in (cls, len(found)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*same, found)], ["cls", "n", "bucket"])


def rare_buckets(classes: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """(bucket, cls, n, at): the shingles by which a class can meet those similar to it.

    ``at`` is the shingle's place in ascending order of frequency among ``classes``; shingles
    of one class come first, and meet nothing.
    """
    words = facts.join(classes, "cls", "left_semi").select("cls", "shingles")
    with small_batches(facts.sparkSession, TEXT_ROWS):
        words = staged(words.mapInArrow(_words, "cls long, n long, bucket long"), "words")
    often = words.groupBy("bucket").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    shared = splittable_join(words, often, "bucket", "bucket", "inner")
    text = Window.partitionBy("cls")
    place = F.col("n") - F.count(F.lit(1)).over(text) + F.row_number().over(text.orderBy("often", "bucket")) - 1
    return shared.withColumn("at", place).filter((F.col("n") - F.col("at")) * 100 >= F.col("n") * percent).select("bucket", "cls", "n", "at")


def _renamed(rows: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    """``rows`` with the root of ``column`` in its place, where it has one."""
    to = roots.select(F.col("node").alias(column), F.col("root").alias("root_of"))
    return rows.join(to, column, "left").withColumn(column, F.coalesce("root_of", column)).drop("root_of")


def near_duplicates(docs: DataFrame, percent: int = 85, size: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id and kept per row, by links of ``percent`` or more."""
    spark = docs.sparkSession
    with small_batches(spark, TEXT_ROWS):
        rows = staged(sketches(docs, percent, size), "sketches")
    members = staged(buckets(rows), "buckets")
    wanted = members.select("cls").distinct()
    classes = rows.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
    met = staged(classes.join(wanted, "cls"), "met")
    # Two numbers per class; beyond the bound the texts are joined by shuffle.
    few = F.broadcast(met) if met.count() <= BROADCAST_ROWS else met
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("text"))
    same = texts.join(few, F.col("id").eqNullSafe(F.col("doc_id"))).select("cls", "text")
    facts = same.mapInArrow(functools.partial(_facts, size), "cls long, signature binary, shingles binary")
    with small_batches(spark, TEXT_ROWS):
        facts = staged(facts.dropDuplicates(["cls"]), "facts")
    # Rows that share an id are one document.
    several = rows.filter("cls is not null").groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("top")).filter("a <> top")
    found = staged(rows.join(several, rows.doc_id.eqNullSafe(several.doc_id)).selectExpr("cls as a", "a as b").filter("a <> b"), "links")
    roots, turn = connected_components(found), 0
    members = _renamed(members.withColumn("comp", F.col("cls")), "comp", roots).withColumn("at", F.lit(0).cast("long"))
    while not members.isEmpty():
        live = _later_round(members, turn) if turn else _first_round(members)
        found = verify(_pairs(live, percent), facts, percent)
        for end in "ab":
            found = _renamed(found, end, roots)
        moved = connected_components(found)
        rest = _renamed(live.filter("not done"), "comp", moved)
        if turn:
            members = staged(rest.filter("not hub").select("bucket", "cls", "n", "comp", "at"), "members")
        else:
            rest = staged(rest, "open")
            apart = staged(rest.join(_apart(rest), "bucket", "left_semi").select("cls", "comp").distinct(), "apart")
            members = staged(rare_buckets(apart, facts, percent).join(apart, "cls"), "members")
        roots = staged(_renamed(roots, "root", moved).unionByName(moved.join(roots.select("node"), "node", "left_anti")), "roots")
        turn += 1
    comp = roots
    named = rows.select("doc_id", "n", "cls").join(comp.withColumnRenamed("node", "cls"), "cls", "left")
    named = staged(named.select("doc_id", "n", "cls", F.coalesce("root", "cls").alias("root")), "named")
    lowest = named.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return (
        named.join(lowest, "root", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.col("doc_id").eqNullSafe(F.coalesce("component_id", "doc_id")).alias("kept"),
        )
    )
