"""Interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped.

1. Words of the training rows are counted in every task and dealt, as sorted arrays, to
   vocabulary shards by hash; a shard is merged in one task and written as arrays. A word's
   id is its place in the sorted hashes of all shards.
2. Bigrams are counted likewise. They are dealt by a rising function of (first id, second
   id) that gives every shard about the same number of tokens, from the word counts: the
   bigrams of a frequent first word spread over several shards.
3. Contexts (their total and how many bigrams have counts 1, 2, 3 or more) and continuation
   counts are added up per block of ids and written as arrays.
4. Workers map the arrays and look up the words and bigrams of their texts in them.

The arrays lie in the shared folder; a task writes to a name of its own and renames, so a
task that runs again replaces what it wrote. Shards hold about ``SHARD_BYTES`` of text at
any input size. Nothing but sizes and counts of counts reaches the driver.

Null and empty texts are one end token. Ids and texts may repeat. An empty training set
gives score 0 to every text. Words that the training rows lack get the share of the
uniform distribution over the vocabulary and one more word.
"""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regforge.llm.common import fold, shared_folder, staged, text_of
from regforge.llm.tokens import hash_words

SHARD_BYTES = 48 << 20
BLOCK = 1 << 20
#: Tokens that a task gathers before it counts them.
GATHER = 3_000_000
END = np.uint64(0x3C2F733E)
BLOBS = "shard int, keys binary, counts binary"
CONTEXT = np.dtype([("total", "<i8"), ("n1", "<i4"), ("n2", "<i4"), ("n3", "<i4"), ("follows", "<i4")])


def _write(folder: str, name: str, values: np.ndarray) -> None:
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    values.tofile(part)
    os.replace(part, f"{folder}/{name}")


@functools.lru_cache(maxsize=4096)
def _map(folder: str, name: str, kind: str) -> np.ndarray:
    path = f"{folder}/{name}"
    return np.memmap(path, kind, "r") if os.path.getsize(path) else np.empty(0, kind)


def _count(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their counts."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    if not len(keys):
        return keys, counts.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts.astype(np.int64), first)


def _blobs(keys: np.ndarray, counts: np.ndarray, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per shard with keys; shard i holds ``[bounds[i], bounds[i + 1])``."""
    for shard in np.flatnonzero(np.diff(bounds)).tolist():
        part = slice(bounds[shard], bounds[shard + 1])
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([shard], pa.int32()), "keys": pa.array([keys[part].tobytes()], pa.binary()), "counts": pa.array([counts[part].astype("<u4").tobytes()], pa.binary())}
        )


def _texts(column: pa.Array) -> list[bytes]:
    return pc.fill_null(pc.cast(column, pa.binary()), b"").to_pylist()


def _groups(batches: Iterator[pa.RecordBatch], size: int = 1 << 22) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, tokens with an end per text, bounds) for texts of about ``size`` bytes."""
    for batch in batches:
        texts, at = _texts(batch.column("text")), 0
        while at < len(texts):
            last, held = at, 0
            while last < len(texts) and (last == at or held + len(texts[last]) <= size):
                held += len(texts[last])
                last += 1
            words, bounds = hash_words(texts[at:last])
            tokens = np.insert(words, bounds[1:], END)
            yield batch.slice(at, last - at), tokens, bounds + np.arange(len(bounds))
            at = last


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Bounds of the shards in sorted hashes: equal ranges of the hash."""
    edges = np.array([(i << 64) // shards for i in range(1, shards)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _count_words(shards: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for _, tokens, _ in _groups(batches):
        held.append(tokens)
        size += len(tokens)
        if size > GATHER:
            keys, counts = _count(np.concatenate(held))
            yield from _blobs(keys, counts, _shard_of(keys, shards))
            held, size = [], 0
    if held:
        keys, counts = _count(np.concatenate(held))
        yield from _blobs(keys, counts, _shard_of(keys, shards))


def _merge(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(b"".join(rows["keys"]), "<u8")
    return _count(keys, np.frombuffer(b"".join(rows["counts"]), "<u4"))


def _write_words(folder: str, rows: pd.DataFrame) -> pd.DataFrame:
    shard, (keys, counts) = int(rows["shard"].iloc[0]), _merge(rows)
    _write(folder, f"words-{shard}", keys)
    _write(folder, f"counts-{shard}", counts)
    _write(folder, f"before-{shard}", np.cumsum(counts) - counts)
    return pd.DataFrame({"shard": [shard], "size": [len(keys)], "total": [int(counts.sum())]})


@dataclass
class Model:
    """Where the arrays are, and what is known about them as numbers."""

    folder: str
    documents: int = 0
    #: Per vocabulary shard: number of words and of tokens.
    sizes: list[int] = field(default_factory=list)
    totals: list[int] = field(default_factory=list)
    #: Per bigram shard: number of bigrams.
    bigrams: list[int] = field(default_factory=list)
    discounts: tuple[float, ...] = (0.0, 0.0, 0.0)
    lower_discounts: tuple[float, ...] = (0.0, 0.0, 0.0)
    followers: int = 0
    lower_rest: float = 1.0

    @property
    def tokens(self) -> int:
        return sum(self.totals)

    @property
    def words(self) -> int:
        return sum(self.sizes)

    def find_words(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids (-1: unknown), counts, and tokens of smaller ids, for sorted distinct hashes."""
        ids, counts, before = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        bounds, first, passed = _shard_of(keys, len(self.sizes)) if self.sizes else [], 0, 0
        for shard, size in enumerate(self.sizes):
            part = slice(bounds[shard], bounds[shard + 1])
            if size and part.start < part.stop:
                stored = _map(self.folder, f"words-{shard}", "<u8")
                at = np.minimum(np.searchsorted(stored, keys[part]), size - 1)
                hit = stored[at] == keys[part]
                ids[part] = np.where(hit, at + first, -1)
                counts[part] = np.where(hit, _map(self.folder, f"counts-{shard}", "<i8")[at], 0)
                before[part] = np.where(hit, _map(self.folder, f"before-{shard}", "<i8")[at] + passed, 0)
            first, passed = first + size, passed + self.totals[shard]
        return ids, counts, before

    def place(self, count1: np.ndarray, before1: np.ndarray, before2: np.ndarray) -> np.ndarray:
        """A number in [0, 1) that rises with (first id, second id)."""
        return np.minimum((before1 + count1 * (before2 / max(1, self.tokens))) / (self.tokens + self.documents), 1 - 1e-12)

    def pairs(self, tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per token: id, count, first id of its bigram, and the bigram's place."""
        keys, back = np.unique(tokens, return_inverse=True)
        ids, counts, before = (x[back] for x in self.find_words(keys))
        start = np.zeros(len(tokens), bool)
        start[bounds[:-1]] = True
        first, count1, before1 = (np.roll(x, 1) for x in (ids, counts, before))
        first[start], count1[start], before1[start] = self.words, self.documents, self.tokens
        return ids, counts, first, self.place(count1, before1, before)

    def find_bigrams(self, first: np.ndarray, second: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Counts of bigrams of known ids; 0 for others."""
        out = np.zeros(len(first), np.int64)
        known = np.flatnonzero((first >= 0) & (second >= 0))
        if not len(known) or not self.bigrams:
            return out
        keys = (first[known].astype(np.uint64) << np.uint64(32)) | second[known].astype(np.uint64)
        keys, at, back = np.unique(keys, return_index=True, return_inverse=True)
        shard_of = (place[known][at] * len(self.bigrams)).astype(np.int64)
        found = np.zeros(len(keys), np.int64)
        edges = np.searchsorted(shard_of, np.arange(len(self.bigrams) + 1))
        for shard in np.flatnonzero(np.diff(edges)).tolist():
            part, size = slice(edges[shard], edges[shard + 1]), self.bigrams[shard]
            if size:
                stored = _map(self.folder, f"bigrams-{shard}", "<u8")
                spot = np.minimum(np.searchsorted(stored, keys[part]), size - 1)
                found[part] = np.where(stored[spot] == keys[part], _map(self.folder, f"times-{shard}", "<u4")[spot], 0)
        out[known] = found[back]
        return out

    def contexts(self, ids: np.ndarray) -> np.ndarray:
        """The context rows of ids; zeros for unknown ones."""
        out = np.zeros(len(ids), CONTEXT)
        known = np.flatnonzero((ids >= 0) & (self.documents > 0))
        block = ids[known] // BLOCK
        for b in np.unique(block).tolist():
            here = known[block == b]
            out[here] = _context_block(self.folder, b)[ids[here] % BLOCK]
        return out

    def log_probabilities(self, tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of each token's probability, and its training count."""
        ids, counts, first, place = self.pairs(tokens, bounds)
        times = self.find_bigrams(first, ids, place)
        unique, back = np.unique(np.concatenate([ids, first]), return_inverse=True)
        rows = self.contexts(unique)
        own, given = rows[back[: len(ids)]], rows[back[len(ids) :]]
        uniform = 1.0 / (self.words + 1)
        low = np.full(len(ids), uniform)
        if self.followers:
            low = _discounted(own["follows"], self.lower_discounts) / self.followers + self.lower_rest * uniform
        d1, d2, d3 = self.discounts
        total = np.maximum(given["total"], 1)
        rest = np.where(given["total"] > 0, (d1 * given["n1"] + d2 * given["n2"] + d3 * given["n3"]) / total, 1.0)
        return np.log10(_discounted(times, self.discounts) / total + rest * low), counts


@functools.lru_cache(maxsize=4096)
def _context_block(folder: str, block: int) -> np.ndarray:
    return np.memmap(f"{folder}/contexts-{block}", CONTEXT, "r")


def _discounted(counts: np.ndarray, discounts: tuple[float, ...]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *discounts])[np.minimum(counts, 3)], 0.0)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney from the counts of counts 1 to 4."""
    if not n[0] or not n[1]:
        return 0.5, 0.75, 0.9
    y = n[0] / (n[0] + 2 * n[1])
    out = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * 0.5 for k in (1, 2, 3)]
    return tuple(min(max(d, 0.05 * k), k * 0.98) for k, d in enumerate(out, 1))


def _count_bigrams(model: Model, shards: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        keys, places = (np.concatenate(x) for x in zip(*held, strict=True))
        keys, at, counts = np.unique(keys, return_index=True, return_counts=True)
        bounds = np.searchsorted((places[at] * shards).astype(np.int64), np.arange(shards + 1))
        held.clear()
        yield from _blobs(keys, counts, bounds)

    for _, tokens, bounds in _groups(batches):
        ids, _, first, place = model.pairs(tokens, bounds)
        held.append(((first.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64), place))
        if sum(len(k) for k, _ in held) > GATHER:
            yield from flush()
    if held:
        yield from flush()


SUMS = "shard int, block int, kind string, ids binary, rows binary, size long, n array<long>"


def _write_bigrams(folder: str, rows: pd.DataFrame) -> pd.DataFrame:
    """Writes a shard; gives its counts of counts and what it adds to contexts, by block."""
    shard, (keys, counts) = int(rows["shard"].iloc[0]), _merge(rows)
    _write(folder, f"bigrams-{shard}", keys)
    _write(folder, f"times-{shard}", counts.astype("<u4"))
    out = [(shard, -1, "size", b"", b"", len(keys), [int((counts == k).sum()) for k in (1, 2, 3, 4)])]
    first = keys >> np.uint64(32)
    start = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
    given = np.zeros(len(start), CONTEXT)
    given["total"] = np.add.reduceat(counts, start)
    for name, hit in (("n1", counts == 1), ("n2", counts == 2), ("n3", counts >= 3)):
        given[name] = np.add.reduceat(hit.astype(np.int32), start)
    ids, times = np.unique(keys & np.uint64(0xFFFFFFFF), return_counts=True)
    for kind, who, values in (("context", first[start].astype("<i8"), given), ("follows", ids.astype("<i8"), times.astype("<i4"))):
        for b in np.unique(who // BLOCK).tolist():
            part = who // BLOCK == b
            out.append((shard, b, kind, (who[part] % BLOCK).astype("<i4").tobytes(), values[part].tobytes(), int(part.sum()), []))
    return pd.DataFrame(out, columns=["shard", "block", "kind", "ids", "rows", "size", "n"])


def _write_contexts(folder: str, words: int, rows: pd.DataFrame) -> pd.DataFrame:
    block = int(rows["block"].iloc[0])
    table = np.zeros(min(BLOCK, words + 1 - block * BLOCK), CONTEXT)
    for kind, ids, values in zip(rows["kind"], rows["ids"], rows["rows"], strict=True):
        at = np.frombuffer(ids, "<i4")
        if kind == "follows":
            table["follows"][at] += np.frombuffer(values, "<i4")
        else:
            added = np.frombuffer(values, CONTEXT)
            for name in ("total", "n1", "n2", "n3"):
                table[name][at] += added[name]
    _write(folder, f"contexts-{block}", table)
    f = table["follows"]
    return pd.DataFrame({"block": [block], "n": [[*[int((f == k).sum()) for k in (1, 2, 3, 4)], int((f >= 3).sum()), int(f.sum(dtype=np.int64))]]})


def train(docs: DataFrame) -> Model:
    """Counts the model over all ``docs`` (text). Runs jobs."""
    spark = docs.sparkSession
    rows = docs.select(text_of().alias("text"))
    n, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    model = Model(shared_folder(spark, "language-model"), documents=n)
    if not n:
        return model
    folder, shards = model.folder, max(4, -(-(size or 0) // SHARD_BYTES))
    dealt = rows.mapInArrow(functools.partial(_count_words, shards), BLOBS).groupBy("shard")
    found = dealt.applyInPandas(lambda rows: _write_words(folder, rows), "shard int, size long, total long").collect()
    model.sizes, model.totals = [0] * shards, [0] * shards
    for r in found:
        model.sizes[r["shard"]], model.totals[r["shard"]] = r["size"], r["total"]
    words = model.words
    if words + 1 >= 1 << 32:
        raise ValueError("more words than ids")
    pairs = rows.mapInArrow(functools.partial(_count_bigrams, model, shards), BLOBS).groupBy("shard")
    sums = staged(pairs.applyInPandas(lambda rows: _write_bigrams(folder, rows), SUMS), "bigram-sums")
    model.bigrams, of_counts = [0] * shards, [0] * 4
    for r in sums.filter("kind = 'size'").select("shard", "size", "n").collect():
        model.bigrams[r["shard"]] = r["size"]
        of_counts = [a + b for a, b in zip(of_counts, r["n"], strict=True)]
    model.discounts = discounts(of_counts)
    blocks = sums.filter("block >= 0").groupBy("block").applyInPandas(lambda rows: _write_contexts(folder, words, rows), "block int, n array<long>")
    lower = [sum(x) for x in zip(*[r["n"] for r in blocks.collect()], strict=True)]
    model.lower_discounts, model.followers = discounts(lower[:4]), lower[5]
    d1, d2, d3 = model.lower_discounts
    model.lower_rest = (d1 * lower[0] + d2 * lower[1] + d3 * lower[4]) / max(1, model.followers)
    return model


def _score(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, tokens, bounds in _groups(batches):
        logs, counts = model.log_probabilities(tokens, bounds)
        base = np.log10((counts + 0.1) / (model.tokens + 0.1 * (model.words + 1)))
        parts = [np.add.reduceat(x, bounds[:-1]) if len(x) else x for x in (logs, base, (counts > 0).astype(np.int64))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(bounds)), pa.array(parts[2]), pa.array(parts[1]), pa.array(parts[0])],
            ["doc_id", "n_tokens", "n_known", "base_score", "score"],
        )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score and perplexity per row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    out = rows.mapInArrow(functools.partial(_score, model), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def score_held_out(docs: DataFrame, folds: int = 10) -> DataFrame:
    """Scores all ``docs`` by a model of those outside fold 0."""
    held = fold(F.col("doc_id"), folds) == 0
    model = train(docs.filter(~held))
    return score(docs, model).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity"
    )
