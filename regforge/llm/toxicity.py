"""Toxicity scores of whole texts, after noisy-channel deobfuscation.

Every suspicious run of characters (a mark beside a letter, letters set apart, a separator
inside, letters doubled) becomes a lattice: each character may stand for itself, for letters it imitates,
for nothing if it only repeats or separates. Viterbi search under a character trigram
model, counted over all documents, and channel costs finds the likeliest readings. Other
runs have a single path, themselves, and need no search. The restored words and their
first 4 to 6 letters are the features.

Features are counted over the labelled rows in Spark. Starting from the ``CANDIDATES`` most
significant ones, those are taken one after another that explain the most toxic
documents not yet explained; a text's score is the noisy-or of the precisions of the
features it holds. At most ``MAX_LABELS`` labelled rows are used, chosen by hash.

Null and empty texts get the score of a text without any feature. Without toxic labels
all scores are 0. Repeated ids get one label, the highest. Other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regforge.llm.common import fold, text_of

MAX_LABELS = 200_000
CANDIDATES = 6_000
MAX_FEATURES = 300
LEAST_GAIN = 18.0
PREFIXES = (4, 5, 6)
READINGS = 3

#: Characters and the letters they imitate.
IMITATES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
_MARKS = re.escape("".join(IMITATES))
_SEPARATORS = " ._*~-"
_LETTER = r"[^\W\d_]"
_WORD = re.compile(rf"{_LETTER}+")
#: Letters or marks, each set apart from the next by one separator.
_APART = re.compile(rf"(?<![^\W_])(?:[^\W_]|[{_MARKS}])(?:[{re.escape(_SEPARATORS)}](?:[^\W_]|[{_MARKS}])){{2,}}(?![^\W_])")
_INNER = re.escape(_SEPARATORS[1:])
#: A letter doubled, a mark beside a letter, separators between a letter and a letter or mark.
_ODD = re.compile(
    rf"({_LETTER})\1|[{_MARKS}]{_LETTER}|{_LETTER}[{_MARKS}]|{_LETTER}[{_INNER}]+(?:{_LETTER}|[{_MARKS}])|[{_MARKS}][{_INNER}]+{_LETTER}"
)
#: Signs around a run that are no marks.
_AROUND = ".,;:?\"'`)[]{}<>“”„‘’«»…"
#: Longer runs are read in pieces that overlap.
PIECE, STEP = 64, 40
_TRAILING = re.compile(r"([^\w\s])\1+$|[.,;:?]+$")

ALPHABET = 64
_CODES = np.ones(0x10000, np.uint8)
_CODES[[0x20, *range(9, 14)]] = 0
for _i in range(26):
    _CODES[97 + _i] = _CODES[65 + _i] = 2 + _i
for _i, _c in enumerate(range(0xDF, 0x100)):
    _CODES[_c] = 28 + _i
    if _c not in (0xDF, 0xF7, 0xFF):
        _CODES[_c - 32] = 28 + _i


#: Kinds of characters: 1 blank, 2 other separator, 4 letter, 8 mark.
_KINDS = np.zeros(0x10000, np.uint8)
_KINDS[[i for i in range(0x10000) if chr(i).isspace()]] = 1
_KINDS[[ord(c) for c in _SEPARATORS[1:]]] = 2
_KINDS[[i for i in range(0x10000) if not 0xD800 <= i < 0xE000 and chr(i).isalpha()]] = 4
_KINDS[[ord(c) for c in IMITATES]] = 8


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return _CODES[np.minimum(points, 0xFFFF)].astype(np.int32)


def _count_characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(ALPHABET**3, np.int64)
    for batch in batches:
        group, size = [], 0
        texts = batch.column("text")
        for i, value in enumerate(texts):
            text = value.as_py()
            for at in range(0, len(text), 1 << 20):
                group.append(text[max(0, at - 2) : at + (1 << 20)] if at else text[: 1 << 20])
                size += len(group[-1])
            if size > 1 << 19 or i + 1 == len(texts):
                codes = _codes("\n\n".join(group) + "\n\n")
                total += np.bincount((codes[:-2] * ALPHABET + codes[1:-1]) * ALPHABET + codes[2:], minlength=ALPHABET**3)
                group, size = [], 0
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], ["gram", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Interpolated log-probabilities of character trigrams, an array of ``ALPHABET ** 3``.

    The counts of all documents are added up in Spark; the alphabet bounds what the driver
    receives.
    """
    counted = docs.select(text_of().alias("text")).mapInArrow(_count_characters, "gram int, n long")
    n = np.zeros(ALPHABET**3)
    for row in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        n[row["gram"]] = row["n"]
    n = n.reshape(ALPHABET, ALPHABET, ALPHABET)
    uni = (n.sum((0, 1)) + 1) / (n.sum() + ALPHABET)
    pair = n.sum(0)
    bi = (pair + 5 * uni) / (pair.sum(1, keepdims=True) + 5)
    return np.log((n + 5 * bi) / (n.sum(2, keepdims=True) + 5)).astype(np.float32)


def readings(run: str, model: np.ndarray, best: int = READINGS) -> list[str]:
    """The likeliest restorations of a run, by Viterbi search over its lattice.

    A state is the last two letters read; each keeps its ``best`` paths.
    """
    run = _TRAILING.sub("", run)
    flat = memoryview(np.ascontiguousarray(model).reshape(-1))
    states: dict[tuple[int, int], list[tuple[float, str]]] = {(0, 0): [(0.0, "")]}
    spaced = len(run) > 4 and all(c in _SEPARATORS for c in run[1::2])
    before = ""
    for ch in run:
        arcs: list[tuple[str, float]] = []
        if ch.isalpha():
            arcs.append((ch, 0.0))
            if ch == before:
                arcs.append(("", -1.0))
        elif ch in _SEPARATORS:
            arcs.append(("", -0.2))
            arcs.append((" ", -3.0 if spaced else -1.5))
        else:
            arcs.append((" ", -4.0))
            if ch == before:
                arcs.append(("", -1.0))
        arcs += [(c, -0.7) for c in IMITATES.get(ch, "")]
        coded = [(out, cost, int(_CODES[min(ord(out), 0xFFFF)]) if out else -1) for out, cost in arcs]
        after: dict[tuple[int, int], list[tuple[float, str]]] = {}
        for (u, v), paths in states.items():
            for out, cost, code in coded:
                state, gain = ((v, code), cost + flat[(u * ALPHABET + v) * ALPHABET + code]) if out else ((u, v), cost)
                after.setdefault(state, []).extend((score + gain, path + out) for score, path in paths)
        for s, paths in after.items():
            if len(paths) > 1:
                after[s] = [(c, p) for p, c in heapq.nlargest(best, {p: c for c, p in sorted(paths)}.items(), key=lambda x: x[1])]
        states = after
        before = ch
    ends = [(score + float(model[u, v, 0]), path) for (u, v), paths in states.items() for score, path in paths]
    return [path for _, path in heapq.nlargest(best, set(ends))]


def suspicious(text: str) -> set[str]:
    """The distinct runs of a text that may hide other letters, in pieces.

    A run between blanks is suspicious if, without repeated signs at its end, it has a mark
    beside a letter, a letter twice in a row, or a separator between letters; so are single
    letters that are set apart, also between quotes or before punctuation.
    """
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    if len(points) < 3:
        return set()
    kinds = _KINDS[np.minimum(points, 0xFFFF)]
    apart = (kinds & 3) > 0
    runs: set[str] = set()
    if len(points) >= 5 and (apart[1:-3] & ~apart[2:-2] & apart[3:-1] & ~apart[:-4] & ~apart[4:]).any():
        runs.update(m.group() for m in _APART.finditer(text))
    # A letter beside the same letter, a separator or a mark is needed in any case.
    left, right = kinds[:-1], kinds[1:]
    hits = ((left == 4) & (((right & 10) > 0) | (points[:-1] == points[1:]))) | ((right == 4) & ((left & 10) > 0))
    blanks = np.flatnonzero(kinds == 1)
    which = np.unique(np.searchsorted(blanks, np.flatnonzero(hits)))
    starts, ends = np.append(0, blanks + 1)[which].tolist(), np.append(blanks, len(points))[which].tolist()
    for token in {text[start:end] for start, end in zip(starts, ends, strict=True)}:
        run = _TRAILING.sub("", token.strip(_AROUND))
        if _ODD.search(run):
            runs.add(run)
    return {r[at : at + PIECE] for r in runs for at in range(0, max(1, len(r) - PIECE + STEP), STEP)}


def few_readings(run: str) -> tuple[str, ...] | None:
    """The readings of a run of letters with one letter doubled: with it and without. Both are
    among the likeliest ``READINGS``, so there is nothing to search. None for other runs."""
    if not run.isalpha():
        return None
    at = [i for i in range(1, len(run)) if run[i] == run[i - 1]]
    return (run, run[: at[0]] + run[at[0] + 1 :]) if len(at) == 1 else None


class Reader:
    """The words of texts, with the readings of earlier runs at hand."""

    def __init__(self, model: np.ndarray):
        self.read = functools.lru_cache(maxsize=20_000)(lambda run: tuple(readings(run, model)))

    def words(self, text: str) -> set[str]:
        """The words of the text and of its restored runs, lower-cased."""
        text = text.lower()
        words: set[str] = set()
        for token in {t.strip(".,;:!?") for t in set(text.split())}:
            if token.isalpha():
                words.add(token)
            else:
                words.update(_WORD.findall(token))
        for run in suspicious(text):
            for reading in few_readings(run) or self.read(run):
                words.update(_WORD.findall(reading))
        return words


def features(words: set[str]) -> set[str]:
    """Whole words as ``word$`` and beginnings of words."""
    out = {w + "$" for w in words}
    for k in PREFIXES:
        out.update({w[:k] for w in words if len(w) >= k})
    return out


def _count_features(model: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader, counts = Reader(model), (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        names = list(counts[0].keys() | counts[1].keys())
        out = pa.RecordBatch.from_pydict({"feature": names, "clean": [counts[0][f] for f in names], "toxic": [counts[1][f] for f in names]})
        for c in counts:
            c.clear()
        return out

    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
            counts[label].update(features(reader.words(text.as_py())))
            if len(counts[0]) + len(counts[1]) > 250_000:
                yield flush()
    yield flush()


def _held(model: np.ndarray, wanted: dict[str, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = Reader(model)
    for batch in batches:
        rows = [[wanted[f] for f in features(reader.words(t)) if f in wanted] for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_pydict({"held": pa.array(rows, pa.list_(pa.int32()))})


@dataclass
class ToxicityModel:
    """Character model, precision by feature, and the score of a text without features."""

    characters: np.ndarray
    precision: dict[str, float] = field(default_factory=dict)
    rest: float = 0.0

    def score(self, reader: Reader, text: str) -> float:
        words, clean = reader.words(text), 1.0 - self.rest
        found = {w + "$" for w in words} & self.precision.keys()
        for k in {len(f) for f in self.precision if f[-1] != "$"}:
            found |= {w[:k] for w in words if len(w) >= k} & self.precision.keys()
        for f in found:
            clean *= 1.0 - self.precision[f]
        return 1.0 - clean


def _gain(toxic: np.ndarray, clean: np.ndarray, all_toxic: float, all_clean: float) -> np.ndarray:
    """Log-likelihood ratio of a feature, 0 where it does not speak for toxicity."""
    n = np.maximum(toxic + clean, 1)
    rate, base = toxic / n, all_toxic / max(1.0, all_toxic + all_clean)
    part = lambda k, p: np.where(k > 0, k * np.log(np.maximum(p, 1e-300)), 0)
    value = 2 * (part(toxic, rate / base) + part(clean, (1 - rate) / (1 - base))) if 0 < base < 1 else np.zeros(len(n))
    return np.where(rate > base, value, 0)


def bounded_labels(labels: DataFrame, label: str, limit: int = MAX_LABELS) -> DataFrame:
    """(doc_id, label) of the labels outside the held-out fold; ``limit`` rows at most."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold(F.col("doc_id"), 4) != 2))
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELS) -> ToxicityModel:
    """Counts the character model over all ``docs`` and the features over labelled ones."""
    model = ToxicityModel(character_model(docs))
    # At most ``limit`` rows of two numbers, hence the hint.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(F.broadcast(bounded_labels(labels, "toxic", limit)), "doc_id")
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic:
        return model
    counted = rows.select("text", "label").mapInArrow(functools.partial(_count_features, model.characters), "feature string, clean long, toxic long")
    counted = counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter("toxic >= 2")
    rate, base = F.col("toxic") / (F.col("toxic") + F.col("clean")), n_toxic / (n_toxic + n_clean)
    gain = F.col("toxic") * F.log(rate / base) + F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - rate) / max(1e-9, 1 - base))).otherwise(0)
    top = counted.filter(rate > base).orderBy(gain.desc(), "feature").limit(CANDIDATES).collect()
    names = [r["feature"] for r in top]
    toxic, clean = np.array([r["toxic"] for r in top], float), np.array([r["clean"] for r in top], float)
    wanted = {f: i for i, f in enumerate(names)}
    held = rows.filter("label = 1").select("text").mapInArrow(functools.partial(_held, model.characters, wanted), "held array<int>")
    open_docs = [np.array(r["held"], int) for r in held.collect()]
    left, sure = toxic.copy(), _gain(toxic, clean, float(n_toxic), float(n_clean)) >= LEAST_GAIN
    for _ in range(MAX_FEATURES):
        # What it still explains decides the order, all it has explained decides whether it is taken.
        gains = np.where((left > 0) & sure, _gain(left, clean, float(n_toxic), float(n_clean)), 0)
        if not len(gains) or gains.max() <= 0:
            break
        best = int(gains.argmax())
        model.precision[names[best]] = float((toxic[best] + base) / (toxic[best] + clean[best] + 1))
        for doc in [d for d in open_docs if best in d]:
            left[doc] -= 1
        open_docs = [d for d in open_docs if best not in d]
    model.rest = min(0.25, len(open_docs) / max(1, len(open_docs) + n_clean))
    return model


def _score(model: ToxicityModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = Reader(model.characters)
    for batch in batches:
        texts = batch.column("__text")
        scores = [model.score(reader, t.as_py() or "") for t in texts]
        rest = [i for i, name in enumerate(batch.schema.names) if name != "__text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in rest], pa.array(scores, pa.float64())], [*[batch.schema.names[i] for i in rest], "__score"])


def scored(docs: DataFrame, model: ToxicityModel, text: Column | None = None) -> DataFrame:
    """``docs`` with ``__score``; all columns and rows stay."""
    rows = docs.withColumn("__text", text_of() if text is None else text)
    out = docs.withColumn("__score", F.lit(0.0)).schema
    return rows.mapInArrow(functools.partial(_score, model), out)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted per row."""
    found = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")), fit(docs, labels))
    return found.select(
        "doc_id",
        (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= threshold).cast("int").alias("predicted"),
    )
