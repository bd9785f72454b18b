"""Quality classifier: a generalised additive model with pairwise interactions.

Whole texts become a few shape features. Each feature has a lookup table over its bins;
cyclic boosting adds a shallow tree of one feature after the other, over and over, with a
small step. Then the pairs of features that explain most of what is left get tables over
coarse bins, boosted the same way. A score is the logistic of a sum of table entries, found
for a batch with one addition per table.

The tables are fitted on the features of at most ``MAX_LABELS`` labelled rows, chosen by
hash; scoring reads every text in full. Null and empty texts have all features 0 and are
scored like any other. Without labels of both kinds every score is the share of label 1,
or 0.5 without labels. Repeated ids get one label, the highest; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regforge.llm.common import fold, text_of

MAX_LABELS = 40_000
BINS, COARSE = 32, 8
ROUNDS, STEP, PAIRS, PAIR_ROUNDS = 150, 0.15, 6, 40
LEAST_LEAF, SHRINK = 5.0, 1.0
FEATURES = (
    "words", "word_length", "long_word", "capitals", "digits", "exclamations", "bars", "symbols", "stops",
    "line_words", "same_lines", "different_words", "same_neighbours", "top_word", "top_line", "shouted_words",
)

_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[ord("!"), ord("?")]] = 3
_CLASS[ord("|")] = 4
_CLASS[[ord(c) for c in "#$%&*@^~_=+<>{}[]\\/"]] = 5
_CLASS[[ord(c) for c in ".,;:"]] = 6
_CLASS[97:123] = 7
_CLASS[0xC3] = 7


def features(text: str) -> list[float]:
    """The shape of a text: one number per name in ``FEATURES``."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = np.bincount(_CLASS[raw], minlength=8) / len(raw)
    n, counts = len(words), Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    repeated = Counter(lines)
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        float(np.log1p(max(map(len, counts)))),
        *kinds[1:7].tolist(),
        float(np.log1p(n / max(1, len(lines)))),
        1 - len(repeated) / max(1, len(lines)),
        len(counts) / n**0.75,
        sum(map(str.__eq__, words, words[1:])) / n,
        max(counts.values()) / n,
        max(repeated.values(), default=0) / max(1, len(lines)),
        sum(c for w, c in counts.items() if w.isupper() and len(w) > 1) / n,
    ]


def _all_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t or "") for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.list_(pa.float64()))], ["label", "features"])


def _tree(gradient: np.ndarray, weight: np.ndarray, depth: int) -> np.ndarray:
    """Leaf values per bin of a tree over ordered bins that halves the loss greedily."""
    value = gradient.sum() / (weight.sum() + SHRINK)
    if depth == 0 or len(gradient) < 2:
        return np.full(len(gradient), value)
    g, w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    rest_g, rest_w = gradient.sum() - g, weight.sum() - w
    gain = np.where((w >= LEAST_LEAF * 0.1) & (rest_w >= LEAST_LEAF * 0.1), g**2 / (w + SHRINK) + rest_g**2 / (rest_w + SHRINK), -1)
    cut = int(gain.argmax())
    if gain[cut] <= gradient.sum() ** 2 / (weight.sum() + SHRINK):
        return np.full(len(gradient), value)
    cut += 1
    return np.concatenate([_tree(gradient[:cut], weight[:cut], depth - 1), _tree(gradient[cut:], weight[cut:], depth - 1)])


@dataclass
class AdditiveModel:
    """Bin edges, tables by feature, and tables by pair of features over coarse bins."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: np.ndarray = field(default_factory=lambda: np.zeros((0, BINS)))
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, rows[:, i], side="right") for i, e in enumerate(self.edges)])

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        if self.edges:
            bins = self.bins(rows)
            for table, at in zip(self.tables, bins, strict=True):
                total += table[at]
            coarse = bins * COARSE // BINS
            for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
                total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit_tables(rows: np.ndarray, labels: np.ndarray) -> AdditiveModel:
    """Fits the model to features and 0/1 labels."""
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if len(np.unique(labels)) < 2:
        return model
    model.edges = [np.unique(np.quantile(rows[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(rows.shape[1])]
    model.tables = np.zeros((rows.shape[1], BINS))
    bins, total = model.bins(rows), np.full(len(labels), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i, at in enumerate(bins):
            g, w = slopes()
            step = STEP * _tree(np.bincount(at, g, BINS), np.bincount(at, w, BINS), 2)
            model.tables[i] += step
            total += step[at]
    coarse = bins * COARSE // BINS
    g, w = slopes()
    gains = {}
    for a in range(len(bins)):
        for b in range(a):
            cell = coarse[a] * COARSE + coarse[b]
            gains[a, b] = (np.bincount(cell, g, COARSE**2) ** 2 / (np.bincount(cell, w, COARSE**2) + SHRINK)).sum()
    model.pairs = sorted(gains, key=gains.get, reverse=True)[:PAIRS]
    model.pair_tables = [np.zeros((COARSE, COARSE)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            g, w = slopes()
            cell = coarse[a] * COARSE + coarse[b]
            hg, hw = (np.bincount(cell, x, COARSE**2).reshape(COARSE, COARSE) for x in (g, w))
            # A tree over the first feature; in each of its leaves one over the second.
            first, step = _tree(hg.sum(1), hw.sum(1), 1), np.zeros((COARSE, COARSE))
            for leaf in np.unique(first):
                part = first == leaf
                step[part] = STEP * _tree(hg[part].sum(0), hw[part].sum(0), 1)
            table += step
            total += step[coarse[a], coarse[b]]
    return model


def bounded_labels(labels: DataFrame, limit: int = MAX_LABELS) -> DataFrame:
    """(doc_id, label) outside the held-out fold; ``limit`` rows at most, by hash."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold(F.col("doc_id"), 4) != 2))
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality").cast("int")).alias("label"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELS) -> AdditiveModel:
    # At most ``limit`` rows of two numbers, hence the hint.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(F.broadcast(bounded_labels(labels, limit)), "doc_id")
    found = rows.select("label", "text").mapInArrow(_all_features, "label int, features array<double>").collect()
    found = sorted((tuple(r["features"]), r["label"]) for r in found)
    if not found:
        return AdditiveModel()
    return fit_tables(np.array([f for f, _ in found]), np.array([y for _, y in found], float))


def quality_score(model: AdditiveModel, text: Column) -> Column:
    """The score of a text column."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        rows = np.array([features(t or "") for t in texts.to_pylist()]).reshape(-1, len(FEATURES))
        return pa.array(model.scores(rows))

    return score(text)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted per row."""
    model = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), quality_score(model, text_of()).alias("score"))
    return rows.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
