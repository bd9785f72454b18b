"""Language of words and texts: a linear-chain conditional random field.

A word's features are the byte n-grams of the word between two edge marks (those that touch
an edge are its prefixes and suffixes), hashed into a fixed number of buckets, and the word
itself if the lexicon has it. Learned transitions tie neighbouring words; forward-backward
gives every word the probability of each language, so text that switches languages is
labelled word by word. The language of a text is the one with the most probability over its
letters, and the score is its share.

Words are runs of letters (a-z and all bytes beyond ASCII) of the lower-cased text. Whole
texts are read; a chain ends after ``CHAIN`` words, longer texts are several chains, and
very long ones are read in pieces, so memory does not grow with a text.

Fitted on whole-text languages: at most ``MAX_LANGUAGES`` languages (the most frequent),
``DOCS_PER_LANGUAGE`` different texts of each, chosen by hash, and of each ``SPANS`` spans
of ``SPAN`` words spread over the whole text. The spans are spliced in random order into
sequences that switch languages, which is what the transitions are learned from. Repeated
rows count once. A NULL text, or one without a letter, is ``und`` with score 0; without any
learnable language every text is. NULL ids belong to the fold of the empty text; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regforge.llm.common import fold
from regforge.llm.tokens import mix

MAX_LANGUAGES, DOCS_PER_LANGUAGE = 200, 400
SPANS, SPAN, MAX_SPANS = 4, 24, 60_000
CHAIN = 128
ORDERS = (2, 3, 4, 5)
#: Weights in the whole model, and bytes of text times languages worked on at once.
WEIGHTS, CELLS = 1 << 20, 1 << 21
EPOCHS, BATCH, RATE, SHRINK = 4, 48, 0.25, 1e-4
UNDETERMINED = "und"

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[65:91] = True
_LETTER[128:] = True
_RANDOM = np.random.default_rng(19970117)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[~_LETTER] = 0x9E3779B97F4A7C15  # every other byte is an edge mark
_PLACE = _RANDOM.integers(1, 2**63, max(ORDERS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x5851F42D4C957F2D)


@dataclass
class Words:
    """The words of some texts: byte bounds, hashes, hashed n-grams by start place and order."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, data: bytes) -> Words:
        """``data`` has to begin and end with a byte that is no letter."""
        raw = np.frombuffer(data, np.uint8)
        edge = np.flatnonzero(np.diff(_LETTER[raw].view(np.int8)))
        return cls(raw, edge[::2] + 1, edge[1::2] + 1)

    def ngrams(self, buckets: int) -> Iterator[np.ndarray]:
        """Per order, the bucket of the n-gram at every place; ``buckets`` where there is none.

        An n-gram lies inside a word with its edge marks, so it belongs to the word that
        its place belongs to; the mark before a word is the word's own first place.
        """
        value, letter = _BYTE[self.raw], _LETTER[self.raw]
        inner = np.concatenate([[0], np.cumsum(~letter)])
        n, total = len(self.raw), value * _PLACE[0]
        for k in range(1, max(ORDERS)):
            with np.errstate(over="ignore"):
                total = total[:-1] + value[k:] * _PLACE[k] if len(total) > 1 else total[:0]
            if k + 1 not in ORDERS:
                continue
            size = n - k
            out = np.full(n, buckets, np.int64)
            if size > 0:
                # No mark strictly inside, and a letter somewhere.
                whole = inner[k : k + size] - inner[1 : 1 + size] == 0 if k > 1 else letter[:size] | letter[1:]
                found = (mix(total + _PLACE[k]) & np.uint64(buckets - 1)).astype(np.int64)
                out[:size] = np.where(whole, found, buckets)
            yield out

    def sums(self, rows: np.ndarray) -> np.ndarray:
        """Rows per place added up per word."""
        if not len(self.starts):
            return np.zeros((0, rows.shape[1]), rows.dtype)
        bounds = np.stack([self.starts - 1, self.ends], 1).ravel()
        return np.add.reduceat(rows, bounds, axis=0)[::2]

    def hashes(self) -> np.ndarray:
        """A hash per word, of all its bytes."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        at = np.arange(len(self.raw))
        with np.errstate(over="ignore"):
            place = np.zeros(len(self.raw), np.int64)
            place[self.starts] = self.starts
            np.maximum.accumulate(place, out=place)
            powers = _powers(int((self.ends - self.starts).max()) + 1)
            inside = np.where(_LETTER[self.raw], _BYTE[self.raw], np.uint64(0))
            spread = inside * powers[np.minimum(at - place, len(powers) - 1)]
            bounds = np.stack([self.starts, self.ends], 1).ravel()
            return mix(np.add.reduceat(spread, bounds)[::2])


def _powers(size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.full(size, _BASE, np.uint64))


@dataclass
class Field:
    """Weights per bucket and language (the last row: no n-gram), the lexicon as sorted
    hashes with weights (the last row: not in it), and transitions."""

    languages: list[str]
    weights: np.ndarray
    lexicon: np.ndarray
    entries: np.ndarray
    initial: np.ndarray
    moves: np.ndarray

    @property
    def buckets(self) -> int:
        return len(self.weights) - 1

    def entry(self, words: Words) -> np.ndarray:
        """The place of every word in the lexicon, or behind its end."""
        found = words.hashes()
        at = np.searchsorted(self.lexicon, found)
        known = (at < len(self.lexicon)) & (self.lexicon[np.minimum(at, max(0, len(self.lexicon) - 1))] == found) if len(self.lexicon) else np.zeros(len(found), bool)
        return np.where(known, at, len(self.lexicon))

    def evidence(self, words: Words) -> np.ndarray:
        """Per word and language, the sum of the weights of its features."""
        total = np.zeros((len(words.raw), len(self.languages)), np.float32)
        for grams in words.ngrams(self.buckets):
            total += self.weights[grams]
        return words.sums(total) + self.entries[self.entry(words)]


def chains_of(counts: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and lengths of the chains of texts with so many words, longest first."""
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    per_text = -(-counts // longest)
    text = np.repeat(np.arange(len(counts)), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    start = first[text] + number * longest
    length = np.minimum(longest, counts[text] - number * longest)
    order = np.argsort(-length, kind="stable")
    return start[order], length[order]


def forward_backward(evidence: np.ndarray, start: np.ndarray, length: np.ndarray, initial: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word the probability of each language, with the expected first languages and moves.

    All chains go on by one word at a time; they come longest first, so those still running
    are the leading ones.
    """
    if not len(start):
        return np.zeros_like(evidence, np.float64), np.zeros(len(initial)), np.zeros(moves.shape)
    local = np.exp((evidence - evidence.max(1, keepdims=True)).astype(np.float64))
    first, step = np.exp(initial - initial.max()), np.exp(moves - moves.max())
    running = np.searchsorted(-length, -np.arange(length[0]), side="left")
    forward, marginal = np.empty_like(local), np.empty_like(local)
    now = first * local[start]
    for t, n in enumerate(running):
        at = start[:n] + t
        if t:
            now = (now[:n] @ step) * local[at]
        now /= now.sum(1, keepdims=True)
        forward[at] = now
    back, moved = np.ones((len(start), len(initial))), np.zeros(moves.shape)
    for t in range(len(running) - 1, -1, -1):
        at, n = start[: running[t]] + t, running[t]
        if t + 1 < len(running):
            ahead = start[: running[t + 1]] + t + 1
            part = local[ahead] * back[: running[t + 1]]
            pair = forward[at[: running[t + 1]]]
            scale = np.einsum("ni,ij,nj->n", pair, step, part)
            moved += step * np.einsum("ni,nj->ij", pair / scale[:, None], part)
            part = part @ step.T
            back[: running[t + 1]] = part / part.sum(1, keepdims=True)
        found = forward[at] * back[:n]
        marginal[at] = found / found.sum(1, keepdims=True)
    return marginal, marginal[start].sum(0), moved


def _spliced(spans: list[tuple[int, bytes]], rng: np.random.Generator) -> list[tuple[bytes, np.ndarray]]:
    """Spans in random order, cut to random lengths, joined to sequences of about ``CHAIN`` words."""
    out, parts, labels = [], [], []
    for at in rng.permutation(len(spans)):
        label, text = spans[at]
        words = text.split(b" ")
        words = words[: int(rng.integers(4, SPAN + 1))]
        parts += words
        labels += [label] * len(words)
        if len(parts) >= CHAIN:
            out.append((b" " + b" ".join(parts[:CHAIN]) + b" ", np.array(labels[:CHAIN])))
            parts, labels = [], []
    if parts:
        out.append((b" " + b" ".join(parts) + b" ", np.array(labels)))
    return out


def fit_field(languages: list[str], spans: list[tuple[int, bytes]], seed: int = 7) -> Field:
    """Gradient steps on the log-likelihood of spliced sequences, each weight at its own rate."""
    size = len(languages)
    buckets = 1 << int(np.log2(max(2, WEIGHTS // max(1, size))))
    rng = np.random.default_rng(seed)
    every = Words.of(b" " + b" ".join(text for _, text in spans) + b" ")
    hashes, seen = np.unique(every.hashes(), return_counts=True)
    lexicon = hashes[seen > 1]
    model = Field(languages, np.zeros((buckets + 1, size), np.float32), lexicon, np.zeros((len(lexicon) + 1, size), np.float32), np.zeros(size), np.zeros((size, size)))
    if size < 2:
        return model
    slopes = [np.full_like(x, 1e-6) for x in (model.weights, model.entries, model.initial, model.moves)]

    def climb(which: int, target: np.ndarray, gradient: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        gradient = gradient - SHRINK * target[rows]
        slopes[which][rows] += gradient**2
        target[rows] += RATE * gradient / np.sqrt(slopes[which][rows])

    for _ in range(EPOCHS):
        sequences = _spliced(spans, rng)
        for begin in range(0, len(sequences), BATCH):
            part = sequences[begin : begin + BATCH]
            words = Words.of(b"".join(text for text, _ in part))
            truth = np.concatenate([labels for _, labels in part])
            start, length = chains_of(np.array([len(labels) for _, labels in part]), CHAIN)
            evidence = model.evidence(words)
            marginal, firsts, moved = forward_backward(evidence, start, length, model.initial, model.moves)
            goal = np.zeros_like(marginal)
            goal[np.arange(len(truth)), truth] = 1
            wrong = ((goal - marginal) / len(part)).astype(np.float32)
            follows = np.ones(len(truth), bool)
            follows[start] = False
            after = np.flatnonzero(follows)
            wanted = np.zeros((size, size))
            np.add.at(wanted, (truth[after - 1], truth[after]), 1)
            climb(2, model.initial, (goal[start].sum(0) - firsts) / len(part))
            climb(3, model.moves, (wanted - moved) / len(part))
            place = np.full(len(words.raw), len(truth), np.int64)
            lengths = words.ends - words.starts + 1
            place[np.repeat(words.starts - 1, lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = np.repeat(np.arange(len(truth)), lengths)
            grams, owners = np.concatenate(list(words.ngrams(buckets))), np.tile(place, len(ORDERS))
            real = grams < buckets
            for which, target, ids, owner in ((0, model.weights, grams[real], owners[real]), (1, model.entries, *_known(model, words))):
                rows, at = np.unique(ids, return_inverse=True)
                if len(rows):
                    gradient = np.stack([np.bincount(at, wrong[owner, k], len(rows)) for k in range(size)], 1).astype(np.float32)
                    climb(which, target, gradient, rows)
    return model


def _known(model: Field, words: Words) -> tuple[np.ndarray, np.ndarray]:
    entry = model.entry(words)
    owner = np.flatnonzero(entry < len(model.lexicon))
    return entry[owner], owner


def _pieces(text: bytes, size: int) -> list[bytes]:
    """Cut where a word ends."""
    out, at = [], 0
    while at < len(text):
        end = at + size
        while end < len(text) and _LETTER[text[end]]:
            end += 1
        out.append(text[at:end])
        at = end
    return out


def _grouped(texts: list[bytes], size: int) -> Iterator[tuple[np.ndarray, bytes, np.ndarray]]:
    """(which texts, their bytes behind one another, ends): short texts together, pieces of a long one alone."""
    group: list[int] = []

    def joined() -> tuple[np.ndarray, bytes, np.ndarray]:
        data = b" " + b"".join(texts[i] + b" " for i in group)
        return np.array(group), data, np.cumsum([len(texts[i]) + 1 for i in group]) + 1

    room = 0
    for i, text in enumerate(texts):
        if len(text) > size:
            for piece in _pieces(text, size):
                yield np.array([i]), b" " + piece + b" ", np.array([len(piece) + 2])
            continue
        if room + len(text) > size and group:
            yield joined()
            group, room = [], 0
        group.append(i)
        room += len(text) + 1
    if group:
        yield joined()


def read_texts(model: Field, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, Words, np.ndarray]]:
    """Per group of texts: which texts, the text of every word, the words, their probabilities."""
    size = max(1 << 12, CELLS // max(1, len(model.languages)))
    for which, data, ends in _grouped(texts, size):
        words = Words.of(data)
        at = np.searchsorted(ends, words.starts, side="right")
        counts = np.bincount(at, minlength=len(which))
        start, length = chains_of(counts, CHAIN)
        marginal, _, _ = forward_backward(model.evidence(words), start, length, model.initial, model.moves)
        yield which, at, words, marginal


def text_languages(model: Field, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
    """The language with the most probability over the letters of each text, and its share."""
    total = np.zeros((len(texts), len(model.languages)))
    for which, at, words, marginal in read_texts(model, texts):
        weight = (words.ends - words.starts).astype(float)
        for k in range(len(model.languages)):
            total[which, k] += np.bincount(at, weight * marginal[:, k], len(which))
    mass, best = total.sum(1), total.argmax(1)
    share = total[np.arange(len(texts)), best] / np.maximum(mass, 1e-300)
    return [model.languages[b] if m > 0 else UNDETERMINED for b, m in zip(best, mass, strict=True)], np.where(mass > 0, np.minimum(share, 1.0), 0.0)


def text_spans(model: Field, texts: list[bytes]) -> list[list[dict]]:
    """Runs of words of one language: language, first_word, words, probability (the mean)."""
    out: list[list[dict]] = [[] for _ in texts]
    for which, at, _, marginal in read_texts(model, texts):
        best = marginal.argmax(1)
        edge = np.flatnonzero(np.diff(best, prepend=-1) | np.diff(at, prepend=-1))
        for a, b in zip(edge, [*edge[1:], len(best)], strict=True):
            runs = out[which[at[a]]]
            first = runs[-1]["first_word"] + runs[-1]["words"] if runs else 0
            chance = float(marginal[a:b, best[a]].mean())
            if runs and runs[-1]["language"] == model.languages[best[a]]:
                old = runs[-1]
                old["probability"] = (old["probability"] * old["words"] + chance * int(b - a)) / (old["words"] + int(b - a))
                old["words"] += int(b - a)
            else:
                runs.append({"language": model.languages[best[a]], "first_word": int(first), "words": int(b - a), "probability": chance})
    return out


def _some_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, texts = [], []
        for name, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            data = b" " + text.encode("utf-8", "replace") + b" "
            words = Words.of(data)
            n = len(words.starts)
            for first in sorted({i * max(0, n - SPAN) // max(1, SPANS - 1) for i in range(SPANS)}) if n else ():
                part = slice(first, first + SPAN)
                lang.append(name)
                texts.append(b" ".join(data[a:b] for a, b in zip(words.starts[part], words.ends[part], strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(texts, pa.binary())], ["lang", "span"])


def fit(docs: DataFrame, languages: int = MAX_LANGUAGES, per_language: int = DOCS_PER_LANGUAGE) -> Field:
    """Learns from the documents outside the held-out fold that have a language and a letter."""
    text = F.lower(F.col("text").cast("string"))
    known = docs.select(F.col("lang").cast("string").alias("lang"), text.alias("text"), F.col("doc_id").alias("doc_id"))
    known = known.filter(F.col("lang").isNotNull() & (fold(F.col("doc_id"), 4) != 2) & F.col("text").rlike(r"\p{L}"))
    known = known.select("lang", "text", F.xxhash64("lang", "text", "doc_id").alias("h"))
    names = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).select("lang")
    each = Window.partitionBy("lang").orderBy("h")
    # At most languages x per_language rows of a name and a number, hence the hint.
    chosen = known.select("lang", "h").join(F.broadcast(names), "lang").distinct().withColumn("n", F.row_number().over(each)).filter(F.col("n") <= per_language).drop("n")
    texts = known.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.max("text").alias("text"))
    found = sorted((r["lang"], bytes(r["span"])) for r in texts.select("lang", "text").mapInArrow(_some_spans, "lang string, span binary").collect())
    held = sorted({lang for lang, _ in found})
    rng = np.random.default_rng(3)
    if len(found) > MAX_SPANS:
        found = [found[i] for i in np.sort(rng.choice(len(found), MAX_SPANS, replace=False))]
    return fit_field(held, [(held.index(lang), span) for lang, span in found])


def _bytes(texts: pa.Array) -> list[bytes]:
    return [b"" if t is None else t.encode("utf-8", "replace") for t in texts.to_pylist()]


def _lowered(text: Column) -> Column:
    """The text in lower case, NULL without a letter."""
    return F.when(text.rlike(r"\p{L}"), F.lower(text))


def language_of(model: Field, text: Column) -> Column:
    """A struct of lang_pred and score for a text column."""

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        if not model.languages:
            names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        else:
            names, scores = text_languages(model, _bytes(texts))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return predict(_lowered(text.cast("string")))


def spans_of(model: Field, text: Column) -> Column:
    """The runs of words of one language, as an array of structs."""
    kind = pa.list_(pa.struct([("language", pa.string()), ("first_word", pa.int64()), ("words", pa.int64()), ("probability", pa.float64())]))

    @F.arrow_udf("array<struct<language:string,first_word:bigint,words:bigint,probability:double>>")
    def split(texts: pa.Array) -> pa.Array:
        return pa.array(text_spans(model, _bytes(texts)) if model.languages else [[]] * len(texts), kind)

    return split(_lowered(text.cast("string")))


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score per row."""
    model = fit(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), language_of(model, F.col("text")).alias("found"))
    return rows.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "found.lang_pred", "found.score")
