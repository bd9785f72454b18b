"""Hashes of the words of whole texts, many texts at a time, with NumPy.

Words are runs of bytes other than blanks, A-Z lower-cased. A word's hash is a polynomial
over random 64-bit values of its bytes, taken from prefix sums, so no word becomes a
Python object. Work goes in pieces of about ``PIECE`` bytes that end at blanks, so memory
does not grow with the length of a text (other than its hashes).
"""

from __future__ import annotations

import functools

import numpy as np

PIECE = 1 << 18
_BLANKS = np.zeros(256, bool)
_BLANKS[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE = _BYTE[_LOWER]
_VALUE[_BLANKS] = 0
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEQUENCE = _RANDOM.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every bit over the word."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words of ``data``."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    blank = _BLANKS[raw]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    edge = np.concatenate([[0] if not blank[0] else [], edge, [len(raw)] if not blank[-1] else []]).astype(np.int64)
    starts, ends = edge[::2], edge[1::2]
    room = 1 << max(18, (len(raw) + 1).bit_length())
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_VALUE[raw] * _powers(_BASE, room)[: len(raw)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * _powers(_INVERSE, room)[starts]), starts


def _pieces(text: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and not _BLANKS[text[end]]:
            end += 1
        out.append(text[at:end])
        at = end
    return out


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and bounds: text i has hashes ``[bounds[i], bounds[i + 1])``."""
    parts, counts, i = [], np.zeros(len(texts), np.int64), 0
    while i < len(texts):
        if len(texts[i]) > PIECE:
            for piece in _pieces(texts[i]):
                found, _ = _words(piece)
                parts.append(found)
                counts[i] += len(found)
            i += 1
            continue
        first, size = i, 0
        while i < len(texts) and size + len(texts[i]) <= PIECE:
            size += len(texts[i]) + 1
            i += 1
        group = texts[first:i]
        found, starts = _words(b"\n".join(group))
        ends = np.cumsum([len(t) + 1 for t in group])
        counts[first:i] = np.diff(np.searchsorted(starts, ends), prepend=0)
        parts.append(found)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.concatenate([[0], np.cumsum(counts)])


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; a shorter text is one run."""
    if not len(words):
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        if len(words) < size:
            return mix(np.array([(words * _SEQUENCE[: len(words)]).sum() + np.uint64(len(words))], np.uint64))
        total = np.zeros(len(words) - size + 1, np.uint64)
        for k in range(size):
            total += words[k : len(words) - size + 1 + k] * _SEQUENCE[k]
    return np.unique(mix(total))
