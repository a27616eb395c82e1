"""Arrow text columns as flat byte arrays, and vectorised word / shingle fingerprints over them.

An Arrow string column already is one byte buffer plus offsets; every helper here works on that
pair, so a batch costs a few numpy passes whatever its number of documents. Null texts count as
empty. White space is ``[\\x20\\x09-\\x0D]`` and only A-Z are lower-cased.

Fingerprints are 64-bit: a word is a polynomial over random byte codes (mod 2**64) put through a
finaliser, a shingle is a mix of its words' fingerprints in order.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled by one numpy pass (a single longer document is one pass of its own).
PIECE = 2 << 20

_RNG = np.random.default_rng(20240229)
_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ORDER = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    col = batch.column(batch.schema.get_field_index(name))
    return col.fill_null("") if col.null_count else col


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array without nulls."""
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if wide else np.int32
    o = np.frombuffer(off, kind, len(col) + 1, col.offset * np.dtype(kind).itemsize).astype(np.int64)
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d[o[0]:o[-1]], o - o[0]


def pieces(col: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents of about ``limit`` bytes: (first row, end row, bytes, offsets)."""
    data, off = buffers(col)
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def tidy() -> None:
    """Give memory that earlier work of this Python process left free back to the system.

    A worker serves task after task and stage after stage, and its allocators keep what the largest of them used.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass                                                # another C library: it has no such call


class _Powers:
    """Powers of the base and of its inverse mod 2**64, grown on demand; those over ``keep`` are not held."""

    keep = PIECE + PIECE // 4

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) >= n:
            return self.up, self.down
        size = n if n > self.keep else min(max(n, 2 * len(self.up), 1 << 16), self.keep)
        found = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            found.append(np.multiply.accumulate(steps, out=steps))
        if size <= self.keep:
            self.up, self.down = found
        return found[0], found[1]


_POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums: the hash of [s, e) is ``(p[e] - p[s]) * down[s]``."""
    up, _ = _POWERS.get(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODE[data] * up[:len(data)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = _POWERS.get(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; a document's end always ends a word."""
    inside = ~_IS_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.concatenate((inside[1:], [False]))
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint per word, word offsets per document) of lower-cased text."""
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    data = lowered(data)
    starts, ends = word_spans(data, off)
    return span_hash(prefix_sums(data), starts, ends), np.searchsorted(starts, off)


def ngrams(word: np.ndarray, n: int) -> np.ndarray:
    """Fingerprint of the n words from each position (the caller masks document ends)."""
    m = max(0, len(word) - n + 1)
    h = np.full(m, n, np.uint64)
    for j in range(n):
        h += word[j:j + m] * _ORDER[j]
    return mix(h)


def shingles(data: np.ndarray, off: np.ndarray, n: int = 5) -> Iterator[np.ndarray]:
    """Per document the sorted distinct fingerprints of its n-word shingles.

    Fewer than n words: the whole sequence is one shingle; no words: an empty array.
    """
    word, woff = words(data, off)
    full = ngrams(word, n)
    for a, b in zip(woff[:-1].tolist(), woff[1:].tolist(), strict=True):
        if b - a >= n:
            s = np.sort(full[a:b - n + 1])
            yield s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif b > a:
            yield ngrams(word[a:b], b - a)
        else:
            yield full[:0]
