"""Vectorised word and shingle hashing over Arrow string batches (numpy).

A word is a maximal run of digits, ASCII letters and non-ASCII characters;
ASCII capitals are folded to small letters.  All work is on the UTF-8 bytes of
a batch at once: byte-class table, run boundaries, and a polynomial hash of
every run from one cumulative sum (arithmetic modulo 2**64).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True
#: A fixed odd 64-bit value for every byte, so that sums of powers mix well.
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INV = U64(pow(int(_BASE), -1, 2**64))
#: Multipliers that combine the consecutive words of a shingle.
_STEP = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) * U64(2) + U64(1)

#: Bytes of text handled at a time; numpy temporaries take about 60 times that.
SLICE_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the 64 output bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, out=out)


@dataclass
class Words:
    """Words of a run of rows: word ``i`` is in row ``row[i]``; ``first[r]``
    to ``first[r + 1]`` are the words of row ``r``."""

    data: np.ndarray  # folded bytes
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray
    offsets: np.ndarray  # byte offsets of rows
    _sums: np.ndarray | None = None
    _inv: np.ndarray | None = None

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of the byte spans [start, end)."""
        if self._sums is None:
            n = len(self.data)
            self._sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_BYTE[self.data] * powers(_BASE, n), out=self._sums[1:])
            self._inv = powers(_BASE_INV, n + 1)
        h = (self._sums[end] - self._sums[start]) * self._inv[start]
        return mix(h + (end - start).astype(np.uint64) * _STEP[0])

    def hashes(self) -> np.ndarray:
        return self.spans(self.start, self.end)

    def prefixes(self, n: int) -> np.ndarray:
        """Hash of the first ``n`` bytes of each word (whole when shorter)."""
        return self.spans(self.start, np.minimum(self.end, self.start + n))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of a string array; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, dtype=np.int64, count=len(texts) + 1, offset=texts.offset * 8)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (or one row), so that memory is
    bounded by the longest text, not by the batch."""
    _, off = buffers(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        yield lo, hi
        lo = hi


def words(texts: pa.Array) -> Words:
    raw, off = buffers(texts)
    data = _LOWER[raw]
    inside = _IS_WORD[raw]
    n = len(raw)
    edge = np.zeros(n + 1, dtype=bool)  # a word starts here
    stop = np.zeros(n + 1, dtype=bool)  # a word ends before here
    if n:
        edge[0], edge[1:n] = inside[0], inside[1:] & ~inside[:-1]
        stop[1:n], stop[n] = inside[:-1] & ~inside[1:], inside[-1]
        cut = off[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        cut = cut[inside[cut] & inside[cut - 1]]  # two rows' words touch
        edge[cut] = stop[cut] = True
    start, end = np.flatnonzero(edge), np.flatnonzero(stop)
    first = np.searchsorted(start, off, side="left")
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    return Words(data, start, end, row, first, off)


def shingles(w: Words, size: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its ``size``-word shingles; a row
    of fewer words, but not none, has one shingle of all its words."""
    h = w.hashes()
    n = len(h)
    grams = np.zeros(max(0, n - size + 1), dtype=np.uint64)
    for j in range(size):
        grams += h[j:n - size + 1 + j] * _STEP[j + 1]
    grams = mix(grams)
    out = []
    for lo, hi in zip(w.first[:-1], w.first[1:]):
        if hi - lo >= size:
            out.append(np.unique(grams[lo:hi - size + 1]))
        elif hi > lo:
            own = h[lo:hi]
            out.append(mix(np.array([(own * _STEP[1:1 + len(own)]).sum(dtype=np.uint64) + U64(hi - lo)])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
