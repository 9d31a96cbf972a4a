"""Vectorised word handling for Arrow batches (used inside Spark tasks).

Texts stay in their Arrow buffers: word boundaries, word hashes and n-gram hashes
are computed for a whole slice of documents with a few numpy passes, never word by
word.  A word is a maximal run of bytes other than space and 0x09-0x0D.

Hashes are 64-bit.  A word hash is a polynomial over a random value per byte
(``sum T[b_i] * P^i`` modulo 2^64, taken from one prefix sum per slice), passed
through a finalising mixer; n-gram hashes are polynomials over word hashes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text handled at once: bounds the work arrays of a task (a single
#: longer text forms a slice of its own).
SLICE_BYTES = 2 << 20

_P = 0x9E3779B97F4A7C15 | 1
_Q = 0xD6E8FEB86659FD93 | 1
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20240131).integers(1, 2**64, 256, dtype=U64)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32
_BYTE_FOLDED = _BYTE[_FOLD]


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(1 << 16, 1 << (n - 1).bit_length())
            self.up, self.down = (self._row(b, size) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _row(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=U64)
        out[0] = 1
        return np.multiply.accumulate(out)


_BYTE_POWERS, _WORD_POWERS = _Powers(_P), _Powers(_Q)


def give_back() -> None:
    """Return memory that finished work has freed to the system.

    Python workers outlive tasks and stages, and the C library keeps what they free: without
    this each holds the most that any stage before needed.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


def giving_back(work: Callable, tables: int = 1) -> Callable:
    """A function of one or two Arrow tables that gives back its memory after each call."""
    def one(t):
        out = work(t)
        give_back()
        return out

    def two(t, u):
        out = work(t, u)
        give_back()
        return out

    return one if tables == 1 else two


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective finaliser of 64-bit values (xor-shift-multiply)."""
    x = x ^ U64(seed & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def seed_of(*parts: int) -> int:
    """A 64-bit seed from small integers."""
    s = 0x243F6A8885A308D3
    for p in parts:
        s = int(mix64(np.array([s ^ (int(p) & 0xFFFFFFFFFFFFFFFF)], dtype=U64), 0x9E37)[0])
    return s


@dataclass
class TextSlice:
    """Rows ``lo .. hi-1`` of an Arrow batch with the bytes of their texts."""

    lo: int
    hi: int
    data: np.ndarray      # uint8, the texts one after another
    offsets: np.ndarray   # int64, len = rows + 1, into data

    @property
    def rows(self) -> int:
        return self.hi - self.lo


def slices(column: pa.Array | pa.ChunkedArray, max_bytes: int = SLICE_BYTES) -> Iterator[TextSlice]:
    """Slices of a text column; null texts have no bytes."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    base = 0
    for arr in chunks:
        arr = arr.cast(pa.large_binary())
        if arr.null_count:
            arr = arr.fill_null(b"")
        n = len(arr)
        if n:
            bufs = arr.buffers()
            off = np.frombuffer(bufs[1], dtype=np.int64)[arr.offset:arr.offset + n + 1]
            raw = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
            lo = 0
            while lo < n:
                hi = int(np.searchsorted(off, off[lo] + max_bytes, side="right")) - 1
                hi = min(n, max(hi, lo + 1))
                yield TextSlice(base + lo, base + hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                lo = hi
        base += n


@dataclass
class Words:
    """Word spans of a slice: byte positions, and the first word of each row."""

    start: np.ndarray     # int64 byte position of each word
    end: np.ndarray       # int64 byte position after each word
    first: np.ndarray     # int64, len = rows + 1: words of row r are first[r] .. first[r+1]-1

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(s: TextSlice) -> Words:
    n = len(s.data)
    if n == 0:
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(s.rows + 1, np.int64))
    inside = ~_IS_SPACE[s.data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[s.offsets] = True                      # a new text begins: words never cross it
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = False, inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(start, end, np.searchsorted(start, s.offsets))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit hashes of byte spans; ``fold`` reads A-Z as a-z."""
    if not len(start):
        return np.zeros(0, dtype=U64)
    up, down = _BYTE_POWERS.get(len(data) + 1)
    prefix = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum((_BYTE_FOLDED if fold else _BYTE)[data] * up[:-1], out=prefix[1:])
    return mix64((prefix[end] - prefix[start]) * down[start])


def word_hashes(s: TextSlice, w: Words, fold: bool = False) -> np.ndarray:
    """64-bit hash of every word; ``fold`` reads A-Z as a-z."""
    return span_hashes(s.data, w.start, w.end, fold)


def ngram_hashes(h: np.ndarray, first: np.ndarray, n: int, seed: int = 0,
                 whole_if_short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows, row by row, and the first window of each row.

    Rows with fewer words have none or, with ``whole_if_short``, one window that is
    the whole (non-empty) sequence.
    """
    counts = np.diff(first)
    k = np.maximum(counts - n + 1, 0)
    short = (counts > 0) & (counts < n) if whole_if_short else np.zeros(len(counts), bool)
    begin = np.concatenate([[0], np.cumsum(k + short)])
    total = int(begin[-1])
    if not total:
        return np.zeros(0, dtype=U64), begin
    row = np.repeat(np.arange(len(counts)), k + short)
    pos = first[:-1][row] + (np.arange(total) - begin[:-1][row])
    length = np.where(short[row], counts[row], n)
    up, down = _WORD_POWERS.get(len(h) + 1)
    prefix = np.zeros(len(h) + 1, dtype=U64)
    np.cumsum(h * up[:-1], out=prefix[1:])
    out = (prefix[pos + length] - prefix[pos]) * down[pos]
    return mix64(out + length.astype(U64) * U64(0xA24BAED4963EE407), seed), begin


def word_strings(s: TextSlice, w: Words) -> pa.StringArray:
    """The words of a slice as one Arrow array (their bytes without the white space between)."""
    if not len(w.start):
        return pa.array([], pa.string())
    length = w.end - w.start
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(length), pa.py_buffer(offsets), pa.py_buffer(s.data[~_IS_SPACE[s.data]]))


def row_counts(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many marked bytes every row of a slice has."""
    total = np.zeros(len(mask) + 1, dtype=np.int64 if len(mask) >= 2**31 else np.int32)
    np.cumsum(mask, out=total[1:])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.int64)
