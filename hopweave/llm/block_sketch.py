"""Count-min sketches that are never held whole.

Blocks of documents sketch the 64-bit hashes of their keys (windows, shingles): two rows of
counters that saturate at 2, cut into segments by hash.  Each segment's counters of all
blocks are merged in one place, and every block is told, for each counter it sent, whether
the merged counter is above one.  Counters only overestimate, so a key whose counters are
not both above one occurs once in the whole table.  The number of segments grows with the
number of keys (about four counters a key and row), so the error does not grow with them;
what travels is a byte or two per key and row, and one bit back.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

#: Counters per sketch row and segment: four times the keys a segment is meant for.
WIDTH_BITS = 23
SEGMENT_KEYS = 2_000_000

SKETCH = "segment int, block int, a binary, b binary"
REPLY = "block int, kind int, segment int, a binary, b binary"


def _segment(h: np.ndarray, segments: int) -> np.ndarray:
    return ((h >> np.uint64(44)) % np.uint64(segments)).astype(np.int64)


def by_segment(h: np.ndarray, segments: int):
    """(segment, positions of its windows) in order."""
    seg = _segment(h, segments)
    order = np.argsort(seg, kind="stable")
    cut = np.searchsorted(seg[order], np.arange(segments + 1))
    for k in range(segments):
        if cut[k] < cut[k + 1]:
            yield k, order[cut[k]:cut[k + 1]]


def cells(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << WIDTH_BITS) - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(21)) & mask).astype(np.int64)


def pack_cells(places: np.ndarray) -> bytes:
    """Non-zero counters of one sketch row: sorted places as gaps, and whether they are 2."""
    place, count = np.unique(places, return_counts=True)
    gap = np.diff(place, prepend=0).astype("<u4")
    planes = b"".join(np.ascontiguousarray(gap.view(np.uint8).reshape(-1, 4)[:, k]).tobytes() for k in range(3))
    return len(place).to_bytes(4, "little") + zlib.compress(planes + np.packbits(count > 1).tobytes(), 1)


def _unpack_cells(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    raw = np.frombuffer(zlib.decompress(data[4:]), dtype=np.uint8)
    gap = raw[:n].astype(np.int64) | raw[n:2 * n].astype(np.int64) << 8 | raw[2 * n:3 * n].astype(np.int64) << 16
    return np.cumsum(gap), 1 + np.unpackbits(raw[3 * n:], count=n)


def sketch_of(h: np.ndarray, block: int, segments: int) -> pa.Table:
    """A block's sketch (columns SKETCH) of its key hashes."""
    ks, a, b = [], [], []
    for k, at in by_segment(h, segments):
        x, y = cells(h[at])
        ks.append(k)
        a.append(pack_cells(x))
        b.append(pack_cells(y))
    return pa.table({"segment": pa.array(ks, pa.int32()), "block": pa.array([block] * len(ks), pa.int32()),
                     "a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def merge_sketches(t):
    """The merged counters of a segment, told to each block for the counters it sent."""
    flags = []
    for col in ("a", "b"):
        total = np.zeros(1 << WIDTH_BITS, dtype=np.uint8)
        sent = [_unpack_cells(x.as_py()) for x in t.column(col)]
        for place, count in sent:
            total[place] = np.minimum(2, total[place] + count)
        flags.append(pa.array([np.packbits(total[place] > 1).tobytes() for place, _ in sent], pa.binary()))
    return pa.table({"block": t.column("block"), "kind": pa.array([0] * t.num_rows, pa.int32()), "segment": t.column("segment"),
                     "a": flags[0], "b": flags[1]})


def told(replies: pa.Table, kind: int) -> dict[int, dict]:
    """A block's replies of one kind, by segment."""
    return {r["segment"]: r for r in replies.to_pylist() if r["kind"] == kind} if replies.num_rows else {}


def estimated_repeats(h: np.ndarray, replies: pa.Table, segments: int) -> np.ndarray:
    """Which of a block's keys may occur more than once in the table."""
    out, flags = np.zeros(len(h), dtype=bool), told(replies, 0)
    for k, at in by_segment(h, segments):
        both = []
        for col, c in zip(("a", "b"), cells(h[at]), strict=True):
            place, inverse = np.unique(c, return_inverse=True)
            both.append(np.unpackbits(np.frombuffer(flags[k][col], np.uint8), count=len(place))[inverse])
        out[at] = (both[0] & both[1]).astype(bool)
    return out
