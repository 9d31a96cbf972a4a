"""Best-fit packing of token sequences with swap-based local search.

Texts are tokenized (each with its end token); a document longer than the capacity is cut
into full pieces (only its first piece may be shorter), full pieces are sequences of their
own, and all other pieces are packed.

Packing runs in groups of a bounded number of pieces: each group is filled best-fit
decreasing, then underfull bins exchange pieces (a move, one for one, or one for two) as
long as an exchange raises the summed squared fill, which drains the emptiest bins until
they are empty and drop out.  Bins that end up full enough are final; the pieces of all
other bins go into the next round, dealt anew to fewer groups, until one group holds them
all.  So at most one bounded group's worth of bins is packed alone, and a sequence can be
reached from any document.

Tokenizing: texts are cut where the byte-level pattern always cuts (before a blank, between
a letter and ASCII punctuation, around a single line end); the pieces' ids are remembered
(bounded, per Python worker), so a piece is tokenized once.  New pieces go through the same
vocabulary's rank table, which is several times faster than the full tokenizer on short
strings and gives the same ids (tested).  Texts with adjacent white space, where such cuts
could be wrong, go whole through the full tokenizer.

Defined results: a null or empty text is the single end token; an empty table gives no
rows; repeated rows are packed one by one (a repeated id gives repeated (id, piece));
ids may be null; only the id and text columns are read.
"""

from __future__ import annotations

import base64
import bisect
import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopweave.llm.common import pieces_for, stage
from hopweave.llm.textops import SLICE_BYTES, give_back, slices, span_hashes

CAPACITY = 2048
#: Pieces packed together in one task, and how full a bin has to be to be final before the last round.
GROUP_PIECES = 20_000
FINAL_FILL = 0.98
END_ID = 0
#: Remembered pieces per Python worker.
MEMO_PIECES = 2_000_000

#: Fixed values of the vocabulary: its pre-splitting pattern, and ASCII punctuation that the
#: pattern never joins to a letter before it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_STOPS = np.zeros(256, dtype=bool)
_STOPS[list(b".,!?;:|()[]-/")] = True
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True

_SPACE_LIKE = np.zeros(256, dtype=bool)
#: First or last bytes of any white-space character (some other characters share them).
_SPACE_LIKE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20), 0xE1, 0xE2, 0xE3]] = True
_memos: dict[str, _Memo] = {}
_tokenizers: dict[str, object] = {}


def _tokenizer(path: str):
    if path not in _tokenizers:
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        _tokenizers[path] = t
    return _tokenizers[path]


def _ranks(path: str):
    """The vocabulary as byte ranks, from the ranks file."""
    if path not in _tokenizers:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _tokenizers[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _tokenizers[path]


class _Memo:
    """Token ids of pieces already seen by this Python worker, by the piece's hash (sorted)."""

    def __init__(self):
        self.keys = np.zeros(0, dtype=np.uint64)
        self.begin = np.zeros(0, dtype=np.int64)      # ids of piece k: ids[begin[k]:begin[k] + length[k]]
        self.length = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def missing(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.arange(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.flatnonzero(self.keys[at] != keys)

    def add(self, keys: np.ndarray, pieces: list[str], ranks_path: str) -> None:
        ids = list(map(_ranks(ranks_path).encode_ordinary, pieces))
        length = np.array([len(x) for x in ids], dtype=np.int64)
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.begin = np.insert(self.begin, where, len(self.ids) + np.cumsum(length) - length)
        self.length = np.insert(self.length, where, length)
        self.ids = np.concatenate([self.ids, np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(length.sum()))])


def _cuts(s) -> np.ndarray:
    """Where a piece begins: text starts, blanks, a stop after a letter, a line end after a
    character and a letter after a single line end."""
    d, n = s.data, len(s.data)
    edge = np.zeros(n + 1, dtype=bool)
    latin = (d[1:-1] >= 0x80) & (d[:-2] == 0xC3) & (d[1:-1] != 0x97) & (d[1:-1] != 0xB7)  # U+00C0..U+00FF without the two signs
    after_letter = np.zeros(n, dtype=bool)
    after_letter[1:] = _ASCII_LETTER[d[:-1]]
    after_letter[2:] |= latin
    line = d == 0x0A
    solid = ~_SPACE_LIKE[d]
    edge[:-1] = (d == 0x20) | _STOPS[d] & after_letter
    edge[1:-1] |= line[1:] & solid[:-1]
    edge[2:-1] |= line[1:-1] & solid[:-2] & (_ASCII_LETTER[d[2:]] | (d[2:] == 0xC3))
    edge[s.offsets] = True
    return edge


def _blank_gaps(s) -> np.ndarray:
    """Rows where white space may stand beside a blank: their texts are tokenized whole."""
    d = s.data
    if not len(d):
        return np.zeros(s.rows, dtype=bool)
    like = _SPACE_LIKE[d]
    # U+0085 and U+00A0 (0xC2 0x85 / 0xC2 0xA0); three-byte spaces end in 0x80..0xAF after such a first byte
    two = np.zeros(len(d), dtype=bool)
    two[:-1] = (d[:-1] == 0xC2) & ((d[1:] == 0x85) | (d[1:] == 0xA0))
    opens = like | two
    closes = like.copy()
    closes[1:] |= two[:-1]
    closes[2:] |= d[:-2] >= 0xE1
    closes[2:] &= ~((d[:-2] > 0xE3) & ~like[2:] & ~np.concatenate([[False], two[:-1]])[2:])
    blank = d == 0x20
    inner = np.zeros(len(d) + 1, dtype=bool)
    inner[s.offsets] = True
    bad = np.zeros(len(d), dtype=bool)
    bad[:-1] |= blank[:-1] & opens[1:] & ~inner[1:-1]
    bad[1:] |= blank[1:] & closes[:-1] & ~inner[1:-1]
    count = np.concatenate([[0], np.cumsum(bad)])
    return count[s.offsets[1:]] > count[s.offsets[:-1]]


def token_ids(s, path: str, ranks_path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, first id of each row) of a slice, as the tokenizer gives them for whole texts."""
    whole = _blank_gaps(s)
    n = len(s.data)
    start = np.flatnonzero(_cuts(s)[:-1])
    end = np.append(start[1:], n)
    first = np.searchsorted(start, s.offsets)
    row = np.repeat(np.arange(s.rows), np.diff(first))
    lengths, pick = np.zeros(len(start), dtype=np.int64), np.zeros(len(start), dtype=np.int64)
    memo = _memos.setdefault(path, _Memo())
    runs = np.flatnonzero(~whole[row])
    if len(runs):
        h = span_hashes(s.data, start[runs], end[runs])
        keys, at, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(memo.keys) + len(keys) > MEMO_PIECES:
            memo = _memos[path] = _Memo()
        new = memo.missing(keys)
        if len(new):
            at = runs[at[new]]
            memo.add(keys[new], [s.data[x:y].tobytes().decode() for x, y in zip(start[at], end[at], strict=True)], ranks_path)
        place = np.searchsorted(memo.keys, keys)[inverse]
        pick[runs], lengths[runs] = memo.begin[place], memo.length[place]
    total = np.concatenate([[0], np.cumsum(lengths)])
    out = memo.ids[np.repeat(pick - total[:-1], lengths) + np.arange(total[-1])]
    begin = total[first]
    if whole.any():                                      # put the whole texts' ids in between
        parts = []
        for r in range(s.rows):
            if whole[r]:
                text = s.data[s.offsets[r]:s.offsets[r + 1]].tobytes().decode()
                parts.append(np.array(_tokenizer(path).encode(text, add_special_tokens=False).ids, dtype=np.uint32))
            else:
                parts.append(out[begin[r]:begin[r + 1]])
        out, begin = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return out, begin


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's pieces."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for b in batches:
            for s in slices(b.column("text"), SLICE_BYTES):
                ids, begin = token_ids(s, tokenizer_path, ranks_path)
                owner, piece, start, length, crc = [], [], [], [], []
                for r in range(s.rows):
                    own = np.append(ids[begin[r]:begin[r + 1]], END_ID).astype("<u4")
                    first = len(own) % capacity or capacity
                    cuts = [0, *range(first, len(own) + 1, capacity)]
                    for p, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        owner.append(s.lo + r)
                        piece.append(p)
                        start.append(x)
                        length.append(y - x)
                        crc.append(zlib.crc32(own[x:y].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])
                give_back()

    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each piece into the fullest bin that still takes it."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by free room
    rooms: list[int] = []  # sorted distinct free rooms that have bins
    bins: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        k = bisect.bisect_left(rooms, need)
        if k == len(rooms):
            b, room = len(bins), capacity
            bins.append([])
        else:
            room = rooms[k]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(k)
        bins[b].append(int(i))
        left = room - need
        if left:
            if not by_room[left]:
                bisect.insort(rooms, left)
            by_room[left].append(b)
    return bins


def local_search(lengths: np.ndarray, bins: list[list[int]], capacity: int, steps: int = 64) -> list[list[int]]:
    """Drain the emptiest bins by exchanges that raise the summed squared fill.

    The bins beyond the volume bound ``ceil(sum / capacity)`` are the donors, emptiest first.
    A donor's piece is moved into a bin that takes it, or swapped for one or two smaller
    pieces of another underfull bin, whichever raises the squared fill most; at most ``steps``
    exchanges a donor.  The partners' ``_WIDTH`` largest pieces (and pairs of them) are open
    to exchange.  Donors that stay non-empty keep their bins.
    """
    spare = len(bins) - max(1, -(-int(lengths.sum()) // capacity))
    if spare <= 0:
        return bins
    fill = np.array([int(lengths[b].sum()) for b in bins])
    order = np.argsort(fill, kind="stable")
    donors, partners = order[:spare], order[spare:]
    partners = partners[fill[partners] < capacity]
    offers = {int(t): _offer(lengths, bins[t]) for t in partners}
    if not offers:
        return bins
    ids = np.array(sorted(offers), dtype=np.int64)
    row = {int(t): k for k, t in enumerate(ids)}
    give = np.stack([offers[int(t)][0] for t in ids])        # what a partner can give back
    what = [offers[int(t)][1] for t in ids]
    room = capacity - fill[ids]
    for d in donors:
        for _ in range(steps):
            best = None
            for size in sorted({int(lengths[i]) for i in bins[d]}, reverse=True):
                need = size - room                           # give back at least this
                ok = (give >= np.maximum(need, 0)[:, None]) & (give < size)
                back = np.where(ok, give, size).min(1)       # size: no exchange
                delta = size - back
                gain = delta * (capacity - room - fill[d] + delta)
                gain[delta <= 0] = -1
                k = int(gain.argmax())
                if gain[k] > 0 and (best is None or gain[k] > best[0]):
                    best = (int(gain[k]), k, size, int(back[k]))
            if best is None:
                break
            _, k, size, back = best
            t = int(ids[k])
            i = next(j for j in bins[d] if lengths[j] == size)
            sent = what[k][int(np.flatnonzero(give[k] == back)[0])]
            bins[d] = [j for j in bins[d] if j != i] + list(sent)
            bins[t] = [j for j in bins[t] if j not in sent] + [i]
            fill[d] -= size - back
            fill[t] += size - back
            room[k] = capacity - fill[t]
            give[k], what[k] = _offer(lengths, bins[t])
            if not bins[d]:
                break
    return [b for b in bins if b]


_WIDTH = 6


def _offer(lengths: np.ndarray, pieces: list[int]) -> tuple[np.ndarray, list[tuple[int, ...]]]:
    """Sizes of nothing, one or two pieces of a bin, and the pieces (padded with -1)."""
    top = sorted(pieces, key=lambda j: -lengths[j])[:_WIDTH]
    sets = [(), *((a,) for a in top), *((a, c) for x, a in enumerate(top) for c in top[x + 1:])]
    out = np.full(1 + _WIDTH + _WIDTH * (_WIDTH - 1) // 2, -1, dtype=np.int64)
    out[:len(sets)] = [int(sum(lengths[j] for j in x)) for x in sets]
    return out, sets


def pack_group(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins (lists of piece numbers) of one group."""
    return local_search(lengths, best_fit(lengths, capacity), capacity) if len(lengths) else []


def _pack_round(rows: DataFrame, groups: int, capacity: int, number: int, last: bool) -> DataFrame:
    """One round: the pieces with their bin and whether it is final."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def pack(t):
        t = t.sort_by([("length", "descending"), ("_salt", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths, group = t.column("length").to_numpy(), t.column("_group")[0].as_py()
        order, name, offset, final = [], [], [], []
        for k, b in enumerate(pack_group(lengths, capacity)):
            full = last or int(lengths[b].sum()) >= FINAL_FILL * capacity
            at = 0
            for i in b:
                order.append(i)
                name.append(group * (1 << 24) + k)
                offset.append(at)
                final.append(full)
                at += int(lengths[i])
        t = t.select(["doc_id", "piece", "start", "length", "ids_crc32"]).take(pa.array(order, pa.int64()))
        return t.append_column("bin", pa.array(name, pa.int64())).append_column("offset", pa.array(offset, pa.int64())) \
            .append_column("final", pa.array(final, pa.bool_()))

    salt = F.xxhash64(F.lit(number), "doc_id", "piece", "ids_crc32")
    return rows.withColumn("_salt", salt).withColumn("_group", F.pmod("_salt", F.lit(groups)).cast("int")) \
        .groupBy("_group").applyInArrow(pack, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, bin long, offset long, final boolean")


def pack(docs: DataFrame, tokenizer_path: str, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    pieces = stage(tokenized_pieces(docs, tokenizer_path, ranks_path, id_col, text_col, capacity), "pieces")
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = pieces.where(F.col("length") == capacity).select(*cols, F.lit(0).cast("long").alias("offset"),
                                                            F.monotonically_increasing_id().alias("sequence_id"))
    done, rest, number = [full], pieces.where(F.col("length") < capacity), 0
    left = rest.count()
    while left:
        groups = pieces_for(left, group_pieces)
        out = stage(_pack_round(rest, groups, capacity, number, groups == 1), f"packed-{number}")
        place = (F.col("bin") + F.lit((number + 1) << 56)).alias("sequence_id")  # rounds never share ids
        done.append(out.where("final").select(*cols, "offset", place))
        if groups == 1:
            break
        rest = out.where(~F.col("final")).select(*cols)
        before, left, number = left, rest.count(), number + 1
        if left > 0.6 * before:  # few bins closed: what is left of each group is final as it is
            done.append(out.where(~F.col("final")).select(*cols, "offset", place))
            break
    result = done[0]
    for d in done[1:]:
        result = result.unionByName(d)
    return result
