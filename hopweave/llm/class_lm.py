"""Brown class-based bigram language model, learned by exchange clustering.

Tokens are words (A-Z read as a-z) and one end per text.  Every training word has a class:

    P(word | before) = P(class | class before) * P(word | class)

with P(word | class) = (c + 0.5) / (n + 0.5 (v + 1)) (n tokens and v words of the class in
training; every class keeps room for one unseen word) and class transitions smoothed towards
class frequencies: all add up to one.  An unseen word takes the class of its last two bytes.

1. Exchange clustering moves types between ``CLASSES`` classes while that raises the
   likelihood of the class bigrams.  The ``CLUSTERED`` most frequent words are types of their
   own; the others stand in for their neighbours' sake as ``SUFFIXES`` types by last bytes.
2. Every further word goes to the class that makes its occurrences and their neighbours
   likeliest under these classes: first the ``HEAD`` most frequent words, beside the classes
   of step 1, then all rarer ones, beside the classes the head words got by then.
3. Class bigrams are counted anew with the class of every word.

Counts cover every training text.  Spark sums word counts (a table that grows with the
vocabulary), type bigrams (at most types^2 numbers: the clustering's bounded input) and the
neighbours' classes of every further word, sorted by word.  Scoring takes classes and counts
of the head words along; all rarer words are joined with the class table, exactly.

Defined results: a null or empty text is its end token alone; without training texts base
and score are 0 (the only possible token has probability 1); rows that repeat are scored
one by one; ids may be null.  Words are compared by 64-bit hashes.  Only the text and ``keep``
columns are read; a kept column named like an output column is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hopweave.llm.common import stage
from hopweave.llm.textops import mix64, slices, word_hashes, words_of

CLUSTERED, SUFFIXES, CLASSES = 1024, 256, 48
HEAD = 65_536
ROUNDS = 6
#: Weight of the class frequencies in the class transitions.
SMOOTH = 20.0
_END = CLUSTERED + SUFFIXES
_TYPES = _END + 1
#: Neighbours of a word: class of a left or right one, or the suffix class of a rarer left or right one; or none.
_LEFT, _RARE_LEFT, _RIGHT, _RARE_RIGHT, _NONE = 0, CLASSES, 2 * CLASSES, 3 * CLASSES, 255
#: Gains are whole numbers, so that their sums do not depend on the order of the rows.
_UNIT = 1 << 20
_RARE = 255
_OUT = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]


def _suffix(s, w) -> np.ndarray:
    """Suffix type (0 .. SUFFIXES - 1) of every word: its last two bytes, A-Z as a-z."""
    d = s.data
    fold = lambda b: np.where((b >= 65) & (b <= 90), b + 32, b).astype(np.uint64)
    last = fold(d[w.end - 1])
    before = np.where(w.end - w.start > 1, fold(d[np.maximum(w.end - 2, 0)]), 0).astype(np.uint64)
    return (mix64(before * np.uint64(256) + last, 0x5FF) % np.uint64(SUFFIXES)).astype(np.int64)


def _merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, at, inverse = np.unique(keys, return_index=True, return_inverse=True)
    return key, at, np.bincount(inverse, weights=counts, minlength=len(key)).astype(np.int64)


def word_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, suffix, n) over all texts, words by hash."""
    def count(batches):
        word, suffix, n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            for s in slices(b.column("text")):
                w = words_of(s)
                h, at, c = _merge(word_hashes(s, w, fold=True), np.ones(len(w.start)))
                suf = _suffix(s, w)[at]
                word, at, n2 = _merge(np.concatenate([word, h]), np.concatenate([n, c]))
                suffix, n = np.concatenate([suffix, suf])[at], n2
            if len(word) > 2_000_000:            # keep the task's table bounded
                yield _rows(word, suffix, n)
                word, suffix, n = word[:0], suffix[:0], n[:0]
        yield _rows(word, suffix, n)

    def _rows(word, suffix, n):
        return pa.RecordBatch.from_pydict({"word": pa.array(word.view(np.int64)), "suffix": pa.array(suffix, pa.int32()), "n": pa.array(n)})

    return texts.select(F.col(text_col).alias("text")).where(F.col("text").isNotNull()) \
        .mapInArrow(count, "word long, suffix int, n long").groupBy("word").agg(F.min("suffix").alias("suffix"), F.sum("n").alias("n"))


@dataclass
class Head:
    """The most frequent words: sorted hashes, rank by frequency and count of each."""

    word: np.ndarray
    rank: np.ndarray
    n: np.ndarray

    def find(self, h: np.ndarray) -> np.ndarray:
        """Position in the table, -1 for rarer words."""
        if not len(self.word):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.word, h), len(self.word) - 1)
        return np.where(self.word[at] == h, at, -1)


def _typed(s, head: Head):
    """(type of every token, place in the head table, first token of each row, words, hashes)."""
    w = words_of(s)
    h = word_hashes(s, w, fold=True)
    place = head.find(h)
    rank = np.where(place >= 0, head.rank[place] if len(head.rank) else 0, CLUSTERED)
    kind = np.where(rank < CLUSTERED, rank, CLUSTERED + _suffix(s, w))
    rows = np.arange(s.rows)
    token_type = np.full(len(h) + s.rows, _END, dtype=np.int64)
    spot = np.arange(len(h)) + w.row                      # every earlier row has one end more
    token_type[spot] = kind
    return token_type, spot, place, w.first + np.append(rows, s.rows), h


def _before(tokens: np.ndarray, end: int = _END) -> np.ndarray:
    """The type (or class) before every token; a text begins after an end."""
    out = np.empty_like(tokens)
    out[:1], out[1:] = end, tokens[:-1]
    return out


def type_bigrams(texts: DataFrame, head: Head, text_col: str = "text") -> DataFrame:
    """(pair, n): bigram counts of types, pair = before * types + type."""
    def count(batches):
        pair, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            for s in slices(b.column("text")):
                t, *_ = _typed(s, head)
                p, _, c = _merge(_before(t) * _TYPES + t, np.ones(len(t)))
                pair, _, n = _merge(np.concatenate([pair, p]), np.concatenate([n, c]))
        yield pa.RecordBatch.from_pydict({"pair": pa.array(pair), "n": pa.array(n)})

    return texts.select(F.col(text_col).alias("text")).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of every type: types move, one at a time, to the class that raises the summed
    ``n log n`` of class bigrams less that of class totals most, until a round moves none."""
    def f(x):
        return x * np.log(np.maximum(x, 1))

    total = bigrams.sum(0) + bigrams.sum(1)
    order = np.argsort(-total, kind="stable")
    group = np.zeros(len(bigrams), dtype=np.int64)
    group[order] = np.arange(len(bigrams)) % classes
    hot = np.eye(classes)[group]
    n = hot.T @ bigrams @ hot
    by_class, into = bigrams @ hot, hot.T @ bigrams       # what follows a type, what precedes it
    for _ in range(rounds):
        moved = 0
        for t in order:
            if not total[t]:
                continue
            a, loop = group[t], bigrams[t, t]
            right, left = by_class[t].copy(), into[:, t].copy()
            right[a] -= loop
            left[a] -= loop
            n[a] -= right
            n[:, a] -= left
            n[a, a] -= loop
            rows, cols = n.sum(1), n.sum(0)
            gain = (f(n + right[None]) - f(n)).sum(1) + (f(n + left[:, None]) - f(n)).sum(0)
            d = np.diagonal(n)
            gain += f(d + right + left + loop) - f(d + right) - f(d + left) + f(d)
            gain -= f(rows + right.sum() + loop) - f(rows) + f(cols + left.sum() + loop) - f(cols)
            b = int(gain.argmax()) if gain.max() > gain[a] + 1e-9 else a
            n[b] += right
            n[:, b] += left
            n[b, b] += loop
            if b != a:
                moved += 1
                group[t] = b
                by_class[:, a] -= bigrams[:, t]
                by_class[:, b] += bigrams[:, t]
                into[a] -= bigrams[t]
                into[b] += bigrams[t]
        if not moved:
            break
    return group


def _neighbours(s, head: Head, cls: np.ndarray, group: np.ndarray):
    """Per token of a slice: class (-1: a rarer word), suffix class (of words), hash; and as in
    ``_typed``: place of words among tokens, place in the head table, first token of each row."""
    kind, spot, place, first, h = _typed(s, head)
    own = np.full(len(kind), group[_END])
    own[spot] = np.append(cls, -1)[place]                 # place -1: the last
    by_suffix, word = np.full(len(kind), -1), np.zeros(len(kind), np.uint64)
    rare = spot[place < 0]
    by_suffix[rare] = group[kind[rare]]                   # types of rarer words are suffixes
    word[spot] = h
    return own, by_suffix, word, spot, place, first


_AROUND = "word long, around int, n long, other long"
_ASSIGNED = "kind int, key long, cls int, n long"


def _rows_around(word, around, n, other):
    for k in range(0, len(word), 500_000):
        at = slice(k, k + 500_000)
        yield pa.RecordBatch.from_arrays([pa.array(word[at].view(np.int64)), pa.array(around[at].astype(np.int32)), pa.array(n[at].astype(np.int64)), other[at]],
                                         names=["word", "around", "n", "other"])


def around_head(texts: DataFrame, head: Head, group: np.ndarray, text_col: str = "text") -> DataFrame:
    """Neighbours of the head words that are not clustered: (word, around, n) of every text."""
    def count(batches):
        sums = np.zeros(len(head.word) * 2 * CLASSES, np.int64)
        for b in batches:
            for s in slices(b.column("text")):
                kind, spot, place, *_ = _typed(s, head)
                at = (place >= 0) & (head.rank[place] >= CLUSTERED) if len(head.rank) else np.zeros(len(place), bool)
                spot, place, cls = spot[at], place[at] * 2 * CLASSES, group[kind]
                for side, beside in ((0, np.where(spot > 0, cls[spot - 1], group[_END])), (1, cls[spot + 1])):
                    sums += np.bincount(place + side * CLASSES + beside, minlength=len(sums))
        at = np.flatnonzero(sums)
        side, beside = np.divmod(at % (2 * CLASSES), CLASSES)
        around = np.where(side == 0, _LEFT, _RIGHT) + beside + 256 * _NONE
        yield from _rows_around(head.word[at // (2 * CLASSES)], around, sums[at], pa.nulls(len(at), pa.int64()))

    return texts.select(F.col(text_col).alias("text")).mapInArrow(count, _AROUND)


def around_rare(texts: DataFrame, head: Head, cls: np.ndarray, group: np.ndarray, text_col: str = "text") -> DataFrame:
    """Both neighbours of every occurrence of a word outside the head, and the right one itself if
    it is outside as well; with a null word: class bigrams (in around) of all other tokens."""
    def count(batches):
        pairs = np.zeros(CLASSES * CLASSES, np.int64)
        for b in batches:
            for s in slices(b.column("text")):
                own, by_suffix, word, spot, place, _ = _neighbours(s, head, cls, group)
                before = _before(own, group[_END])
                both = (own >= 0) & (before >= 0)
                pairs += np.bincount(before[both] * CLASSES + own[both], minlength=len(pairs))
                at = spot[place < 0]
                left = np.where(before[at] >= 0, _LEFT + before[at], _RARE_LEFT + by_suffix[at - 1])
                right = np.where(own[at + 1] >= 0, _RIGHT + own[at + 1], _RARE_RIGHT + by_suffix[at + 1])
                yield from _rows_around(word[at], left + 256 * right, np.ones(len(at)), pa.array(word[at + 1].view(np.int64), mask=own[at + 1] >= 0))
        at = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.int64()), pa.array(at.astype(np.int32)), pa.array(pairs[at]), pa.nulls(len(at), pa.int64())],
                                         names=["word", "around", "n", "other"])

    return texts.select(F.col(text_col).alias("text")).mapInArrow(count, _AROUND)


def gains(bigrams: np.ndarray) -> np.ndarray:
    """What a neighbour adds to the log likelihood of a word in every class (rows: neighbours)."""
    share = (bigrams.sum(0) + 0.5) / (bigrams.sum() + 0.5 * CLASSES)
    step = np.log((bigrams + SMOOTH * share[None]) / (bigrams.sum(1, keepdims=True) + SMOOTH))
    out = np.zeros((256, CLASSES))
    out[_LEFT:_LEFT + CLASSES] = out[_RARE_LEFT:_RARE_LEFT + CLASSES] = step - np.log(share)[None]   # P(class | left) * P(word | class)
    out[_RIGHT:_RIGHT + CLASSES] = out[_RARE_RIGHT:_RARE_RIGHT + CLASSES] = step.T
    return np.rint(out * _UNIT).astype(np.int64)


def assign(around: DataFrame, gain: np.ndarray) -> DataFrame:
    """Every word with its likeliest class and its count (kind 0, by left neighbours), the class
    bigrams this settles (kind 1, key = before * classes + class), and those that wait for the
    class of a rarer word (key) after one of class ``cls`` (kind 2)."""
    def run(batches):
        pairs, held = np.zeros(CLASSES * CLASSES, np.int64), []
        for b in batches:
            t = pa.Table.from_batches([b])
            if not t.num_rows:
                continue
            held.append(t)
            word = t.column("word").to_numpy()
            if word[0] == word[-1] and held[0].column("word")[0].as_py() == word[-1]:
                continue                                  # the same word goes on
            t = pa.concat_tables(held)
            word = t.column("word").to_numpy()
            end = int(np.searchsorted(word, word[-1]))    # the last word may go on
            held = [t.slice(end)]
            if end:
                yield settle(t.slice(0, end), pairs)
        if held:
            yield settle(pa.concat_tables(held), pairs)
        at = np.flatnonzero(pairs)
        yield batch(1, at, np.zeros(len(at)), pairs[at])

    def settle(t, pairs):
        word, n, around = t.column("word").to_numpy(), t.column("n").to_numpy(), t.column("around").to_numpy()
        left, right = around % 256, around // 256
        start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        size = np.diff(np.append(start, len(word)))
        total = np.empty((len(start), CLASSES), np.int64)
        for c in range(CLASSES):
            total[:, c] = np.add.reduceat((gain[:, c][left] + gain[:, c][right]) * n, start)
        best = total.argmax(1)
        cls = np.repeat(best, size)
        at = left < CLASSES
        pairs += np.bincount(left[at] * CLASSES + cls[at], weights=n[at], minlength=len(pairs)).astype(np.int64)
        at = (right >= _RIGHT) & (right < _RARE_RIGHT)
        pairs += np.bincount(cls[at] * CLASSES + right[at] - _RIGHT, weights=n[at], minlength=len(pairs)).astype(np.int64)
        count = np.add.reduceat(np.where(left < _RIGHT, n, 0), start)
        other = t.column("other").combine_chunks()
        at = other.is_valid().to_numpy(zero_copy_only=False)
        done, wait = batch(0, word[start], best, count), batch(2, other.drop_null().to_numpy(), cls[at], n[at])
        return pa.concat_batches([done, wait])

    def batch(kind, key, cls, n):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(np.asarray(key, np.int64)), pa.array(np.asarray(cls, np.int32)),
                                           pa.array(np.asarray(n, np.int64))], names=["kind", "key", "cls", "n"])

    return around.where(F.col("word").isNotNull()).repartition("word").sortWithinPartitions("word").mapInArrow(run, _ASSIGNED)


@dataclass
class ClassModel:
    head: Head
    group: np.ndarray         # class of every type; of a suffix type: of its unseen words
    cls: np.ndarray           # class of every head word, by place
    step: np.ndarray          # (classes, classes) log10 P(class | class before)
    room: np.ndarray          # log10 of the denominator of P(word | class)
    type_log: np.ndarray      # log10 P(word | class) of clustered words, of an unseen word per suffix type, and of the end
    base_room: float          # log10 of the base model's denominator
    end_n: int
    tokens: int               # N, training tokens


def _square(pairs: DataFrame) -> np.ndarray:
    """The class bigrams (key, n) as a matrix: at most classes^2 rows."""
    got = pairs.groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(CLASSES * CLASSES)
    out[got["key"].to_numpy(np.int64)] = got["n"].to_numpy(float)
    return out.reshape(CLASSES, CLASSES)


def fit(texts: DataFrame, text_col: str = "text") -> tuple[ClassModel, DataFrame]:
    """The model, and the written table (word, cls, n) of all words outside its head."""
    counts = stage(word_counts(texts, text_col), "word-counts")
    top = counts.orderBy(F.desc("n"), "word").limit(HEAD).select("word", "n").toPandas()
    word = top["word"].to_numpy().view(np.uint64)
    order = np.argsort(word)
    head = Head(word[order], order.astype(np.int64), top["n"].to_numpy()[order])
    sums = counts.agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    ends = texts.count()
    tokens, words = int(sums["n"] or 0) + ends, int(sums["v"]) + (1 if ends else 0)
    pairs = type_bigrams(texts, head, text_col).toPandas()                            # at most types^2 rows
    bigrams = np.zeros((_TYPES, _TYPES))
    bigrams.ravel()[pairs["pair"].to_numpy()] = pairs["n"].to_numpy()
    group = exchange(bigrams)
    hot = np.eye(CLASSES)[group]
    gain = gains(hot.T @ bigrams @ hot)
    cls = np.where(head.rank < CLUSTERED, group[np.minimum(head.rank, CLUSTERED)], 0)
    if len(head.word) > CLUSTERED:
        own = assign(around_head(texts, head, group, text_col), gain).where("kind = 0").select("key", "cls").toPandas()   # at most HEAD rows
        cls[head.find(own["key"].to_numpy().view(np.uint64))] = own["cls"].to_numpy()
    seen = stage(around_rare(texts, head, cls, group, text_col), "around-rare")
    n = _square(seen.where(F.col("word").isNull()).select(F.col("around").alias("key"), "n"))
    found = stage(assign(seen, gain), "classes", release=True)
    classes = found.where("kind = 0").select(F.col("key").alias("word"), "cls", "n")
    n += _square(found.where("kind = 1").select("key", "n"))
    later = found.where("kind = 2").groupBy("key", "cls").agg(F.sum("n").alias("n")).join(classes.select(F.col("word").alias("key"), F.col("cls").alias("own")), "key")
    n += _square(later.select((F.col("cls") * CLASSES + F.col("own")).alias("key"), "n"))
    share = (n.sum(0) + 0.5) / (n.sum() + 0.5 * CLASSES)
    step = np.log10((n + SMOOTH * share[None]) / (n.sum(1, keepdims=True) + SMOOTH))
    kinds = np.bincount(cls, minlength=CLASSES)
    for r in classes.groupBy("cls").count().collect():                                # at most a row per class
        kinds[r["cls"]] += r["count"]
    if ends:
        kinds[group[_END]] += 1
    room = np.log10(n.sum(0) + 0.5 * (kinds + 1))
    of_type = np.zeros(_TYPES)
    of_type[head.rank[head.rank < CLUSTERED]] = head.n[head.rank < CLUSTERED]
    of_type[_END] = ends
    type_log = np.log10(of_type + 0.5) - room[group]
    return ClassModel(head, group, cls, step, room, type_log, float(np.log10(tokens + 0.5 * (words + 1))), ends, tokens), classes


def score(docs: DataFrame, model: ClassModel, classes: DataFrame, text_col: str = "text", keep=("doc_id",)) -> DataFrame:
    """``keep`` columns plus n_tokens, n_known, train_tokens, base_score and score of every row."""
    keep = [c for c in keep if c not in _OUT]
    rows = docs.select(*[F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep)], F.col(text_col).alias("text"))
    kept = rows.columns[:-1]
    schema = T.StructType([rows.schema[c] for c in kept] + [
        T.StructField(c, t) for c, t in (("row", T.LongType()), ("n_tokens", T.LongType()), ("known", T.LongType()), ("base", T.DoubleType()),
                                         ("class_score", T.DoubleType()), ("rare", T.ArrayType(T.LongType())), ("around", T.BinaryType()))])

    def apply(batches):
        head, number = model.head, TaskContext.get().partitionId() << 33
        count_log = np.append(np.log10(head.n + 0.5), 0.0)       # last: a rarer word, joined later
        word_log = np.append(count_log[:-1] - model.room[model.cls], 0.0)
        for b in batches:
            out = [[], [], [], [], [], []]
            for s in slices(b.column("text")):
                cls, by_suffix, word, spot, place, first = _neighbours(s, head, model.cls, model.group)
                before = _before(cls, model.group[_END])
                own = np.where((cls >= 0) & (before >= 0), model.step[before, cls], 0.0)
                log = np.full(len(cls), model.type_log[_END])
                log[spot] = word_log[place]
                base = np.full(len(cls), np.log10(model.end_n + 0.5) - model.base_room)
                base[spot] = count_log[place] - model.base_room
                known = np.full(len(cls), int(model.end_n > 0))
                known[spot] = place >= 0
                at = spot[place < 0]
                owner = np.searchsorted(first, at, side="right") - 1
                for k, x in enumerate((known, base, own + log)):
                    out[k + 1].append(np.add.reduceat(x, first[:-1]) if s.rows else x)
                out[0].append(np.diff(first))
                out[4].append((word[at].view(np.int64), np.bincount(owner, minlength=s.rows)))
                out[5].append(np.stack([np.where(before[at] >= 0, before[at], _RARE), np.where(cls[at + 1] >= 0, cls[at + 1], _RARE), by_suffix[at]], 1).astype(np.uint8))
            n = b.num_rows
            offsets = np.concatenate([[0], np.cumsum(np.concatenate([x[1] for x in out[4]]))]).astype(np.int32) if n else np.zeros(1, np.int32)
            values = np.concatenate([x[0] for x in out[4]]) if n else np.zeros(0, np.int64)
            around = np.concatenate(out[5]) if n else np.zeros((0, 3), np.uint8)
            cols = [np.concatenate(x) if n else np.zeros(0) for x in out[:4]]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in kept), pa.array(np.arange(number, number + n)), pa.array(cols[0].astype(np.int64)), pa.array(cols[1].astype(np.int64)),
                 pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                 pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((3 * offsets).astype(np.int32)), pa.py_buffer(around.tobytes())])],
                names=schema.names)
            number += n

    def finish(batches):
        for b in batches:
            found = b.column("found")
            size = np.where(b.column("found").is_valid().to_numpy(zero_copy_only=False), found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
            flat = found.flatten()
            row = np.repeat(np.arange(b.num_rows), size)
            seen = flat.field("cls").is_valid().to_numpy(zero_copy_only=False)
            count = flat.field("c").fill_null(0).to_numpy(zero_copy_only=False)
            around = np.frombuffer(b"".join(b.column("around").to_pylist()), np.uint8).reshape(-1, 3).astype(np.int64)
            cls = np.where(seen, flat.field("cls").fill_null(0).to_numpy(zero_copy_only=False), around[:, 2])
            left = np.where(around[:, 0] == _RARE, np.append(0, cls)[:-1] if len(cls) else cls, around[:, 0])   # a rarer one is the row's one before
            log = np.log10(count + 0.5)
            own = log - model.room[cls] + model.step[left, cls]
            own += np.where(around[:, 1] == _RARE, 0.0, model.step[cls, np.where(around[:, 1] == _RARE, 0, around[:, 1])])
            sums = [np.bincount(row, weights=x, minlength=b.num_rows) for x in (seen, log, own)]
            cols = {c: b.column(c) for c in b.schema.names}
            known = cols["known"].to_numpy() + sums[0].astype(np.int64)
            base = cols["base"].to_numpy() + sums[1]
            total = base if model.tokens == 0 else cols["class_score"].to_numpy() + sums[2]
            yield pa.RecordBatch.from_arrays([*(cols[c] for c in kept), cols["n_tokens"], pa.array(known), pa.array(np.full(b.num_rows, model.tokens)),
                                              pa.array(base), pa.array(total)], names=final.names)

    final = T.StructType([rows.schema[c] for c in kept] + [T.StructField(c, T.DoubleType() if c.endswith("score") else T.LongType()) for c in _OUT])
    done = stage(rows.mapInArrow(apply, schema), "scored")
    rare = done.select("row", F.posexplode("rare").alias("at", "word")).join(classes.withColumnRenamed("n", "c"), "word", "left") \
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "cls", "c"))).alias("found"))          # a text's rarer words
    return done.drop("rare").join(rare, "row", "left").mapInArrow(finish, final).withColumnsRenamed(dict(zip(kept, keep, strict=True)))
