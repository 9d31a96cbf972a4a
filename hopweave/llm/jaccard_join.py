"""N-gram Jaccard join by universe partition, exactly verified.

Two texts link when ``100 * |a & b| >= percent * |a | b|`` over their sets of distinct
``n``-word shingles (A-Z read as a-z; with fewer words the whole sequence is one shingle).
Linked sets of sizes r and s differ in at most ``H = r + s - 2 ceil(percent (r + s) / (100 +
percent))`` shingles, which drives everything:

1. Prefilter.  A distributed count-min sketch (``block_sketch``) tells which of a text's
   shingles occur only once in the whole table.  No linked text holds those, so a text
   with more than H of them links with nothing and is done; of the others only the
   remaining shingles (and the number ``alone`` of those set aside) are needed.
2. Classes.  Equal sets are one class; only its first text goes on.
3. Index.  Sizes are cut into bands so that linked sizes lie in the same or in neighbouring
   bands.  In a band the shingle universe is dealt by hash to segments; a segment counts
   one ticket when its subset is indexed as it is, two when its one-deletion neighbourhood
   is indexed as well (subsets one shingle apart then meet).  With H + 1 tickets, linked
   sets meet in some segment (pigeonhole).  Each band takes the split of tickets with the
   least estimated cost (entries plus chance meetings).  A text may leave out as many
   tickets as it has ``alone`` shingles - each of those already uses up a difference - and
   leaves out its costliest segments, empty ones first.
4. Stars (``stars``).  The members of a segment key are verified against the key's centre, the
   one with the fewest ``alone`` shingles.  Members left over are compared by marks, and only
   pairs that their marks allow are verified; large stars are dealt to segments anew first, by
   other hashes and among themselves: sets that met by chance part, linked ones meet again.
5. Components of the verified links; a text's component is its smallest linked id.

Sets are compared by 64-bit shingle hashes; a class is known by a 64-bit hash of its set.

Defined results: null, empty and blank texts have size 0 and link with nothing; a null id
belongs to its class but never names it (a component of null ids only has id null);
repeated rows come out one by one; an empty table gives no rows.  Only the id and text
columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopweave.llm.block_sketch import REPLY, SEGMENT_KEYS, SKETCH, estimated_repeats, merge_sketches, sketch_of
from hopweave.llm.common import pieces_for, source_bytes, stage
from hopweave.llm.components import components
from hopweave.llm.stars import links_of_entries, most_apart
from hopweave.llm.textops import giving_back, mix64, ngram_hashes, seed_of, slices, word_hashes, words_of

BLOCK_BYTES = 12 << 20
#: Shingles per sketch segment: 16 counters a shingle and row, so that nearly all shingles
#: that occur once are known to (0.4 % are not), which the bounds on differences live on.
SEGMENT_SHINGLES = SEGMENT_KEYS // 4
#: Estimated chance that two texts of a band agree on a shingle's presence, for the cost of
#: chance meetings.
AGREE = 0.15


# -- bands and tickets ----------------------------------------------------------------------

@dataclass(frozen=True)
class Band:
    low: int              # sizes low .. high
    high: int
    apart: int            # H: the most differences when the smaller set is in this band
    plain: int            # segments of one ticket
    double: int           # segments of two tickets

    @property
    def segments(self) -> int:
        return self.plain + self.double


def band_bounds(largest: int, percent: int) -> list[int]:
    """Lower bounds: linked sizes lie in the same band or in neighbouring ones."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, -(-out[-1] * 100 // percent)))
    return out


def allot(low: int, high: int, percent: int, rows: int) -> Band:
    """The split of H + 1 tickets with the least cost for texts of a band with ``rows`` rows."""
    apart = most_apart(2 * low, high + high * 100 // percent, percent)
    best, least = None, None
    for double in range((apart + 1) // 2 + 1):
        plain = apart + 1 - 2 * double
        size = (low + high) / 2 / (plain + double)
        meet = rows * AGREE ** size
        cost = plain * (1 + meet) + double * (1 + size) * (1 + meet)
        if least is None or cost < least:
            best, least = Band(low, high, apart, plain, double), cost
    return best


def entry_keys(tokens: np.ndarray, alone: int, number: int, band: Band, level: int = 0) -> np.ndarray:
    """Index keys of one set in one band; every ``level`` deals the universe by hashes of its own."""
    m = band.segments
    seg = (mix64(tokens, seed_of(3 * level + 1, number)) % np.uint64(m)).astype(np.int64)
    mark = mix64(tokens, seed_of(3 * level + 2, number))
    order = np.argsort(seg, kind="stable")
    seg, mark = seg[order], mark[order]
    size = np.bincount(seg, minlength=m)
    total = np.zeros(m, dtype=np.uint64)
    np.add.at(total, seg, mark)
    ticket = np.where(np.arange(m) < band.plain, 1, 2)
    use = np.ones(m, dtype=bool)
    spare = alone
    # empty segments meet everything, then the many entries of large double ones, then small subsets
    for k in np.lexsort((np.where(ticket == 2, -size, size), -ticket, size > 0)):
        if spare < ticket[k]:
            if spare <= 0:
                break
            continue
        use[k] = False
        spare -= ticket[k]
    salt = mix64(np.arange(m, dtype=np.uint64), seed_of(3 * level + 3, number))
    keys = [mix64(total[use] + salt[use])]
    near = use[seg] & (seg >= band.plain)
    if near.any():
        keys.append(mix64(total[seg[near]] - mark[near] + salt[seg[near]]))
    return np.unique(np.concatenate(keys))


# -- texts to sets ---------------------------------------------------------------------------

def block_sets(texts, n: int):
    """Per row of a block: distinct shingles, one after another, and the first of each row."""
    parts, sizes = [], []
    for s in slices(texts):
        w = words_of(s)
        g, begin = ngram_hashes(word_hashes(s, w, fold=True), w.first, n, whole_if_short=True)
        for r in range(s.rows):
            u = np.unique(g[begin[r]:begin[r + 1]])
            parts.append(u)
            sizes.append(len(u))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _sketch(segments: int, n: int):
    def sketch(t):
        tokens, _ = block_sets(t.column("text"), n)
        return sketch_of(tokens, t.column("block")[0].as_py(), segments)
    return sketch


def _sets(segments: int, n: int, percent: int):
    """Every text's size and class; for the first of a class in the block that may link, its shingles."""
    def sets(docs, replies):
        tokens, first = block_sets(docs.column("text"), n)
        keep = estimated_repeats(tokens, replies, segments)
        marks = np.concatenate([[np.uint64(0)], np.cumsum(mix64(tokens, 0xC1A55))])
        size = np.diff(first)
        klass = mix64(marks[first[1:]] - marks[first[:-1]] + size.astype(np.uint64)).view(np.int64)
        kept = np.concatenate([[0], np.cumsum(keep)])
        alone = size - (kept[first[1:]] - kept[first[:-1]])
        data, seen = [], set()
        for r in range(len(size)):
            s = int(size[r])
            reach = most_apart(s - (-s * percent // 100), s + s * 100 // percent, percent)
            if not s or not reach or alone[r] > reach or int(klass[r]) in seen:
                data.append(None)
                continue
            seen.add(int(klass[r]))
            own = slice(first[r], first[r + 1])
            data.append(tokens[own][keep[own]].tobytes())
        return pa.table({"doc_id": docs.column("doc_id"), "t": docs.column("t"), "n": pa.array(size, pa.int64()), "class": pa.array(klass, pa.int64()),
                         "alone": pa.array(alone, pa.int64()), "tokens": pa.array(data, pa.binary())})
    return sets


# -- index -----------------------------------------------------------------------------------

def _entries(bands: dict[int, Band], bounds: list[int], percent: int, level: int):
    def entries(batches):
        for b in batches:
            keys, owner, lone = [], [], []
            for c, n, alone, data in zip(*(b.column(x).to_pylist() for x in ("class", "n", "alone", "tokens")), strict=True):
                tokens, own = np.frombuffer(data, np.uint64), int(np.searchsorted(bounds, n, side="right")) - 1
                for number in (own, own - 1):
                    band = bands.get(number)
                    if band is None or number < own and n > band.high * 100 // percent:
                        continue
                    x = entry_keys(tokens, alone, number, band, level)
                    keys.append(x)
                    owner.append(np.full(len(x), c))
                    lone.append(np.full(len(x), alone))
            yield _entry_batch(keys, owner, lone)
    return entries


_ENTRY = "key long, class long, alone long"


def _entry_batch(keys, owner, lone) -> pa.RecordBatch:
    join = lambda x: np.concatenate(x).view(np.int64) if x else np.zeros(0, np.int64)
    return pa.RecordBatch.from_pydict({"key": join(keys), "class": join(owner), "alone": join(lone)})


def indexed(sets: DataFrame, percent: int, level: int = 0) -> DataFrame | None:
    """(key, class, alone): the index entries of sets (None without sets); linked sets share a key."""
    top = sets.agg(F.max("n").alias("n")).first()["n"]
    if top is None:
        return None
    bounds = band_bounds(int(top), percent)
    number = F.lit(0)
    for k, low in enumerate(bounds[1:], 1):
        number = F.when(F.col("n") >= low, F.lit(k)).otherwise(number)
    counts = {r["band"]: r["count"] for r in sets.groupBy(number.alias("band")).count().collect()}  # a row per band
    bands = {k: allot(bounds[k], bounds[k + 1] - 1, percent, c) for k, c in counts.items()}
    return sets.mapInArrow(_entries(bands, bounds, percent, level), _ENTRY)


def links_of(sets: DataFrame, percent: int) -> DataFrame | None:
    """Pairs of classes that connect exactly what the links connect (None without sets).

    ``sets``: (class, n, alone, tokens), one row per class, in a written table.
    """
    entries = indexed(sets, percent)
    if entries is None:
        return None
    return links_of_entries(entries, sets, percent, again=lambda fewer, level: indexed(fewer, percent, level))


def _members(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int, block_bytes: int, segment_keys: int) -> DataFrame:
    """(doc_id, t, n, class, root, component_id) of every row; t: the text's hash, root: the
    component as a class (null without shingles)."""
    _, size = source_bytes(docs, text_col)
    blocks, segments = pieces_for(size, block_bytes, 16), pieces_for(size // 6, segment_keys)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("t"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "doc_id", "t"), F.lit(blocks)).cast("int"))
    grouped = rows.groupBy("block")
    replies = grouped.applyInArrow(giving_back(_sketch(segments, n)), SKETCH) \
        .groupBy("segment").applyInArrow(giving_back(merge_sketches), REPLY)
    found = stage(grouped.cogroup(replies.groupBy("block"))
                  .applyInArrow(giving_back(_sets(segments, n, percent), 2), "doc_id long, t long, n long, class long, alone long, tokens binary"), "sets", release=True)
    sets = stage(found.where(F.col("tokens").isNotNull()).groupBy("class").agg(
        F.min(F.struct("n", "alone", "tokens")).alias("s")).select("class", "s.n", "s.alone", "s.tokens"), "class-sets")
    links = links_of(sets, percent)
    named = found.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("least")).withColumn("root", F.col("class"))
    if links is not None:
        named = named.drop("root").join(components(links).withColumnRenamed("node", "class"), "class", "left") \
            .withColumn("root", F.coalesce("root", "class"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = stage(named.join(ids, "root").select("class", "root", "component_id"), "class-components")
    members = found.select("doc_id", "t", "n", "class")
    return members.where("n > 0").join(of_class, "class").select("doc_id", "t", "n", "class", "root", "component_id") \
        .unionByName(members.where("n = 0").select("doc_id", "t", "n", "class", F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id")))


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, percent: int = 85,
                    block_bytes: int = BLOCK_BYTES, segment_keys: int = SEGMENT_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, class, component_id) of every row."""
    return _members(docs, id_col, text_col, n, percent, block_bytes, segment_keys) \
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("class")).alias("class"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80,
                block_bytes: int = BLOCK_BYTES, segment_keys: int = SEGMENT_SHINGLES) -> DataFrame:
    """The rows of ``docs`` (all columns) with one row of every component: its smallest id.

    Texts without shingles link with nothing and stay, row by row.
    """
    members = _members(docs, id_col, text_col, n, percent, block_bytes, segment_keys).where("n > 0")
    best = members.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("b"))
    best = best.select(F.coalesce("b.doc_id", F.lit(_NO_ID)).alias("_id"), F.col("b.t").alias("_t"), F.lit(True).alias("_one"))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    rows = docs.withColumn("_id", key).withColumn("_t", F.xxhash64(F.col(text_col)))
    some = rows.where(F.coalesce(F.col(text_col).rlike(_WORD), F.lit(False)))
    none = docs.where(~F.coalesce(F.col(text_col).rlike(_WORD), F.lit(False)))
    return some.join(best, ["_id", "_t"]).dropDuplicates(["_id", "_t"]).select(*docs.columns).unionByName(none)


_NO_ID = -(1 << 63)
#: A text with a word at all.
_WORD = r"[^\x20\x09-\x0D]"
