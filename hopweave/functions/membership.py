"""Membership tests inside a scan: blocked Bloom filters built by an aggregate.

The keys of a table are hashed into pages of 2^15 bits; a page is one row with an array of 512
numbers, built by ``bit_or``.  A key has ``BITS`` bits, all in one page, so testing a row is one
lookup of a broadcast page and some shifts, without a shuffle of the tested table.  With
``BITS_A_KEY`` bits a key about one row in 300 passes though its key is absent; no present one
is lost.  An exact join has to follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_BITS = 15
BITS, BITS_A_KEY = 4, 16
#: Pages that may be broadcast (4 KB each): with more keys the table goes unfiltered to its join.
MOST_PAGES = 16_384


def _page(keys, pages: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("page"), *keys), F.lit(pages)).cast("int")


def _bits(keys) -> list[Column]:
    """The places of a key's bits in its page, cut from one hash."""
    h = F.xxhash64(F.lit("bits"), *keys)
    mask = (1 << PAGE_BITS) - 1
    return [F.shiftrightunsigned(h, PAGE_BITS * k).bitwiseAND(F.lit(mask)).cast("int") for k in range(BITS)]


def bit_pages(members: DataFrame, keys: list[str], pages: int) -> DataFrame:
    """(_page, _words): the filled pages of the keys."""
    places = members.select(_page(keys, pages).alias("_page"), F.explode(F.array(*_bits(keys))).alias("_b"))
    words = places.groupBy("_page", F.shiftright("_b", 6).alias("_w")).agg(F.bit_or(F.expr("shiftleft(1L, _b % 64)")).alias("_v"))
    filled = words.groupBy("_page").agg(F.map_from_entries(F.collect_list(F.struct("_w", "_v"))).alias("_m"))   # at most 512 words
    every = F.sequence(F.lit(0), F.lit((1 << PAGE_BITS - 6) - 1))
    return filled.select("_page", F.transform(every, lambda w: F.coalesce(F.col("_m")[w], F.lit(0).cast("long"))).alias("_words"))


def probable_members(df: DataFrame, members: DataFrame, keys: list[str], most_pages: int = MOST_PAGES) -> DataFrame:
    """The rows of ``df`` whose (non-null) keys are in ``members``, and a few more.

    The members are counted first; if their pages would exceed ``most_pages``, ``df`` is returned
    as it is.
    """
    pages = max(1, -(-members.count() * BITS_A_KEY >> PAGE_BITS))
    if pages > most_pages:
        return df
    filled = bit_pages(members, keys, pages)
    tested = df.withColumn("_page", _page(keys, pages)).join(F.broadcast(filled), "_page")
    hit = [F.getbit(F.get(F.col("_words"), F.shiftright(b, 6)), (b % 64).cast("int")) == 1 for b in _bits(keys)]
    for h in hit:
        tested = tested.where(h)
    return tested.select(*df.columns)
