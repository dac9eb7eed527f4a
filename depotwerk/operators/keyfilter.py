"""Bloom filters of stored keys, one per group of rows (a month of facts).

A load that appends what is absent must know which of its keys are stored
already, in whatever month.  The filters tell the months that can hold any of
them, so only those months are read.  They never miss a stored key; a key that
is not stored is suspected in a month with a chance of about 10^-7.

A filter is split into blocks of eight 64-bit words.  A key belongs to one
block and sets one bit in each word.  Blocks are rows, so filters are built by
one aggregation and asked by one join in which the filters do not move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import BROADCAST_ROWS, lookup, small_enough

WORDS = 8
KEYS_PER_BLOCK = 8  # on average: an eighth of the bits is set
FILTER_COLUMNS = ("bloecke", "block", *(f"wort{i}" for i in range(WORDS)))
FILTER_TYPES = "bloecke bigint, block bigint, " + ", ".join(f"wort{i} bigint" for i in range(WORDS))


def _place(keys: Sequence[str], blocks: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), blocks)


def _bits(keys: Sequence[str]) -> list[Column]:
    """The bit of the key in each word: six bits each of a second hash."""
    other = F.xxhash64(F.lit("bits"), *keys)
    one = F.lit(1).cast("bigint")
    return [F.call_function("shiftleft", one, F.shiftrightunsigned(other, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(WORDS)]


def key_filters(rows: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """(by, blocks, block, words): the filters of all groups of ``rows``.

    The size of a filter follows from the rows of its group, as a power of two,
    so that there are few sizes to ask for.  Rows with a NULL key part equal
    nothing and are left out; a group of such rows has no filter.
    """
    known = rows.dropna(subset=list(keys)).select(by, *keys)
    blocks = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.count("*") / KEYS_PER_BLOCK, F.lit(1)))))
    sizes = known.groupBy(by).agg(blocks.cast("bigint").alias("bloecke"))
    marked = lookup(known, sizes, [by], spread_by=list(keys), how="inner").select(
        by, "bloecke", _place(keys, F.col("bloecke")).alias("block"), *[b.alias(f"bit{i}") for i, b in enumerate(_bits(keys))])
    return marked.groupBy(by, "bloecke", "block").agg(*[F.bit_or(f"bit{i}").alias(f"wort{i}") for i in range(WORDS)])


def groups_with(filters: DataFrame, rows: DataFrame, keys: Sequence[str], by: str, max_rows: int = BROADCAST_ROWS) -> list | None:
    """The groups that may hold a key of ``rows``; None if the rows are too many to ask for.

    The distinct keys are broadcast behind a check of their number, once per
    filter size, and meet the filters' blocks where those lie.
    """
    # powers of two: a few dozen at most
    sizes = [r[0] for r in filters.select("bloecke").distinct().collect()]
    if not sizes:
        return []
    asked = rows.dropna(subset=list(keys)).select(*keys).distinct()
    bits = [b.alias(f"bit{i}") for i, b in enumerate(_bits(keys))]
    asked = asked.select(*keys, F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])).alias("bloecke"), *bits).select(
        "bloecke", _place(keys, F.col("bloecke")).alias("block"), *[f"bit{i}" for i in range(WORDS)])
    if not small_enough(asked, max_rows):
        return None
    every = F.lit(True)
    for i in range(WORDS):
        every = every & (F.col(f"wort{i}").bitwiseAND(F.col(f"bit{i}")) != 0)
    met = filters.join(F.broadcast(asked), ["bloecke", "block"]).where(every)
    return [r[0] for r in met.select(by).distinct().collect()]
