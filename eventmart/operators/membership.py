"""Membership filters kept beside the stored dimensions.

A filter is a blocked Bloom filter as a small table: a row is a block of 256 bits (four
words), and a member sets eight bits of one block. Loads add the blocks of their own new
members as one more part; parts are merged by OR, so nothing is built twice. At twelve
bits a member about one stranger in two hundred is taken for a member, and a member
never for a stranger: what a filter doesn't know is new without a look at the dimension.
The filter is about a twentieth of a dimension's bytes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS = [f"w{k}" for k in range(4)]
FILTER = T.StructType([T.StructField(c, T.LongType()) for c in ("blocks", "block", *WORDS)])
BITS_EACH, BITS = 12, 8
LEAST_BLOCKS = 1024


def blocks_for(members: int) -> int:
    """Blocks for so many members and as many to come, a power of two."""
    wanted = max(LEAST_BLOCKS, 2 * members * BITS_EACH // 256)
    return 1 << (wanted - 1).bit_length()


def _bits(keys: Sequence[str], blocks: int) -> tuple[Column, list[Column]]:
    """The block of a member and the bits it sets in each word."""
    block = F.pmod(F.xxhash64(*keys), F.lit(blocks))
    mark = F.xxhash64(F.lit("member"), *keys)
    places = [F.shiftrightunsigned(mark, 8 * i).bitwiseAND(F.lit(255)) for i in range(BITS)]
    one = F.lit(1).cast("long")
    words = []
    for k in range(len(WORDS)):
        set_ = [F.when(F.shiftright(p, 6) == k, F.call_function("shiftleft", one, p.bitwiseAND(F.lit(63)).cast("int"))).otherwise(F.lit(0).cast("long")) for p in places]
        words.append(reduce(lambda a, b: a.bitwiseOR(b), set_))
    return block, words


def build(members: DataFrame, keys: Sequence[str], blocks: int) -> DataFrame:
    """The part of a filter that ``members`` make, one row per block they touch."""
    block, words = _bits(keys, blocks)
    marked = members.select(block.alias("block"), *[w.alias(c) for w, c in zip(words, WORDS, strict=True)])
    merged = marked.groupBy("block").agg(*[F.bit_or(c).alias(c) for c in WORDS])
    return merged.select(F.lit(blocks).cast("long").alias("blocks"), "block", *WORDS)


def possible(candidates: DataFrame, keys: Sequence[str], parts: DataFrame, blocks: int) -> DataFrame:
    """The candidates that may be members: the others surely aren't.

    Candidates are sent to the scan of the filter, so their size is the caller's to
    check; a candidate meets one row per part.
    """
    block, words = _bits(keys, blocks)
    own = [f"own_{c}" for c in WORDS]
    asked = candidates.select(*keys, block.alias("block"), *[w.alias(c) for w, c in zip(words, own, strict=True)])
    met = parts.join(F.broadcast(asked), "block").groupBy(*keys, *own).agg(*[F.bit_or(c).alias(c) for c in WORDS])
    whole = reduce(lambda a, b: a & b, [F.col(w).bitwiseAND(F.col(o)) == F.col(o) for w, o in zip(WORDS, own, strict=True)])
    return met.where(whole).select(*keys)
