"""Rows that weren't seen before, with a Bloom filter ahead of the exact comparison.

The filter is a table (block, mask) of 64-bit blocks: a key sets four bits of one
block. Each task combines the masks of its keys and shuffles a row a block; two filters of
one size are merged the same way, so that a filter can be kept beside the table of
seen keys and grow with it. Rows whose bits aren't all set are new for sure and
stay where they are; only the others, repeats and the few that the filter lets
through, go into the join that decides. The result is that of an anti join.

The filter is broadcast up to ``MOST_BLOCKS`` blocks (64 MB, of 44 million keys
at twelve bits each). Beyond, rows meet the seen keys in a plain anti join, as a
filter of that size would have to be shuffled to as well.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import unseen

#: Bits of the filter for each key, and bits that a key sets.
BITS_A_KEY, BITS_SET = 12, 4
MOST_BLOCKS = 1 << 23
#: Blocks that travel as one row of the broadcast.
PACK = 1 << 10


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("bigint"))


def _mask(key: Column) -> Column:
    bits = F.xxhash64(F.lit("bits"), key)
    ones = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS_SET)]
    return reduce(Column.bitwiseOR, ones)


def blocks_for(keys: int) -> int:
    """Blocks of a filter for so many keys: a power of two, a pack at least."""
    return max(PACK, 1 << (max(1, keys) * BITS_A_KEY // 64).bit_length())


def seen_filter(seen: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, mask) of the keys; null is never seen. Blocks without a key have no row."""
    keys = seen.where(F.col(key).isNotNull())
    return keys.select(_block(F.col(key), blocks).alias("block"), _mask(F.col(key)).alias("mask")).groupBy("block").agg(F.bit_or("mask").alias("mask"))


def merged(*filters: DataFrame) -> DataFrame:
    """The filter of the keys of all; they are of one number of blocks."""
    return reduce(DataFrame.unionByName, filters).groupBy("block").agg(F.bit_or("mask").alias("mask"))


def _packed(found: DataFrame, blocks: int) -> DataFrame:
    """(_pack, _words): the masks of ``PACK`` blocks in order, 0 for blocks without a key."""
    none = found.sparkSession.range(blocks).select(F.col("id").alias("block"), F.lit(0).cast("bigint").alias("mask"))
    words = F.transform(F.array_sort(F.collect_list(F.struct("block", "mask"))), lambda x: x["mask"])
    return merged(found, none).groupBy(F.shiftright("block", PACK.bit_length() - 1).alias("_pack")).agg(words.alias("_words"))


def marked(rows: DataFrame, found: DataFrame, key: str, blocks: int, name: str = "possible") -> DataFrame:
    """``rows`` with whether the filter lets their key through."""
    held = rows.withColumn("_block", _block(F.col(key), blocks)).withColumn("_pack", F.shiftright("_block", PACK.bit_length() - 1))
    word = F.get("_words", F.col("_block").bitwiseAND(F.lit(PACK - 1)).cast("int"))
    met = held.join(F.broadcast(_packed(found, blocks)), "_pack")
    return met.withColumn(name, F.col(key).isNotNull() & (word.bitwiseAND(_mask(F.col(key))) == _mask(F.col(key)))).select(*rows.columns, name)


def unseen_filtered(rows: DataFrame, seen: DataFrame, key: str = "hash", found: DataFrame | None = None, blocks: int | None = None) -> DataFrame:
    """Rows whose key isn't among those seen, and rows without a key.

    ``found`` is a kept filter of at least the keys of ``seen``, of ``blocks``
    blocks; without it one is made, for which the keys are counted first. Keys are
    of one type on both sides, and no floating-point numbers.
    """
    kinds = {dict(x.select(key).dtypes)[key] for x in (rows, seen)}
    if len(kinds) > 1 or kinds & {"float", "double"}:
        raise ValueError(f"keys of {sorted(kinds)} don't hash alike")
    if found is not None and blocks is None:
        raise ValueError("a kept filter needs its number of blocks")
    if blocks is None:
        blocks = blocks_for(seen.agg(F.approx_count_distinct(key)).first()[0])
    if blocks > MOST_BLOCKS:
        return unseen(rows, seen, key).select(rows.columns)
    met = marked(rows, found if found is not None else seen_filter(seen, key, blocks), key, blocks, "_possible")
    doubtful = met.where("_possible").drop("_possible")
    return met.where("not _possible").drop("_possible").unionByName(unseen(doubtful, seen, key).select(rows.columns))
