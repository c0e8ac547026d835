"""A filter of bits that says which keys cannot be on a list, made and asked with built-in functions.

A key has one block of 32,768 bits, by a hash, and sets ``HASHES`` bits in it.  The filter is a table of blocks, at most
``blocks`` rows of four kilobytes whatever the length of the list, so it may be sent to every executor; filters of parts
of a list are merged block by block.  A key whose bits are not all set is not on the list; the others have to be looked
up.  With 64 bits a key about one in two hundred keys is looked up in vain.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Eight megabytes; room for a million keys at 64 bits each.
BLOCKS = 2048
BLOCK_BITS = 32_768
HASHES = 4


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(0)), F.lit(blocks)).cast("int")


def _bits(key: str) -> list[Column]:
    return [F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(BLOCK_BITS)) for i in range(1, HASHES + 1)]


def membership_bits(listed: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """(block, bits) of a list; keys that are null set none."""
    keys = listed.where(F.col(key).isNotNull())
    each = keys.select(_block(key, blocks).alias("block"), F.explode(F.array(*_bits(key))).alias("bit"))
    return each.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merged_bits(parts: DataFrame) -> DataFrame:
    """One filter from the blocks of several."""
    return parts.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def _is_set(bits: str, position: Column) -> Column:
    byte = F.substring(F.col(bits), (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return value.bitwiseAND(F.get(F.array(*[F.lit(1 << i) for i in range(8)]), (position % 8).cast("int"))) != 0


def may_be_listed(df: DataFrame, key: str, bits: DataFrame, out: str, blocks: int = BLOCKS) -> DataFrame:
    """Add whether a key may be on the list; false is certain."""
    sent = F.broadcast(bits.select(F.col("block").alias("_block"), F.col("bits").alias("_bits")))
    joined = df.join(sent, _block(key, blocks) == F.col("_block"), "left")
    hit = functools.reduce(lambda a, b: a & b, [_is_set("_bits", p) for p in _bits(key)])
    return joined.withColumn(out, F.coalesce(F.col(key).isNotNull() & F.col("_bits").isNotNull() & hit, F.lit(False))).drop("_block", "_bits")


def membership_anti_join(df: DataFrame, listed: DataFrame, key: str, bits: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Rows whose key is not on a list of any length.

    Rows that the filter lets go stay where they are; only those that may be listed are dealt by their key.  ``bits`` has
    to hold at least what ``listed`` does.  ``df`` is read twice.
    """
    asked = may_be_listed(df, key, bits, "_maybe", blocks)
    free = asked.where(~F.col("_maybe")).drop("_maybe")
    looked_up = asked.where("_maybe").drop("_maybe").join(listed.select(key), key, "left_anti")
    return free.unionByName(looked_up)
