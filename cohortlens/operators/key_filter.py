"""A Bloom filter over keys, as a table of bitmaps of bounded size.

A key hashes to one of the table's blocks and to two bits of that block, so a row is tested with one join to a table that
is small enough to be broadcast whatever the number of keys. A row whose key is among them always passes; of the others
few do, as long as there are clearly fewer keys than bits. What needs to be exact is joined again on what has passed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 8 * 4096  # of a bitmap as Spark's bitmap functions have it
BLOCKS = 1024  # 4 MiB at most, and about 1 row in 30 too many at three million keys


def _place(key: Column, blocks: int) -> tuple[Column, Column, Column]:
    """Block, and two bits in it. Masks rather than remainders: they are never null, so Spark infers no filter of them."""
    if blocks & (blocks - 1):
        raise ValueError("the number of blocks has to be a power of two")
    one, two = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    in_block = F.lit(BLOCK_BITS - 1)
    return one.bitwiseAND(blocks - 1), F.shiftright(one, 32).bitwiseAND(in_block), two.bitwiseAND(in_block)


def key_filter(keys: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """The filter of all values of ``key``: rows of key_block and bits, a row for each block in use at most.

    A null sets two bits and is asked for by no row. It is not filtered out: the filter would be pushed into the plan of
    ``keys``, which then could not be shared with those who read all of them.
    """
    block, first, second = _place(F.col(key), blocks)
    placed = keys.select(block.alias("key_block"), F.explode(F.array(first, second)).alias("bit"))
    return placed.groupBy("key_block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def may_hold(rows: DataFrame, key: str, wanted: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """The ``rows`` whose ``key`` may be one that the filter was built of; no null is."""
    block, first, second = _place(F.col(key), blocks)
    tested = rows.where(F.col(key).isNotNull()).withColumn("key_block", block)
    # at most ``blocks`` rows of 4 KiB
    met = tested.join(F.broadcast(wanted), "key_block")
    return met.where(_is_set(first) & _is_set(second)).drop("key_block", "bits")


def _is_set(bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring("bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    mask = F.call_function("shiftleft", F.lit(1), bit.bitwiseAND(7).cast("int"))
    return byte.bitwiseAND(mask) != 0
