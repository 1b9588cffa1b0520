"""A Bloom filter of keys, built by an aggregate and probed where rows are scanned.

The filter is a table of blocks of 32,768 bits. A hash of a key picks its block and four bits in it,
so probing is one broadcast join on the block and no shuffle. The table is bounded by ``BLOCKS``
blocks of 4 KB, 32 MB, whatever the number of keys; it then lets more rows through, never fewer.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, PROBES, BLOCKS = 1 << 15, 4, 1 << 13
#: Bits for each key: with four probes about two rows in a hundred that match no key get through.
PER_KEY = 10


def _places(key: str, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key and its bits there."""
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
    bits = F.xxhash64(F.lit(1), key)
    return block, [F.shiftrightunsigned(bits, 15 * i).bitwiseAND(F.lit(BITS - 1)).cast("int") for i in range(PROBES)]


def bloom_filter(keys: DataFrame, key: str) -> tuple[DataFrame, int]:
    """((_block, _bits), number of blocks) of the values of ``key``; they are counted in a pass before."""
    n = keys.agg(F.approx_count_distinct(key)).first()[0]
    blocks = max(1, min(BLOCKS, -(-n * PER_KEY // BITS)))
    block, bits = _places(key, blocks)
    spots = keys.where(F.col(key).isNotNull()).select(block.alias("_block"), F.explode(F.array(*bits)).alias("_bit"))
    return spots.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bits")), blocks


def maybe_among(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``keys``; none that is in it goes.

    Rows with a null key go. The filter is below any shuffle of ``rows``.
    """
    filter_, blocks = bloom_filter(keys, key)
    block, bits = _places(key, blocks)

    def has(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, bit % 8) == 1

    probed = rows.where(F.col(key).isNotNull()).withColumn("_block", block).join(F.broadcast(filter_), "_block")
    return probed.where(functools.reduce(operator.and_, map(has, bits))).select(*rows.columns)
