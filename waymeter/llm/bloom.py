"""A blocked Bloom filter as DataFrame expressions.

Each key sets eight bits of one 256-bit block, so a probe is one lookup. Keys that pass are
possible hits; an exact join has to remove the false ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WORDS = 8
#: A filter of at most so many blocks (about 100 bytes a row, 6 MB) is sent to every executor.
BROADCAST_BLOCKS = 1 << 16
BITS_PER_KEY = 16


def _bit(key: Column, word: int) -> Column:
    return F.shiftright(F.xxhash64(key, F.lit(1)), 5 * word).bitwiseAND(F.lit(31)).cast("int")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def blocks_for(keys: int, bits_per_key: int = BITS_PER_KEY) -> int:
    return max(1, -(-keys * bits_per_key // (32 * WORDS)))


def bloom_blocks(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter: one row per used block, with eight words of 32 bits."""
    bits = {f"_w{i}": F.expr(f"shiftleft(1L, _b{i})") for i in range(WORDS)}
    rows = listed.select(_block(F.col(key), blocks).alias("_block"), *[_bit(F.col(key), i).alias(f"_b{i}") for i in range(WORDS)])
    return rows.groupBy("_block").agg(*[F.bit_or(value).alias(name) for name, value in bits.items()])


def probed(rows: DataFrame, key: Column, bloom: DataFrame, blocks: int) -> tuple[DataFrame, Column]:
    """``rows`` beside the block of their key, and whether the key has all its bits there."""
    rows = rows.withColumns({"_at": _block(key, blocks), "_h": F.xxhash64(key, F.lit(1))})
    rows = rows.join(bloom, F.col("_at") == F.col("_block"), "left")
    hit = F.lit(True)
    for i in range(WORDS):
        bit = F.shiftright("_h", 5 * i).bitwiseAND(F.lit(31)).cast("int")
        hit &= F.call_function("getbit", F.coalesce(f"_w{i}", F.lit(0).cast("bigint")), bit) == 1
    return rows, hit


def split(rows: DataFrame, key: Column, known: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be in the column ``name`` of the stored table ``known``, and those whose key surely is not.

    The filter is always broadcast and has BROADCAST_BLOCKS blocks at most, so no row is
    shuffled. Beyond 16 bits for each key it only lets more rows pass as possible.
    """
    blocks = min(BROADCAST_BLOCKS, blocks_for(known.count()))
    beside, hit = probed(rows, key, F.broadcast(bloom_blocks(known, name, blocks)), blocks)
    possible, clear = beside.filter(hit), beside.filter(~hit)
    return possible.select(*rows.columns), clear.select(*rows.columns)
