"""A blocked Bloom filter as a small table, built and probed with built-in functions only.

A key sets eight bits within one block of 256 bits, held as four longs. The filter has one row per
block, so its size is settled by ``blocks`` and never grows with the keys: that bound is what makes
it safe to broadcast. With many more keys than bits it only lets more rows through; whoever probes
it confirms hits by an exact join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = 1 << 15
MAX_BLOCKS = 1 << 18
_WORDS = 4


def _block(key_hash: Column, blocks: int) -> Column:
    return F.pmod(F.shiftrightunsigned(key_hash, 17), F.lit(blocks).cast("bigint"))


def _masks(key_hash: Column) -> list[Column]:
    """Two bits for each of the four words, from 6-bit pieces of a second hash."""
    second = F.xxhash64(key_hash, F.lit("bits"))

    def bit(piece: int) -> Column:
        place = F.shiftrightunsigned(second, 6 * piece).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)

    return [bit(2 * w).bitwiseOR(bit(2 * w + 1)) for w in range(_WORDS)]


def build(keys: DataFrame, key_hash: Column, blocks: int = BLOCKS) -> DataFrame:
    """The filter of all non-null hashes in ``keys``: ``block, w0..w3``, at most ``blocks`` rows."""
    if not 1 <= blocks <= MAX_BLOCKS:
        raise ValueError(f"blocks must be 1 to {MAX_BLOCKS}, so that the filter may be broadcast")
    masked = keys.select(key_hash.alias("_h")).where("_h is not null").select(
        _block(F.col("_h"), blocks).alias("block"),
        *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("_h")))])
    return masked.groupBy("block").agg(
        *[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(_WORDS)])


def _probe(df: DataFrame, key_hash: Column, built: DataFrame, blocks: int, how: str) -> DataFrame:
    names = {f"w{i}": f"_bloom_w{i}" for i in range(_WORDS)} | {"block": "_bloom_block"}
    filter_rows = built.withColumnsRenamed(names)
    test = reduce(lambda a, b: a & b, [
        F.col(f"_bloom_w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(key_hash))])
    return df.join(
        F.broadcast(filter_rows), (_block(key_hash, blocks) == F.col("_bloom_block")) & test, how)


def maybe_in(df: DataFrame, key_hash: Column, built: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Rows of ``df`` whose hash may be among the filter's keys; never loses one that is."""
    return _probe(df, key_hash, built, blocks, "left_semi")


def not_in(df: DataFrame, key_hash: Column, built: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """The other rows: those whose hash is surely not among the filter's keys, or null."""
    return _probe(df, key_hash, built, blocks, "left_anti")
