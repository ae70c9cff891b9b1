"""Where two runs of a job differ, told from small digests before any rows are compared.

A table's rows are dealt to key ranges by a hash of their key, and each range is summed up in a count and
two 64-bit sums of row hashes. Sums do not depend on order or partitions, digests of parts of a table add up to
the digest of the whole, and rows that occur twice do not cancel out. Two runs are compared by one small row
a range; only rows of ranges that differ are looked at, by their keys and hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGES = 4096
_WHOLE = "decimal(38,0)"


def _rows(df: DataFrame, keys: list[str], columns: list[str] | None, ranges: int) -> DataFrame:
    """Keys, range and two hashes of each row; nested values and nulls count, field by field."""
    said = F.to_json(F.struct(*sorted(columns or df.columns)), {"ignoreNullFields": "false"})
    return df.select(
        *keys, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(ranges)).cast("int")
        .alias("key_range"),
        F.xxhash64(said).alias("_a"), F.xxhash64(F.lit("second"), said).alias("_b"))


def _sums(*counted: Column) -> list[Column]:
    def total(name: str) -> Column:
        # A sum of longs in 38 digits cannot overflow; what is kept is its last 64 bits.
        return F.pmod(F.sum(F.col(name).cast(_WHOLE)), F.expr(f"cast(18446744073709551616 as {_WHOLE})")
                      ).cast("decimal(20,0)")

    return [*counted, total("_a").alias("digest_a"), total("_b").alias("digest_b")]


def fingerprint(df: DataFrame, keys: list[str], columns: list[str] | None = None,
                ranges: int = RANGES) -> DataFrame:
    """``key_range, rows, digest_a, digest_b``: at most ``ranges`` rows, folded before they move."""
    return _rows(df, keys, columns, ranges).groupBy("key_range").agg(*_sums(F.count("*").alias("rows")))


def whole(parts: DataFrame) -> DataFrame:
    """One row for the table from its ranges, or for several parts of it from theirs."""
    named = parts.withColumnsRenamed({"digest_a": "_a", "digest_b": "_b"})
    return named.agg(*_sums(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))).select(
        "rows", *[F.coalesce(c, F.lit(0)).cast("decimal(20,0)").alias(c) for c in ("digest_a", "digest_b")])


def differing(before: DataFrame, after: DataFrame) -> DataFrame:
    """The numbers of the ranges whose fingerprints are not equal."""
    same = ["rows", "digest_a", "digest_b"]
    joined = before.join(
        after.withColumnsRenamed({c: f"_{c}" for c in same}), "key_range", "full")
    equal = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same])
    return joined.where(~equal).select("key_range")


def changes(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str] | None = None,
            ranges: int = RANGES) -> DataFrame:
    """Keys with ``change``: ADDED, REMOVED or CHANGED (other values, or another number of rows).

    Null keys equal each other. Only keys and hashes of rows in differing ranges are joined.
    """
    found = differing(fingerprint(before, keys, columns, ranges), fingerprint(after, keys, columns, ranges))

    def suspects(df: DataFrame) -> DataFrame:
        rows = _rows(df, keys, columns, ranges).join(F.broadcast(found), "key_range", "left_semi")
        return rows.groupBy(*keys).agg(*_sums(F.count("*").alias("rows")))

    old = suspects(before)
    new = suspects(after).withColumnsRenamed({c: f"_new_{c}" for c in [*keys, "rows", "digest_a", "digest_b"]})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    joined = old.join(new, on, "full")
    equal = reduce(lambda a, b: a & b, [
        F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in ("rows", "digest_a", "digest_b")])
    return joined.where(~equal).select(
        *[F.when(F.col("rows").isNull(), F.col(f"_new_{k}")).otherwise(F.col(k)).alias(k) for k in keys],
        F.when(F.col("rows").isNull(), "ADDED").when(F.col("_new_rows").isNull(), "REMOVED")
        .otherwise("CHANGED").alias("change"))
