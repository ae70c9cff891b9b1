"""Dense numbers over a whole table without putting it in one partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from groundsill.session import materialize

# Spark packs (partition, position) into one long; these are its documented bits.
_POSITION_BITS = 33


def dense_numbers(df: DataFrame, key: str, out: str, partitions: int | None = None) -> DataFrame:
    """Adds ``out`` = 0..n-1 in ascending order of ``key``, which must be unique.

    One range shuffle and a sort per partition give each row its partition and position. The
    result is written once, because both the counts and the rows must come from the same
    physical layout. Only one count per partition is then summed and broadcast, so what is
    broadcast is bounded by the number of partitions.
    """
    ranged = (
        df.repartitionByRange(partitions, key) if partitions else df.repartitionByRange(key)
    )
    placed = ranged.sortWithinPartitions(key).withColumn(
        "_slot", F.monotonically_increasing_id()
    )
    pinned = materialize(
        placed.withColumn("_part", F.shiftright("_slot", _POSITION_BITS))
        .withColumn("_pos", F.col("_slot").bitwiseAND((1 << _POSITION_BITS) - 1))
        .drop("_slot")
    )
    sizes = pinned.groupBy("_part").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    return (
        pinned.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_pos") + F.col("_offset"))
        .drop("_part", "_pos", "_offset")
    )
