"""Reading the given tables and leaving out listed rows, for all operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from groundsill.llm import bloom
from groundsill.session import in_small_batches, materialize

__all__ = ["bounded_sample", "free_name", "in_small_batches", "table", "without"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, also not in other capitals."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose id is not in the one column of ``ids``; null ids stay.

    A Bloom filter of the ids lets most other rows pass where they were read, so that only
    possible hits are shuffled to the exact anti join.
    """
    listed = materialize(ids.select(F.col(ids.columns[0]).cast("long").alias("_listed_id")).distinct())
    built = bloom.build(listed, F.xxhash64("_listed_id"))
    own = F.col(id_col).cast("long")
    key = F.when(own.isNotNull(), F.xxhash64(own))
    return bloom.not_in(df, key, built).unionByName(
        bloom.maybe_in(df, key, built).join(listed, own == F.col("_listed_id"), "left_anti"))


def bounded_sample(df: DataFrame, key: str, most: int, order: Column) -> DataFrame:
    """At most ``most`` rows per key, those first in ``order`` (a hash of what the rows say).

    A count per key first gives the share of the hash range that holds about three times the sample;
    so a key with a third of all rows does not bring more than that to one task.
    """
    # Stored, so that Spark knows how small the counts are and moves them instead of the rows.
    sizes = materialize(df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_have")))
    share = F.least(F.lit(1.0), F.lit(3.0 * most + 30) / F.col("_have"))
    ranked = df.withColumn("_order", order).join(
        sizes, F.col(key).eqNullSafe(F.col("_key"))).where(
            F.pmod(F.hash("_order"), F.lit(1 << 20)) <= share * (1 << 20)).drop("_key", "_have")
    return ranked.withColumn("_rank", F.row_number().over(
        Window.partitionBy(key).orderBy("_order"))).where(F.col("_rank") <= most).drop("_rank")
