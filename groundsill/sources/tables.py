"""Tables on shared storage. The format is a parameter; parquet needs nothing extra."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from groundsill.schemas import enforce
from groundsill.session import materialize
from groundsill.sources import paths


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None,
               fmt: str = "parquet") -> DataFrame:
    df = spark.read.format(fmt).load(path)
    return df.select(*columns) if columns else df


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make a table available by name and return it read back by that name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def create_empty(spark: SparkSession, schema: T.StructType, path: str,
                 fmt: str = "parquet") -> None:
    """Start a table from its contract alone; whatever was there is replaced."""
    spark.createDataFrame([], schema).write.format(fmt).mode("overwrite").save(path)


def append(df: DataFrame, schema: T.StructType, path: str, fmt: str = "parquet",
           partition_by: list[str] | None = None) -> None:
    writer = enforce(df, schema).write.format(fmt).mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet",
              partition_by: list[str] | None = None) -> None:
    """Replace a table. ``df`` must not read from ``path`` itself."""
    writer = df.write.format(fmt).mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


BUCKET = "key_bucket"
_COUNT = "_buckets-"


def _bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    hashed = F.xxhash64(*[F.col(k).cast("string") for k in keys])
    return df.withColumn(BUCKET, F.pmod(hashed, F.lit(buckets)).cast("int"))


def create_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int,
                    fmt: str = "parquet") -> None:
    """Start a table in folders by a hash of its key, for ``upsert_buckets``. Rows of a bucket make one
    task, so ``buckets`` is to be set to what the table will need when it has grown."""
    _bucketed(df, keys, buckets).repartitionById(buckets, BUCKET).write.format(fmt).partitionBy(
        BUCKET).save(path)
    paths.touch(df.sparkSession, f"{path.rstrip('/')}/{_COUNT}{buckets}")


def read_bucketed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path).drop(BUCKET)


def upsert_buckets(changes: DataFrame, path: str, keys: list[str], newest_first: list[str],
                   fmt: str = "parquet") -> list[int]:
    """Merge ``changes`` into a bucketed table in place; returns the buckets that were rewritten.

    Only folders that hold a changed key are read and replaced; files of all others stay as they are.
    Where ``changes`` holds a key more than once the newest row wins; null keys equal each other.
    The merged rows are written aside before any folder is replaced. Folders are replaced one by
    one, so after a crash each is old or new, and merging the same changes again ends the same.
    """
    spark = changes.sparkSession
    counts = [n for n in paths.children(spark, path) if n.startswith(_COUNT)]
    if len(counts) != 1:
        raise ValueError(f"not a bucketed table: {path}")
    buckets = int(counts[0].removeprefix(_COUNT))
    latest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in newest_first])
    incoming = materialize(_bucketed(
        changes.withColumn("_nth", F.row_number().over(latest)).where("_nth = 1").drop("_nth"),
        keys, buckets))
    # At most one number per bucket comes back.
    touched = sorted(r[0] for r in incoming.select(BUCKET).distinct().collect())
    if not touched:
        return []
    current = spark.read.format(fmt).load(path).where(F.col(BUCKET).isin(touched))
    own = incoming.select(*[F.col(k).alias(f"_own_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_own_{k}")) for k in keys])
    merged = materialize(current.join(own, same, "left_anti").unionByName(
        incoming.select(*current.columns)))
    merged.repartitionById(buckets, BUCKET).write.format(fmt).partitionBy(BUCKET).option(
        "partitionOverwriteMode", "dynamic").mode("overwrite").save(path)
    return touched


def upsert(current: DataFrame, changes: DataFrame, keys: list[str],
           newest_first: list[str]) -> DataFrame:
    """The table after merging ``changes`` into ``current`` by key.

    Where ``changes`` holds a key more than once the newest row wins. Both sides are shuffled
    once on the key. The result is a new snapshot to be written to a folder of its own.
    """
    latest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in newest_first])
    incoming = (
        changes.withColumn("_nth", F.row_number().over(latest)).where("_nth = 1").drop("_nth")
    )
    untouched = current.join(incoming.select(*keys), keys, "left_anti")
    return untouched.unionByName(incoming.select(*current.columns))
