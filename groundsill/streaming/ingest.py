"""Files in, approved chunks out, as a stream that can be stopped, killed and replayed.

The stream's state holds the ids of the chunks it has let through, so a trigger reads nothing of the table
it writes. Each trigger writes a folder of its own, named by the stream and the trigger, and a marker last;
a trigger that died between its writes comes again under the same name and replaces what it left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from groundsill.operators.chunking import all_chunks
from groundsill.schemas import CHUNK, KNOWLEDGE, enforce
from groundsill.sources import paths

BATCH = "ingest_batch"
COMMITS = "_commits"
ADOPTED = "_adopted"
_ID = "knowledge_chunk_id"


def new_chunks(chunks: DataFrame, existing: DataFrame) -> DataFrame:
    """Chunks whose id the table does not hold yet, each once.

    Ids are derived from content, so a replay of the same rows yields nothing.
    """
    fresh = chunks.dropDuplicates([_ID])
    return fresh.join(existing.select(_ID), _ID, "left_anti")


def committed(spark: SparkSession, target: str) -> list[str]:
    """Names of the triggers that are complete."""
    return paths.children(spark, f"{target.rstrip('/')}/{COMMITS}")


def read_ingested(spark: SparkSession, target: str, fmt: str = "parquet",
                  without: str | None = None) -> DataFrame:
    """The table: files that were there before, and the folders of complete triggers.

    What an unfinished trigger wrote does not show. ``without`` leaves out one stream's folders.
    """
    root = target.rstrip("/")
    places = [f"{root}/{BATCH}={name}" for name in committed(spark, target)
              if without is None or not name.startswith(f"{without}-")]
    places = [p for p in places if paths.files(spark, p)]
    places += [f"{root}/{name}" for name, _ in paths.files(spark, root)]
    if not places:
        return spark.createDataFrame([], CHUNK)
    return spark.read.format(fmt).schema(CHUNK).load(places)


def _write(df: DataFrame, path: str, fmt: str) -> None:
    df.write.format(fmt).mode("overwrite").save(path)


def _adopted(spark: SparkSession, target: str, stream: str, fmt: str) -> DataFrame | None:
    """Ids that the table held before this stream began; None if it held none. Told once a stream: the
    ids alone are written down, and only if there are any."""
    root = target.rstrip("/")
    place, nothing = f"{root}/{ADOPTED}/{stream}", f"{root}/{ADOPTED}/{stream}-none"
    if paths.exists(spark, nothing):
        return None
    if not paths.exists(spark, f"{place}/_SUCCESS"):
        before = read_ingested(spark, target, fmt, without=stream).select(_ID)
        if before.isEmpty():
            paths.touch(spark, nothing)
            return None
        before.distinct().write.mode("overwrite").parquet(place)
    return spark.read.parquet(place)


def ingest_stream(spark: SparkSession, source: str, target: str, checkpoint: str,
                  created_at: Column, fmt: str = "parquet",
                  max_files: int = 1000, rejected: str | None = None,
                  remember: str | None = None) -> StreamingQuery:
    """Process every knowledge file not seen before, add its new chunks, then stop.

    Ids seen are kept in the state store (RocksDB in ``build_session``), for ever, or for
    ``remember`` (as "30 days") after a file's modification time, if files older than that do not
    come again. A stream with a new checkpoint leaves out what the table held when it began. One stream
    at a time may write to a target. Rows without a knowledge id go to ``rejected`` (by default a
    folder beside the target), in folders of the same names.
    """
    incoming = (
        spark.readStream.schema(KNOWLEDGE).format(fmt)
        .option("maxFilesPerTrigger", max_files).load(source)
    )
    named = F.col("knowledge_id").isNotNull()
    chunks = all_chunks(incoming.where(named), created_at)
    if remember is None:
        once = chunks.dropDuplicates([_ID])
    else:
        arrived = incoming.where(named).withColumn(
            "_arrived", F.col("_metadata.file_modification_time")).withWatermark("_arrived", remember)
        once = all_chunks(arrived, created_at, ["_arrived"]).dropDuplicatesWithinWatermark([_ID]).drop(
            "_arrived")
    left_out = incoming.where(~named).select(
        F.struct(*incoming.columns).alias("_rejected"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in CHUNK.fields])
    kind = T.StructType([T.StructField(f.name, f.dataType) for f in KNOWLEDGE.fields])
    both = once.withColumn("_rejected", F.lit(None).cast(kind)).unionByName(left_out)
    root = target.rstrip("/")
    aside = (rejected or f"{root}_rejected").rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        name = f"{stream}-{batch_id:010d}"
        marker = f"{root}/{COMMITS}/{name}"
        if paths.exists(session, marker):
            return
        before = _adopted(session, target, stream, fmt)
        batch = batch.persist()
        try:
            _write(batch.where("_rejected is not null").select("_rejected.*"), f"{aside}/{BATCH}={name}",
                   fmt)
            fresh = batch.where("_rejected is null").drop("_rejected")
            if before is not None:
                fresh = fresh.join(before, _ID, "left_anti")
            _write(enforce(fresh, CHUNK), f"{root}/{BATCH}={name}", fmt)
            paths.touch(session, marker)
        finally:
            batch.unpersist()

    return (
        both.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(write).start()
    )
