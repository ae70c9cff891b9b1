"""Which chunks still need vectors, in which batch, and how a run went."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundsill.functions import bind
from groundsill.functions import vectors as vx
from groundsill.functions.ids import text_hash
from groundsill.operators.numbering import dense_numbers
from groundsill.policy import RunLimits
from groundsill.session import ship_with_tasks
from groundsill.sources.tables import upsert


ship_with_tasks(__name__)


def backlog(chunks: DataFrame, embeddings: DataFrame, model_name: str) -> DataFrame:
    """Chunks without a successful vector of this model. Failed ones come back for a retry.

    Only the ids of the done side travel.
    """
    done = embeddings.where(
        (F.col("status") == "SUCCESS") & (F.col("embedding_model_name") == model_name)
    ).select("knowledge_chunk_id")
    return chunks.join(done, "knowledge_chunk_id", "left_anti")


def batches(chunks: DataFrame, limits: RunLimits = RunLimits()) -> DataFrame:
    """Narrow table of chunk id, row number from 1 and batch number from 0, in id order."""
    size = min(limits.batch_size, limits.batch_cap)
    numbered = dense_numbers(
        chunks.select("knowledge_chunk_id", "chunk_token_count"), "knowledge_chunk_id", "_n"
    )
    return numbered.select(
        "knowledge_chunk_id", "chunk_token_count",
        (F.col("_n") + 1).alias("row_num"),
        F.floor(F.col("_n") / size).cast("int").alias("batch_id"),
    )


def batch_tracking(results: DataFrame) -> DataFrame:
    """Size, start, end and status per batch of embedding results."""
    failed = F.count_if(F.col("status") != "SUCCESS")
    return results.groupBy("batch_id").agg(
        F.count("*").alias("batch_size"),
        F.min("started_at").alias("batch_start_time"),
        F.max("ended_at").alias("batch_end_time"),
        F.when(failed > 0, "FAILED").otherwise("SUCCESS").alias("batch_status"),
    )


NEWEST_FIRST = ["embedded_at", "embedding_model_version", "pipeline_run_id", "chunk_text_hash"]


def merge_embeddings(current: DataFrame, changes: DataFrame) -> DataFrame:
    """New snapshot of the embedding table after a run."""
    return upsert(
        current, changes, ["knowledge_chunk_id", "embedding_model_name"], NEWEST_FIRST)


def embedding_checks(embeddings: DataFrame) -> DataFrame:
    """Stored successes: missing vectors, wrong lengths, dimensions in use, zero norms."""
    vector = F.col("embedding_vector")
    return embeddings.where("status = 'SUCCESS'").agg(
        F.count("*").alias("success_rows"),
        F.count_if(vector.isNull()).alias("null_vectors"),
        F.count_if(F.size(vector) != F.col("embedding_dimension")).alias("length_mismatch"),
        F.min("embedding_dimension").alias("min_dimension"),
        F.max("embedding_dimension").alias("max_dimension"),
        F.count_if(vx.norm(vector) == 0).alias("zero_norm"),
    )


def stale(embeddings: DataFrame, chunks: DataFrame) -> DataFrame:
    """Successful vectors whose stored text hash differs from the chunk's text today.

    The text is hashed before the join, so only hashes are shuffled.
    """
    stored = embeddings.where("status = 'SUCCESS'").select(
        "knowledge_chunk_id", "embedding_model_name", "embedding_model_version",
        "chunk_text_hash",
    )
    current = chunks.select(
        "knowledge_chunk_id", text_hash(F.col("chunk_text")).alias("current_hash")
    )
    return stored.join(current, "knowledge_chunk_id").where(
        ~F.col("chunk_text_hash").eqNullSafe(F.col("current_hash"))
    )


def run_metrics(calls: DataFrame, scanned: DataFrame, limits: RunLimits = RunLimits()) -> DataFrame:
    """One row per run.

    ``scanned`` has ``pipeline_run_id`` and ``is_quarantined`` per chunk; ``calls`` has one
    row per service call with status, latency in whole milliseconds and tokens. Latency is an
    integer below the service timeout, so the percentile's state is bounded.
    """
    chunk_side = scanned.groupBy("pipeline_run_id").agg(
        F.count("*").alias("total_chunks_scanned"),
        F.count_if(~F.col("is_quarantined")).alias("total_chunks_eligible"),
        F.count_if("is_quarantined").alias("total_chunks_quarantined"),
    )
    call_side = calls.groupBy("pipeline_run_id").agg(
        F.count_if(F.col("status") == "SUCCESS").alias("total_chunks_embedded"),
        F.count_if(F.col("status") == "FAILED").alias("total_chunks_failed"),
        F.count("*").alias("total_api_calls"),
        F.avg("latency_ms").alias("average_latency_ms"),
        F.percentile("latency_ms", F.lit(0.95)).alias("p95_latency_ms"),
        F.sum("tokens").alias("total_tokens_processed"),
        (F.sum("tokens") / 1000.0 * limits.cost_per_1k_tokens).alias("cost_estimate"),
        F.count_if("dimension_mismatch").alias("dimension_mismatches"),
    )
    return chunk_side.join(call_side, "pipeline_run_id", "full")


def run_alerts(metrics: DataFrame, limits: RunLimits = RunLimits()) -> DataFrame:
    """Run status and the list of raised alerts."""
    answered = F.col("total_chunks_embedded") + F.col("total_chunks_failed")
    failure_rate = F.col("total_chunks_failed") / F.greatest(answered, F.lit(1))
    spike = F.col("total_chunks_quarantined") / F.greatest("total_chunks_scanned", F.lit(1))
    raised = F.array_compact(F.array(
        F.when(failure_rate > limits.max_failure_rate, F.lit("FAILURE_RATE")),
        F.when(F.col("dimension_mismatches") > 0, F.lit("VECTOR_DIMENSION_MISMATCH")),
        F.when(spike > limits.max_quarantine_rate, F.lit("QUARANTINE_SPIKE")),
        F.when(F.col("p95_latency_ms") > limits.max_p95_latency_ms, F.lit("LATENCY_P95")),
    ))
    complete = (
        (F.col("total_chunks_failed") == 0) & (F.col("dimension_mismatches") == 0)
        & (F.col("total_chunks_embedded") >= F.col("total_chunks_eligible"))
    )
    return metrics.select(
        "pipeline_run_id",
        failure_rate.alias("failure_rate"),
        raised.alias("alerts"),
        F.when(F.coalesce(complete, F.lit(False)), "SUCCESS").otherwise("FAILED").alias(
            "run_status"
        ),
    )


def embed(df: DataFrame, text_column: str, fn: Callable[[list[str]], list[list[float]]],
          out: str = "embedding_vector", batch_rows: int = 100) -> DataFrame:
    """Call ``fn`` on batches of texts inside the tasks and add its vectors as ``out``.

    ``fn`` is the user's model or service client; it gets at most ``batch_rows`` texts a time.
    """
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.FloatType()))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch_rows):
                part = frame.iloc[start:start + batch_rows].copy()
                part[out] = [list(v) for v in fn(part[text_column].tolist())]
                yield part

    return df.mapInPandas(run, schema)


def embed_hash(df: DataFrame, id_column: str, text_column: str, dimension: int) -> DataFrame:
    """Offline vectors: each lower-cased word adds +1 or -1 to one of ``dimension`` places.

    Words are counted per (row, place) before anything is shuffled, so a row moves at most
    ``dimension`` small records however long its text is.
    """
    low = F.lower(F.col(text_column))
    words = F.regexp_extract_all(low, F.lit("[a-z0-9]+"), 0)
    digest = F.sha2("word", 256)
    place = F.pmod(F.conv(F.substring(digest, 1, 6), 16, 10).cast("bigint"), F.lit(dimension))
    odd = F.conv(F.substring(digest, 7, 1), 16, 10).cast("int") % 2 == 1
    counted = (
        df.select(id_column, F.explode_outer(words).alias("word"))
        .select(
            id_column,
            F.when(F.col("word").isNotNull(), place).alias("place"),
            F.when(odd, -1).otherwise(1).alias("sign"),
        )
        .groupBy(id_column, "place")
        .agg(F.sum(F.when(F.col("place").isNotNull(), F.col("sign"))).alias("weight"))
    )
    entries = F.collect_list(
        F.when(F.col("place").isNotNull(), F.struct("place", "weight"))
    )
    lookup = F.map_from_entries("entries")

    def filled(weights: Column) -> Column:
        places = F.sequence(F.lit(0).cast("bigint"), F.lit(dimension - 1).cast("bigint"))
        return F.transform(
            places, lambda i: F.coalesce(F.try_element_at(weights, i), F.lit(0)).cast("float")
        )

    return (
        counted.groupBy(id_column).agg(entries.alias("entries"))
        .select(id_column, bind(lookup, filled).alias("embedding_vector"))
    )
