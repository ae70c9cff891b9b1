"""Append-only audit tables: shaping, retention and rollups.

The run time is an argument, so a re-run writes the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundsill import fixed
from groundsill.schemas import (
    PUBLIC_RESPONSE,
    RETRIEVAL_REQUEST_LOG,
    RETRIEVAL_RESULT_LOG,
    VALIDATION,
    enforce,
)


def validation_rows(validated: DataFrame, bundles: DataFrame, run_id: str,
                    run_ts: Column) -> DataFrame:
    """One row per request and run; the answer is kept only when it passed."""
    traced = validated.join(
        bundles.select("request_id", "embedding_model", "index_version", "policy_version"),
        "request_id", "left",
    )
    passed = F.col("validation_status") == fixed.PASSED
    return enforce(
        traced.withColumns({
            "run_id": F.lit(run_id), "timestamp_utc": run_ts,
            "validated_answer_text": F.when(passed, F.col("validated_answer_text")),
            "model_name": F.coalesce("model_name", F.lit("unknown")),
        }),
        VALIDATION,
    )


def response_rows(responses: DataFrame, run_id: str, run_ts: Column) -> DataFrame:
    """One row per public response; the answer is kept only when the status is OK."""
    return enforce(
        responses.withColumns({
            "run_id": F.lit(run_id), "timestamp_utc": run_ts,
            "answer": F.when(F.col("status") == fixed.OK, F.col("answer")),
        }),
        PUBLIC_RESPONSE,
    )


def request_log(summary: DataFrame, requested_at: Column, embedding_model_version: str,
                min_similarity: float, timings: DataFrame | None = None) -> DataFrame:
    """Audit row per request. Holds the hash of the question, never its text. Stage times come
    from ``timings`` by request id where they were measured."""
    stages = ["embed_ms", "search_ms", "resolve_ms", "join_ms"]
    if timings is None:
        timed = summary.withColumns({s: F.lit(None).cast("bigint") for s in stages})
    else:
        timed = summary.join(timings.select("request_id", *stages), "request_id", "left")
    filters = F.to_json(F.struct(
        F.col("type_filter").alias("knowledge_type_effective"),
        F.col("equipment_filter").alias("equipment_id"),
        F.col("event_date_start").cast("string").alias("event_date_start"),
        F.col("event_date_end").cast("string").alias("event_date_end"),
    ))
    return enforce(
        timed.withColumns({
            "requested_at": requested_at,
            "embedding_model_version": F.lit(embedding_model_version),
            "top_k_requested": F.col("top_k"),
            "filters_json": filters,
            "min_similarity_hard": F.coalesce("min_similarity_override", F.lit(min_similarity)),
            "total_ms": sum((F.coalesce(s, F.lit(0)) for s in stages[1:]),
                            F.coalesce(stages[0], F.lit(0))),
        }),
        RETRIEVAL_REQUEST_LOG,
    )


def result_log(results: DataFrame, index_version: Column) -> DataFrame:
    """Audit row per returned chunk, ranked among the returned ones, without its text."""
    return enforce(
        results.withColumns({"rank": F.col("survivor_rank"), "index_version": index_version}),
        RETRIEVAL_RESULT_LOG,
    )


def within_retention(log: DataFrame, column: str, as_of: Column, days: int = 90) -> DataFrame:
    """Rows young enough to keep. On a log partitioned by date this prunes whole folders."""
    return log.where(F.col(column).cast("date") >= F.date_sub(as_of, days))


def rewrite_retained(log: DataFrame, column: str, as_of: Column, path: str, days: int = 90,
                     fmt: str = "parquet") -> None:
    """Write what is kept as a new snapshot, one folder per day, so that the next expiry of whole
    days reads no more than the days it keeps. ``path`` must not be where ``log`` is read from."""
    kept = within_retention(log, column, as_of, days)
    kept.withColumn("log_day", F.col(column).cast("date")).write.format(fmt).partitionBy(
        "log_day").save(path)


def retention_rollup(log: DataFrame, column: str, as_of: Column, days: int = 90) -> DataFrame:
    """What outlives the rows: counts per day, with how many are kept and dropped."""
    day = F.col(column).cast("date")
    kept = day >= F.date_sub(as_of, days)
    return log.groupBy(day.alias("day")).agg(
        F.count("*").alias("rows"), F.count_if(kept).alias("kept"),
        F.count_if(~kept).alias("expired"),
    )


def validation_rollup(ledger: DataFrame) -> DataFrame:
    """Pass, fail and refusal counts by reason and by model, index and policy version."""
    return ledger.groupBy(
        "model_name", "embedding_model", "index_version", "policy_version",
        "validation_status", "failure_reason",
    ).agg(
        F.count("*").alias("rows"),
        F.count_if("refusal_detected").alias("refusals"),
        F.sum("citation_count").alias("citations"),
        F.sum("uncited_sentence_count").alias("uncited"),
        F.sum("invalid_anchor_count").alias("invalid_anchors"),
    )
