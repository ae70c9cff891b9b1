"""Corrupt chunks are set aside with a reason; the rest go on to embedding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundsill import fixed


def corruption_reason(max_sop_tokens: int) -> Column:
    """First matching reason, or null for a clean chunk."""
    undated = F.col("event_date").isNull()
    malformed = F.regexp_extract("chunk_text", fixed.MALFORMED_DATE_PREFIX, 1) != ""
    kind = F.col("knowledge_type_effective")
    return (
        F.when(undated & malformed, fixed.MALFORMED_EVENT_DATE)
        .when(undated & kind.isin(fixed.DATED_TYPES), fixed.MISSING_EVENT_DATE)
        .when(
            (kind == "sop") & (F.col("chunk_token_count") > max_sop_tokens),
            fixed.SOP_TOKEN_OVERFLOW,
        )
    )


def quarantined(chunks: DataFrame, run_id: str, source_version: str, detected_at: Column,
                max_sop_tokens: int) -> DataFrame:
    """Corrupt rows, unchanged, with reason and provenance."""
    return (
        chunks.withColumn("corruption_reason", corruption_reason(max_sop_tokens))
        .where(F.col("corruption_reason").isNotNull())
        .withColumn("detected_at", detected_at.cast("timestamp"))
        .withColumn("source_table_version", F.lit(source_version))
        .withColumn("pipeline_run_id", F.lit(run_id))
    )


def without_quarantined(chunks: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Chunks that no quarantine row names."""
    return chunks.join(quarantine.select("knowledge_chunk_id"), "knowledge_chunk_id", "left_anti")


def embedding_ready(chunks: DataFrame, run_id: str, eligible_at: Column,
                    max_sop_tokens: int) -> DataFrame:
    """All chunks with the flag, run id and eligibility time that indexing asks for."""
    bad = corruption_reason(max_sop_tokens).isNotNull()
    return chunks.select(
        "*",
        bad.alias("is_quarantined"),
        F.lit(run_id).alias("pipeline_run_id"),
        F.when(~bad, eligible_at.cast("timestamp")).alias("eligible_at"),
    )
