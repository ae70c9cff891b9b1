"""What a caller sees, and how provider errors are classed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundsill import fixed

NO_VALID_EVIDENCE = "NO_EVIDENCE: No valid grounded evidence found."


def package(validated: DataFrame, bundles: DataFrame) -> DataFrame:
    """Public response per validated generation. Citations follow the validated order and show
    no text or score. A generation without an evidence bundle is answered NO_EVIDENCE."""
    joined = validated.join(
        bundles.select(
            "request_id", "assembly_status", "citations", "embedding_model", "index_version",
            "policy_version",
        ),
        "request_id", "left",
    )
    no_bundle = F.coalesce("assembly_status", F.lit("")) != fixed.OK
    passed = F.col("validation_status") == fixed.PASSED
    status = (
        F.when(no_bundle, fixed.NO_EVIDENCE)
        .when(~passed, fixed.FAILED)
        .otherwise(F.col("generation_status"))
    )

    def public(anchor: Column) -> Column:
        # At most max_chunks citations exist per request, so a scan of the array is cheap.
        found = F.try_element_at(
            F.filter("citations", lambda c: c["anchor"] == anchor), F.lit(1)
        )
        return F.when(found.isNotNull(), F.struct(
            anchor.alias("anchor"), found["knowledge_id"].alias("knowledge_id"),
            found["source_reference"].alias("source_reference"),
            found["event_date"].alias("event_date"),
            found["equipment_id"].alias("equipment_id"),
        ))

    shown = F.array_compact(F.transform("validated_citations", public))
    typed_none = F.filter(shown, lambda c: F.lit(False))
    return joined.withColumn("status", status).select(
        "request_id", "status",
        F.when(no_bundle, NO_VALID_EVIDENCE)
        .when(F.col("status") == fixed.FAILED, "")
        .otherwise(F.col("validated_answer_text")).alias("answer"),
        F.when(F.col("status") == fixed.OK, F.coalesce(shown, typed_none)).otherwise(
            F.expr("cast(array() as array<struct<anchor:string,knowledge_id:string,"
                   "source_reference:string,event_date:string,equipment_id:string>>)")
        ).alias("citations"),
        "prompt_tokens", "completion_tokens", "total_tokens", "latency_ms", "model_name",
        "embedding_model", "index_version", "policy_version",
    )


def error_class(message: Column) -> Column:
    """Class of a provider error message by the first matching rule, or null."""
    low = F.lower(message)
    branches = F
    for name, fragments in fixed.PROVIDER_ERRORS:
        hit = low.contains(fragments[0])
        for fragment in fragments[1:]:
            hit = hit | low.contains(fragment)
        branches = branches.when(hit, F.lit(name))
    return branches


def classify_attempts(attempts: DataFrame, max_retries: int) -> DataFrame:
    """Adds error class, whether it may be retried and the attempt's status.

    Attempts count from 1; a retryable error is retried until ``max_retries`` are used up.
    """
    failed = F.col("error_message").isNotNull()
    kind = error_class(F.col("error_message"))
    retryable = failed & kind.isNotNull()
    return attempts.withColumns({
        "error_class": F.when(failed, F.coalesce(kind, "error_type")),
        "retryable": retryable,
        "attempt_status": F.when(~failed, "OK")
        .when(retryable & (F.col("attempt_number") <= max_retries), "RETRY")
        .otherwise("FAILED"),
    })
