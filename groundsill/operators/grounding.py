"""Is a generated answer supported by the evidence it was given?

One join on the request id, then a single projection over arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundsill import fixed
from groundsill.functions import citations as ct
from groundsill.functions import text as tx

MIN_ID_CHARS = 7


def allowed_entities(min_id_chars: int = MIN_ID_CHARS) -> Column:
    """Identifiers an answer may use: fields of its citations and words of its evidence."""
    named = F.flatten(F.transform("citations", lambda c: F.array_compact(F.array(
        c["knowledge_id"], c["equipment_id"], c["event_date"], c["knowledge_type"]
    ))))
    words = ct.id_tokens(F.coalesce("evidence_block_text", F.lit("")), min_id_chars)
    return F.array_union(F.coalesce(named, F.expr("cast(array() as array<string>)")), words)


def claims_mismatch(claimed: Column, text: Column) -> Column:
    """A list of citations that repeats one or names one the text does not contain."""
    cited = ct.cited_anchors(text)
    return (F.size(F.array_distinct(claimed)) != F.size(claimed)) | (
        F.size(F.array_except(claimed, cited)) > 0
    )


def validate_generation(generations: DataFrame, bundles: DataFrame,
                        min_id_chars: int = MIN_ID_CHARS, sentences: bool = False,
                        max_length_ratio: int = 10) -> DataFrame:
    """Verdict per generation: the first broken rule, counts, and the answer if it passed.

    ``generations`` needs request id, raw text and generation status; a ``claimed_citations``
    column, where present, is checked against the text as well.
    """
    text = tx.strip(F.coalesce("raw_model_text", F.lit("")))
    joined = generations.join(
        bundles.select("request_id", "citations", "evidence_block_text"), "request_id", "left"
    )
    seen = joined.withColumn("_text", text).withColumns({
        "_markers": F.size(ct.cited_markers(F.col("_text"))),
        "_anchors": ct.cited_anchors(F.col("_text")),
    })
    allowed = F.coalesce(
        F.transform("citations", lambda c: c["anchor"]), F.expr("cast(array() as array<string>)")
    )
    seen = seen.withColumns({
        "_invalid": F.array_sort(F.array_except("_anchors", allowed)),
        "_uncited": ct.uncited_parts(F.col("_text"), sentences),
        "_external": F.array_except(
            ct.suspicious_ids(F.col("_text"), min_id_chars), allowed_entities(min_id_chars)
        ),
    })
    text = F.col("_text")
    refusal_like = F.startswith(text, F.lit(fixed.REFUSAL_PREFIX))
    exact_refusal = text == fixed.REFUSAL
    mismatch = F.lit(False)
    if "claimed_citations" in generations.columns:
        mismatch = F.coalesce(
            claims_mismatch(F.col("claimed_citations"), text), F.lit(False)
        )
    status = F.coalesce("generation_status", F.lit(""))
    declined = status == fixed.NO_EVIDENCE
    not_ok = ~declined & (status != fixed.OK)
    refused = declined | exact_refusal
    reason = (
        F.when(declined, F.lit(None))
        .when(not_ok, fixed.GENERATION_NOT_OK)
        .when(exact_refusal, F.lit(None))
        .when(refusal_like, fixed.INVALID_REFUSAL)
        .when(F.col("_markers") == 0, fixed.NO_CITATIONS)
        .when(F.size("_invalid") > 0, fixed.INVALID_CITATION)
        .when(F.size("_uncited") > 0, fixed.UNCITED_FACT)
        .when(F.size("_external") > 0, fixed.EXTERNAL_KNOWLEDGE)
        .when(mismatch, fixed.CITATION_MISMATCH)
    )
    judged = seen.withColumns({
        "failure_reason": reason,
        "_refused": refused,
        "_refusal_seen": declined | (~not_ok & refusal_like),
        "_not_ok": not_ok,
    })
    failed, refused = F.col("failure_reason").isNotNull(), F.col("_refused")
    plain = ~refused & ~F.col("_not_ok") & ~F.col("_refusal_seen")
    why = F.col("failure_reason")
    none = F.expr("cast(array() as array<string>)")
    long_answer = F.length(text) > max_length_ratio * F.length(
        F.coalesce("evidence_block_text", F.lit(""))
    )
    extra = [c for c in generations.columns
             if c not in ("request_id", "raw_model_text", "generation_status")]
    return judged.select(
        "request_id",
        F.when(failed, fixed.FAILED).when(refused, fixed.NO_EVIDENCE).otherwise(fixed.OK).alias(
            "generation_status"
        ),
        F.when(failed, fixed.FAILED).otherwise(fixed.PASSED).alias("validation_status"),
        why.alias("failure_reason"),
        F.when(plain, F.col("_markers")).otherwise(0).alias("citation_count"),
        F.when(why == fixed.UNCITED_FACT, F.size("_uncited")).otherwise(0).alias(
            "uncited_sentence_count"
        ),
        F.when(why == fixed.INVALID_CITATION, F.size("_invalid")).otherwise(0).alias(
            "invalid_anchor_count"
        ),
        F.when(why == fixed.INVALID_CITATION, F.col("_invalid")).otherwise(none).alias(
            "invalid_anchors"
        ),
        F.when(why == fixed.UNCITED_FACT, F.try_element_at("_uncited", F.lit(1))).alias(
            "example_uncited"),
        F.when(why == fixed.EXTERNAL_KNOWLEDGE, F.col("_external")).otherwise(
            none
        ).alias("suspicious_new_ids"),
        F.col("_refusal_seen").alias("refusal_detected"),
        (plain & long_answer).alias("length_ratio_flag"),
        F.when(~failed & ~refused, F.col("_anchors")).otherwise(none).alias(
            "validated_citations"
        ),
        F.when(failed, "").when(declined, "").otherwise(text).alias("validated_answer_text"),
        *extra,
    )
