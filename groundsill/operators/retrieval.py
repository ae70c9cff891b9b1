"""From searched candidates to the results a request gets, and why it got none.

Everything is keyed by request. Candidates of one request are bounded by the search width, so
windows over a request stay small; requests are spread by hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from groundsill import fixed
from groundsill.operators.requests import normalize_type
from groundsill.policy import RetrievalConfig

REQUEST_FIELDS = [
    "top_k", "type_filter", "equipment_filter", "event_date_start", "event_date_end",
    "min_similarity_override",
]


def passes_filters() -> Column:
    """Strict metadata filters; a null never satisfies one that is set."""

    def allowed(filter_name: str, column: str) -> Column:
        hit = F.coalesce(F.array_contains(filter_name, F.col(column)), F.lit(False))
        return F.col(filter_name).isNull() | hit

    in_range = F.coalesce(
        F.col("event_date").between(F.col("event_date_start"), F.col("event_date_end")),
        F.lit(False),
    )
    return (
        allowed("type_filter", "knowledge_type")
        & allowed("equipment_filter", "equipment_id")
        & (F.col("event_date_start").isNull() | in_range)
    )


def judge(candidates: DataFrame, requests: DataFrame, config: RetrievalConfig) -> DataFrame:
    """Every candidate with ``reject_reason`` (null = survives), its place among the
    survivors, and the request's ``gate_error`` (null = results may be returned)."""
    rows = candidates.join(requests.select("request_id", *REQUEST_FIELDS), "request_id")
    threshold = F.coalesce("min_similarity_override", F.lit(config.min_similarity))
    reason = (
        F.when(~passes_filters(), "FILTER")
        .when(F.col("similarity").isNull(), "SIMILARITY_MISSING")
        .when(F.col("similarity") < threshold, "THRESHOLD")
    )
    marked = rows.withColumn("reject_reason", reason)
    survives = F.col("reject_reason").isNull()
    whole = Window.partitionBy("request_id")
    ordered = Window.partitionBy("request_id", survives).orderBy("rank", "chunk_id")
    placed = marked.withColumn("survivor_rank", F.when(survives, F.row_number().over(ordered) - 1))

    def best(place: int) -> Column:
        return F.max(F.when(F.col("survivor_rank") == place, F.col("similarity"))).over(whole)

    strong = F.count_if(survives & (F.col("similarity") >= config.strong_similarity_floor))
    gate = (
        F.when(F.count_if(survives).over(whole) == 0, fixed.NO_SURVIVORS)
        .when(strong.over(whole) < config.min_strong_hits, fixed.TOO_FEW_STRONG)
        .when(best(0) - best(1) > config.max_similarity_gap, fixed.SPREAD_TOO_WIDE)
    )
    return placed.withColumn("gate_error", gate)


def top_results(judged: DataFrame) -> DataFrame:
    """At most ``top_k`` survivors of each request that passes its gates."""
    return judged.where(
        F.col("gate_error").isNull() & (F.col("survivor_rank") < F.col("top_k"))
    )


def gates(judged: DataFrame) -> DataFrame:
    """One row per searched request: survivors, strong hits, the two best scores, the gate."""
    survives = F.col("reject_reason").isNull()

    def best(place: int) -> Column:
        return F.max(F.when(F.col("survivor_rank") == place, F.col("similarity")))

    return judged.groupBy("request_id").agg(
        F.count("*").alias("candidates"),
        F.count_if(F.col("reject_reason") == "FILTER").alias("rejected_by_filter"),
        F.count_if(F.col("reject_reason") == "THRESHOLD").alias("rejected_by_threshold"),
        F.count_if(survives).alias("survivors"),
        best(0).alias("top_similarity"), best(1).alias("second_similarity"),
        F.count_if(survives & (F.col("survivor_rank") < F.col("top_k"))).alias("within_top_k"),
        F.max_by("knowledge_type", F.when(survives, -F.col("survivor_rank"))).alias("top_type"),
        F.max("gate_error").alias("gate_error"),
    )


def summarize(validated: DataFrame, judged: DataFrame) -> DataFrame:
    """Status of every request, searched or not: SUCCESS, NO_EVIDENCE or FAILED with a code."""
    found = gates(judged)
    known = validated.select(
        "request_id", "query_text_hash", "index_name", "index_version", "top_k", "candidate_k",
        "type_filter", "equipment_filter", "event_date_start", "event_date_end",
        "min_similarity_override", "error_message",
    )
    joined = known.join(found, "request_id", "left")
    error = F.coalesce(
        "error_message", "gate_error",
        F.when(F.col("candidates").isNull(), F.lit(fixed.NO_SURVIVORS)),
    )
    status = (
        F.when(F.col("error_message").isNotNull(), fixed.FAILED)
        .when(error.isNotNull(), fixed.NO_EVIDENCE)
        .otherwise(fixed.SUCCESS)
    )

    def zero(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).alias(name)

    return joined.select(
        *known.columns[:-1], status.alias("status"), error.alias("error_code"),
        zero("candidates"), zero("rejected_by_filter"), zero("rejected_by_threshold"),
        zero("survivors"), "top_similarity", "second_similarity", "top_type",
        F.when(status == fixed.SUCCESS, F.col("within_top_k")).otherwise(0).alias(
            "results_returned"
        ),
    )


def with_confidence(summary: DataFrame, config: RetrievalConfig) -> DataFrame:
    """Class of a request by its best score against the hard and the soft threshold.

    Soft thresholds per type are a handful of literals, so there is nothing to join.
    """
    by_type = F
    for kind, value in config.soft_similarity_by_type.items():
        by_type = by_type.when(F.col("top_type") == kind, F.lit(value))
    default = F.lit(config.soft_similarity)
    soft = by_type.otherwise(default) if config.soft_similarity_by_type else default
    return summary.withColumn(
        "confidence",
        F.when(F.col("status") != fixed.SUCCESS, "NONE")
        .when(F.col("top_similarity") >= soft, "HIGH")
        .otherwise("LOW"),
    )


def structured_results(routed: DataFrame, chunks: DataFrame) -> DataFrame:
    """Latest chunks of the date named in the question, at most ``top_k`` of the request.

    The order does not depend on the request, so chunks are first cut to what the date's most
    demanding request wants; a date with very many chunks or requests then costs no more than any
    other, and dates that nobody asked for drop out.
    """
    asked = routed.where(F.col("parsed_iso_date").isNotNull()).select(
        "request_id", "top_k",
        F.expr("try_to_date(parsed_iso_date, 'yyyy-MM-dd')").alias("event_date"),
    )
    wanted = asked.groupBy("event_date").agg(F.max("top_k").alias("_most"))
    order = Window.partitionBy("event_date").orderBy(
        F.col("created_at").desc(), "knowledge_chunk_id"
    )
    kept = (
        chunks.join(wanted, "event_date")
        .withColumn("rank", F.row_number().over(order) - 1)
        .where(F.col("rank") < F.col("_most"))
    )
    return (
        asked.join(kept, "event_date")
        .where(F.col("rank") < F.col("top_k"))
        .select(
            "request_id", "rank",
            F.col("knowledge_chunk_id").alias("chunk_id"),
            F.lit(1.0).alias("similarity"),
            "knowledge_id",
            normalize_type(F.col("knowledge_type_effective")).alias("knowledge_type"),
            "equipment_id", "event_date", "chunk_text",
            F.lit(None).cast("string").alias("source_reference"),
        )
    )


def with_fallback(routed: DataFrame, structured: DataFrame) -> DataFrame:
    """Requests with the router that finally serves them: vector where the date had nothing."""
    served = structured.select("request_id").distinct().withColumn("_served", F.lit(True))
    return (
        routed.join(served, "request_id", "left")
        .withColumn(
            "router",
            F.when(F.coalesce("_served", F.lit(False)), F.col("router")).otherwise("vector"),
        )
        .drop("_served")
    )


def routed_results(final: DataFrame, structured: DataFrame, vector: DataFrame) -> DataFrame:
    """Results of both routes: vector results only for requests the date did not serve."""
    to_vector = final.where("router = 'vector'").select("request_id")
    columns = structured.columns
    return structured.unionByName(
        vector.join(to_vector, "request_id", "left_semi").select(*columns)
    )
