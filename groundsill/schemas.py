"""Table contracts and the one function that enforces them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "floats": T.ArrayType(T.FloatType()),
    "strings": T.ArrayType(T.StringType()),
    "string_map": T.MapType(T.StringType(), T.StringType()),
    "citations": T.ArrayType(T.StructType([
        T.StructField(name, T.StringType())
        for name in ("anchor", "knowledge_id", "source_reference", "event_date", "equipment_id")
    ])),
}


def _fields(spec: str, required: str = "") -> T.StructType:
    """Schema from ``name type`` pairs; names in ``required`` may not be null."""
    strict = set(required.split())
    pairs = [pair.split() for pair in spec.split(",")]
    return T.StructType(
        [T.StructField(name, _TYPES[kind], name not in strict) for name, kind in pairs]
    )


KNOWLEDGE = _fields(
    """knowledge_id string, knowledge_type string, business_domain string, content_text string,
    source_reference string, event_date date, metadata string_map,
    equipment_id string, line_id string""",
    "knowledge_id knowledge_type business_domain content_text source_reference",
)

CHUNK = _fields(
    """knowledge_chunk_id string, knowledge_id string, knowledge_type_original string,
    knowledge_type_effective string, chunk_index int, chunk_text string, chunk_token_count int,
    business_domain string, equipment_id string, line_id string, event_date date,
    source_reference string, created_at timestamp""",
    "knowledge_chunk_id knowledge_id",
)

READY_CHUNK = _fields(
    """knowledge_chunk_id string, knowledge_id string, knowledge_type_original string,
    knowledge_type_effective string, chunk_index int, chunk_text string, chunk_token_count int,
    business_domain string, equipment_id string, line_id string, event_date date,
    source_reference string, created_at timestamp, is_quarantined boolean,
    pipeline_run_id string, eligible_at timestamp""",
    "knowledge_chunk_id knowledge_id",
)

EMBEDDING = _fields(
    """knowledge_chunk_id string, knowledge_id string, knowledge_type_effective string,
    source_reference string, embedding_provider string, embedding_model_name string,
    embedding_model_version string, embedding_dimension int, embedding_vector floats,
    chunk_text_hash string, status string, error_type string, error_message string,
    pipeline_run_id string, embedded_at timestamp""",
    "knowledge_chunk_id embedding_model_name status",
)

MANIFEST = _fields(
    """index_name string, index_version string, embedding_model_name string,
    embedding_model_version string, embedding_dim int, similarity string, vector_count bigint,
    export_run_id string, built_at_utc string, index_file string, id_map string,
    metadata string""",
    "index_name index_version",
)

RAW_REQUEST = _fields(
    """request_id string, query_text string, index_name string, index_version string,
    top_k string, filters string, min_similarity_override string"""
)

VALIDATION = _fields(
    """request_id string, run_id string, timestamp_utc timestamp, generation_status string,
    validation_status string, failure_reason string, citation_count int,
    uncited_sentence_count int, invalid_anchor_count int, suspicious_new_ids strings,
    refusal_detected boolean, length_ratio_flag boolean, validated_citations strings,
    validated_answer_text string, model_name string, embedding_model string,
    index_version string, policy_version string""",
    """request_id run_id timestamp_utc generation_status validation_status citation_count
    uncited_sentence_count invalid_anchor_count refusal_detected length_ratio_flag model_name""",
)

PUBLIC_RESPONSE = _fields(
    """request_id string, run_id string, timestamp_utc timestamp, status string, answer string,
    citations citations, prompt_tokens int, completion_tokens int,
    total_tokens int, latency_ms int, model_name string, embedding_model string,
    index_version string, policy_version string""",
    "request_id run_id timestamp_utc status",
)

RETRIEVAL_REQUEST_LOG = _fields(
    """request_id string, requested_at timestamp, index_name string, index_version string,
    embedding_model_version string, query_text_hash string, top_k_requested int,
    candidate_k int, filters_json string, min_similarity_hard double, status string,
    results_returned int, top_similarity double, embed_ms bigint, search_ms bigint,
    resolve_ms bigint, join_ms bigint, total_ms bigint, error_code string""",
    "request_id requested_at status",
)

RETRIEVAL_RESULT_LOG = _fields(
    """request_id string, rank int, chunk_id string, similarity double, knowledge_id string,
    knowledge_type string, event_date date, equipment_id string, index_version string""",
    "request_id rank chunk_id",
)


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the contract's columns in order, cast them, and fail on a null in a required one.

    A missing column fails when the plan is built; a null fails the write that meets it.
    """
    columns = []
    for field in schema.fields:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            problem = F.raise_error(F.lit(f"contract: null in required column {field.name}"))
            value = F.when(value.isNull(), problem.cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return df.select(*columns)
