"""Registered queries: one per job, each over whole tables, with flat comparable columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundsill.functions import citations as ct
from groundsill.functions import ids
from groundsill.functions import text as tx
from groundsill.functions import vectors as vx
from groundsill.operators import (
    assembly,
    chunking,
    drift,
    embedding,
    grounding,
    index,
    knowledge,
    ledgers,
    quarantine,
    requests,
    response,
    retrieval,
    search,
    selection,
)
from groundsill.plans.stages import GATE, PIN, POLICY, RETRIEVAL, RUN_ID, Stages
from groundsill.schemas import CHUNK, RETRIEVAL_REQUEST_LOG, enforce
from groundsill.session import materialize, new_folder
from groundsill.sources import gold, index_sink, index_store, ledger, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ON_STAGES: dict[str, Callable[[Stages], DataFrame]] = {}

BUCKETS = 32
RESPLIT_TOKENS = 300
RETENTION_AS_OF = "2024-04-10"
PROBES = 64


def vector_sum(vector: Column) -> Column:
    """One number that depends on every element and its place."""
    weighted = F.transform(vx.as_double(vector), lambda x, i: x * (i + 1))
    return F.aggregate(weighted, F.lit(0.0), lambda total, x: total + x)


def _flat(field: T.StructField) -> Column:
    value, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.IntegerType, T.ShortType)):
        return value.cast("bigint")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.round(value.cast("double"), 6)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return value.cast("string")
    if isinstance(kind, T.MapType):
        entries = F.array_sort(F.map_entries(value))
        return F.array_join(
            F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))),
            "|",
        )
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
            return F.round(vector_sum(value), 6)
        if isinstance(kind.elementType, T.StructType):
            names = kind.elementType.fieldNames()
            shown = F.transform(value, lambda s: F.concat_ws(
                ",", *[F.coalesce(s[n].cast("string"), F.lit("~")) for n in names]))
            return F.array_join(shown, "|")
        return F.array_join(value, "|")
    return value


def flatten(df: DataFrame) -> DataFrame:
    """Nested and sized types as plain ones: the form results are compared in."""
    return df.select(*[_flat(f).alias(f.name) for f in df.schema.fields])


def register(fn: Callable[[Stages], DataFrame]) -> Callable[[Stages], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flatten(fn(Stages(spark, sf_dir)))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    ON_STAGES[fn.__name__] = lambda stages: flatten(fn(stages))
    return fn


# --- CSV lines ---------------------------------------------------------------------------
@register
def gold_csv_scan(s: Stages) -> DataFrame:
    return gold.good_rows(gold.parse_lines(s.csv_lines, "incident"), "incident")


@register
def gold_corrupt_split(s: Stages) -> DataFrame:
    return gold.rejected_lines(gold.parse_lines(s.csv_lines, "incident"))


# --- knowledge ---------------------------------------------------------------------------
def _narrated(kind: str) -> None:
    def query(s: Stages) -> DataFrame:
        return knowledge.NARRATORS[kind](s.gold[kind]).drop("metadata")

    query.__name__ = f"knowledge_{kind}"
    register(query)


for _kind in knowledge.NARRATORS:
    _narrated(_kind)


@register
def knowledge_metadata(s: Stages) -> DataFrame:
    entries = F.transform(
        F.map_entries("metadata"),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("~"))),
    )
    return s.knowledge.select(
        "knowledge_id", F.size("metadata").alias("entries"),
        F.array_join(entries, ";").alias("metadata_text"),
    )


@register
def knowledge_all(s: Stages) -> DataFrame:
    return s.knowledge.select(
        "knowledge_id", "knowledge_type", "business_domain", "source_reference", "event_date",
        F.length("content_text").alias("n_chars"),
    )


@register
def knowledge_checks(s: Stages) -> DataFrame:
    return knowledge.knowledge_checks(s.knowledge)


@register
def type_distribution(s: Stages) -> DataFrame:
    return knowledge.type_distribution(s.knowledge)


# --- gate --------------------------------------------------------------------------------
@register
def type_effective(s: Stages) -> DataFrame:
    return chunking.with_effective_type(s.documents).select(
        "knowledge_id", "knowledge_type", "knowledge_type_effective"
    )


@register
def eligibility(s: Stages) -> DataFrame:
    text = F.col("content_text")
    return chunking.with_eligibility(s.documents).select(
        "knowledge_id", "knowledge_type_effective",
        tx.is_placeholder(text).alias("placeholder"),
        tx.has_action_signal(text).alias("action_signal"),
        tx.has_measure_signal(text).alias("measure_signal"),
        tx.has_outcome_signal(text).alias("outcome_signal"),
        tx.is_short_low_signal(text, F.col("knowledge_type_effective")).alias("short_low_signal"),
        "validation_status",
    )


@register
def eligibility_summary(s: Stages) -> DataFrame:
    return chunking.eligibility_summary(s.documents)


# --- chunks ------------------------------------------------------------------------------
def _chunk_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "knowledge_chunk_id", "knowledge_id", "knowledge_type_effective", "chunk_index",
        "chunk_text", "chunk_token_count",
    )


@register
def chunks_single(s: Stages) -> DataFrame:
    return _chunk_columns(chunking.single_chunks(chunking.approved(s.documents), s.run_ts))


@register
def chunks_sections(s: Stages) -> DataFrame:
    rows = chunking.approved(s.input("headed_knowledge"))
    return _chunk_columns(chunking.section_chunks(rows, s.run_ts, None))


@register
def chunks_packed(s: Stages) -> DataFrame:
    rows = chunking.approved(s.input("headed_knowledge"))
    return _chunk_columns(chunking.packed_chunks(rows, s.run_ts))


@register
def chunks_resplit(s: Stages) -> DataFrame:
    rows = chunking.approved(s.input("headed_knowledge"))
    return _chunk_columns(chunking.resplit_chunks(rows, s.run_ts, RESPLIT_TOKENS))


@register
def chunks_all(s: Stages) -> DataFrame:
    return _chunk_columns(chunking.all_chunks(s.input("headed_knowledge"), s.run_ts))


@register
def chunk_tokens(s: Stages) -> DataFrame:
    return s.documents.select(
        "knowledge_id", tx.tokens_chars4(F.col("content_text")).alias("tokens_chars4"),
        tx.tokens_words(F.col("content_text")).alias("tokens_words"),
        tx.tokens_words13(F.col("content_text")).alias("tokens_words13"),
    )


@register
def token_stats(s: Stages) -> DataFrame:
    return chunking.token_stats(s.chunks)


@register
def token_stats_rollup(s: Stages) -> DataFrame:
    """Statistics by type merged from the stored token counts of a type and day."""
    return chunking.merge_token_counts(materialize(chunking.token_counts(s.chunks)))


@register
def chunk_contract(s: Stages) -> DataFrame:
    return enforce(s.chunks, CHUNK)


@register
def chunk_checks(s: Stages) -> DataFrame:
    return chunking.chunk_checks(s.chunks)


# --- corruption --------------------------------------------------------------------------
@register
def quarantine_rows(s: Stages) -> DataFrame:
    return s.quarantine.select(
        "knowledge_chunk_id", "knowledge_id", "corruption_reason", "detected_at",
        "source_table_version", "pipeline_run_id",
    )


# The module of that name is in use above, so the function could not carry it.
QUERIES["quarantine"] = QUERIES.pop("quarantine_rows")
ON_STAGES["quarantine"] = ON_STAGES.pop("quarantine_rows")


@register
def semantic_clean(s: Stages) -> DataFrame:
    return _chunk_columns(quarantine.without_quarantined(s.chunks, s.quarantine))


# --- embedding ---------------------------------------------------------------------------
@register
def embedding_backlog(s: Stages) -> DataFrame:
    clean = s.ready.where(~F.col("is_quarantined"))
    return embedding.backlog(clean, s.embeds, PIN.model_name).select(
        "knowledge_chunk_id", "knowledge_id", "chunk_token_count"
    )


@register
def embedding_batches(s: Stages) -> DataFrame:
    return embedding.batches(s.chunks)


@register
def batch_tracking(s: Stages) -> DataFrame:
    return embedding.batch_tracking(s.input("attempts"))


@register
def embedding_upsert(s: Stages) -> DataFrame:
    return embedding.merge_embeddings(
        s.embeds, s.input("embed_changes")
    ).select(
        "knowledge_chunk_id", "embedding_model_name", "embedding_model_version", "status",
        "pipeline_run_id", "embedded_at", "embedding_vector",
    )


@register
def embedding_upsert_buckets(s: Stages) -> DataFrame:
    """The same merge into a stored table of which only the buckets with changes are rewritten."""
    path = new_folder(s.spark)
    keys = ["knowledge_chunk_id", "embedding_model_name"]
    tables.create_bucketed(s.embeds, path, keys, BUCKETS)
    tables.upsert_buckets(s.input("embed_changes"), path, keys, embedding.NEWEST_FIRST)
    return tables.read_bucketed(s.spark, path).select(
        *keys, "embedding_model_version", "status", "pipeline_run_id", "embedded_at", "embedding_vector")


@register
def embedding_checks(s: Stages) -> DataFrame:
    return embedding.embedding_checks(s.embeds)


@register
def embedding_stale(s: Stages) -> DataFrame:
    return embedding.stale(s.embeds, s.chunks)


def _metrics(s: Stages) -> DataFrame:
    scanned = s.ready.withColumn(
        "pipeline_run_id",
        F.concat(F.lit("run_"), (F.col("chunk_token_count") % 5).cast("string")),
    )
    return embedding.run_metrics(s.input("attempts"), scanned)


@register
def run_metrics(s: Stages) -> DataFrame:
    return _metrics(s)


@register
def run_alerts(s: Stages) -> DataFrame:
    return embedding.run_alerts(_metrics(s))


@register
def embed_hash(s: Stages) -> DataFrame:
    hashed = embedding.embed_hash(s.documents, "knowledge_id", "content_text", PIN.dimension)
    vector = F.col("embedding_vector")
    return hashed.select(
        "knowledge_id",
        F.transform(vector, lambda x: x.cast("int").cast("string")).alias("weights"),
        vx.norm(vector).alias("norm"),
    )


# --- index -------------------------------------------------------------------------------
@register
def index_input(s: Stages) -> DataFrame:
    return s.index_input


@register
def join_integrity(s: Stages) -> DataFrame:
    return index.join_integrity(s.embeds, s.ready, s.documents, PIN)


@register
def index_validate(s: Stages) -> DataFrame:
    return index.validate_index_input(s.index_input, PIN.dimension)


@register
def duplicate_keys(s: Stages) -> DataFrame:
    return index.duplicate_keys(s.embeds, ["knowledge_chunk_id", "embedding_model_version"])


@register
def index_export(s: Stages) -> DataFrame:
    return s.export.drop("chunk_text")


@register
def index_publish(s: Stages) -> DataFrame:
    """An export published through the sink, and read back with its manifest."""
    root = new_folder(s.spark)
    index_sink.publish(s.export, root, "chunks", PIN.model_version, PIN, RUN_ID, "2024-03-01T00:00:00Z")
    manifest = index_store.read_manifests(s.spark, root).select(
        "index_name", "index_version", "embedding_dim", "vector_count", "export_run_id")
    loaded = index_sink.load_published(s.spark, root, "chunks", PIN.model_version)
    named = loaded.select(
        "vector_id", "chunk_id", "unit_vector", "knowledge_id", "knowledge_type", "source_reference",
        F.lit("chunks").alias("index_name"), F.lit(PIN.model_version).alias("index_version"))
    return named.join(F.broadcast(manifest), ["index_name", "index_version"])


@register
def index_manifest(s: Stages) -> DataFrame:
    manifest = index.build_manifest(
        s.export, PIN, "chunks", PIN.model_version, RUN_ID, "2024-03-01T00:00:00Z", "index/v1"
    )
    return index.manifest_checks(manifest, s.export)


@register
def vector_normalize(s: Stages) -> DataFrame:
    vector = F.col("vector")
    return s.input("raw_vectors").select(
        "vec_id", F.size(vector).alias("n"), vx.norm(vector).alias("norm"),
        vx.normalize(vector).alias("unit"),
    )


@register
def rejected_vectors(s: Stages) -> DataFrame:
    return index.rejected_vectors(s.index_input, PIN.dimension)


@register
def vector_checks(s: Stages) -> DataFrame:
    return s.input("raw_vectors").select(
        "vec_id", vx.vector_error(F.col("vector"), PIN.dimension).alias("error_code")
    )


# --- search ------------------------------------------------------------------------------
@register
def knn_topk(s: Stages) -> DataFrame:
    return s.hits


@register
def knn_resolve(s: Stages) -> DataFrame:
    return s.resolved.select(
        "request_id", "rank", "chunk_id", "similarity", "vector_id", "knowledge_id",
        "knowledge_type", "event_date", "equipment_id", "source_reference", "resolve_error",
    )


@register
def self_retrieval(s: Stages) -> DataFrame:
    return search.self_retrieval(s.export, PIN.dimension, search.sample_ids(s.export, PROBES))


@register
def self_recall(s: Stages) -> DataFrame:
    return search.self_recall(self_retrieval(s))


# --- requests ----------------------------------------------------------------------------
@register
def request_validate(s: Stages) -> DataFrame:
    return s.validated


@register
def query_quality(s: Stages) -> DataFrame:
    return requests.query_quality(s.input("raw_requests"), GATE)


@register
def request_hash(s: Stages) -> DataFrame:
    return s.validated.select("request_id", "query_text_hash")


@register
def request_index_check(s: Stages) -> DataFrame:
    return index_store.check_versions(s.accepted, s.versions).select(
        "request_id", "index_name", "index_version", "index_error"
    )


@register
def question_route(s: Stages) -> DataFrame:
    return s.routed.select("request_id", "parsed_iso_date", "inferred_type", "router")


@register
def type_normalize(s: Stages) -> DataFrame:
    asked = F.concat(F.lit(" "), F.element_at(tx.words(F.col("query_text")), -1), F.lit(" "))
    return s.accepted.select("request_id", requests.normalize_type(asked).alias("type"))


# --- retrieval ---------------------------------------------------------------------------
@register
def retrieve_filtered(s: Stages) -> DataFrame:
    return s.judged.select("request_id", "rank", "chunk_id", "similarity", "reject_reason",
                           "survivor_rank")


@register
def retrieve_topk(s: Stages) -> DataFrame:
    return retrieval.top_results(s.judged).select(
        "request_id", "survivor_rank", "chunk_id", "similarity", "knowledge_type"
    )


@register
def retrieve_gates(s: Stages) -> DataFrame:
    return retrieval.gates(s.judged)


@register
def retrieve_summary(s: Stages) -> DataFrame:
    return s.summary.select(
        "request_id", "status", "error_code", "candidates", "rejected_by_filter",
        "rejected_by_threshold", "survivors", "top_similarity", "second_similarity",
        "results_returned",
    )


@register
def retrieve_confidence(s: Stages) -> DataFrame:
    return retrieval.with_confidence(s.summary, RETRIEVAL).select(
        "request_id", "status", "top_type", "top_similarity", "confidence"
    )


@register
def route_structured(s: Stages) -> DataFrame:
    return s.structured


@register
def route_fallback(s: Stages) -> DataFrame:
    return s.fallback.select("request_id", "router").join(
        s.served.select("request_id", "rank", "chunk_id", "similarity"), "request_id", "left"
    )


@register
def retrieval_request_log(s: Stages) -> DataFrame:
    return ledgers.request_log(
        s.summary, s.run_ts, PIN.model_version, RETRIEVAL.min_similarity
    )


@register
def ledger_replay(s: Stages) -> DataFrame:
    """A run added to a ledger two times, and another run after it: each is there once."""
    path = new_folder(s.spark)
    rows = ledgers.request_log(s.summary, s.run_ts, PIN.model_version, RETRIEVAL.min_similarity)
    failed = rows.where("status = 'FAILED'")
    for run, added in ((RUN_ID, rows), (RUN_ID, rows), ("run_9", failed)):
        ledger.append_run(added, RETRIEVAL_REQUEST_LOG, path, run, ["request_id"])
    return ledger.read_ledger(s.spark, RETRIEVAL_REQUEST_LOG, path).select(
        "ledger_run", "request_id", "requested_at", "query_text_hash", "status", "results_returned",
        "error_code")


@register
def retrieval_result_log(s: Stages) -> DataFrame:
    return ledgers.result_log(retrieval.top_results(s.judged), F.lit(PIN.model_version))


@register
def log_retention(s: Stages) -> DataFrame:
    as_of = F.to_date(F.lit(RETENTION_AS_OF))
    return ledgers.retention_rollup(s.input("attempts"), "started_at", as_of)


@register
def log_kept(s: Stages) -> DataFrame:
    as_of = F.to_date(F.lit(RETENTION_AS_OF))
    return ledgers.within_retention(s.input("attempts"), "started_at", as_of).select(
        "event_id", "request_id", "started_at"
    )


# --- selection ---------------------------------------------------------------------------
@register
def bundle_checks(s: Stages) -> DataFrame:
    return selection.bundle_checks(s.candidates, s.accepted)


@register
def text_sanitize(s: Stages) -> DataFrame:
    dirty = F.concat(
        F.lit("\x00 \x07"), F.regexp_replace("text", "\\. ", " \x1f.\t\x0b "), F.lit("\x7f\n")
    )
    return s.table("documents").select("doc_id", tx.sanitize(dirty).alias("clean_text"))


@register
def text_noise(s: Stages) -> DataFrame:
    text = (
        F.when(F.col("doc_id") % 9 == 4, F.concat("text", F.repeat(F.lit("="), 31)))
        .when(F.col("doc_id") % 9 == 5, F.concat("text", F.repeat(F.lit("z"), 30)))
        .when(F.col("doc_id") % 9 == 6, F.concat(
            F.regexp_replace("text", r"[^ \n]", "7 "), F.col("text")))
        .when(F.col("doc_id") % 9 == 7, F.regexp_replace("text", r"\p{L}", "1-"))
        .otherwise(F.col("text"))
    )
    rows = s.table("documents").withColumn("text", text)
    return rows.select("doc_id", tx.is_noise(F.col("text")).alias("noise"))


@register
def text_injection(s: Stages) -> DataFrame:
    phrases = ["SYSTEM prompt", "act  as", "You are ChatGPT", "Act as"]
    said = F.element_at(F.array(*map(F.lit, phrases)), (F.col("doc_id") % 4 + 1).cast("int"))
    text = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" "), said)).otherwise(
        F.col("text")
    )
    return s.table("documents").select("doc_id", tx.has_injection(text).alias("injection"))


@register
def select_drops(s: Stages) -> DataFrame:
    return selection.drop_events(s.selection)


@register
def select_rollup(s: Stages) -> DataFrame:
    return selection.drop_rollup(s.selection)


@register
def select_dedupe(s: Stages) -> DataFrame:
    filtered = selection.filter_candidates(s.candidates, POLICY, s.constraints)
    return filtered.select(
        "request_id", "rank", "chunk_id", "drop_reason",
        F.length("clean_text").alias("clean_chars"),
    )


@register
def select_cap(s: Stages) -> DataFrame:
    filtered = selection.filter_candidates(s.candidates, POLICY)
    return filtered.where(F.col("drop_reason").isNull()).groupBy(
        "request_id", "knowledge_id"
    ).agg(F.count("*").alias("kept"), F.min("rank").alias("first_rank"))


@register
def shingles(s: Stages) -> DataFrame:
    """Overlap of each document with a copy of itself that lost its first words."""
    text = F.col("content_text")
    tail = F.array_join(F.slice(tx.words(text), F.lit(8), F.greatest(F.size(tx.words(text)), F.lit(1))), " ")
    built = s.documents.select(
        "knowledge_id", F.sort_array(tx.shingles(text)).alias("a"),
        F.sort_array(tx.shingles(tail)).alias("b"),
    )
    limit = POLICY.overlap_ratio_threshold
    return built.select(
        "knowledge_id", F.size("a").alias("n_shingles"), F.size("b").alias("n_tail"),
        tx.jaccard(F.col("a"), F.col("b")).alias("ratio"),
        tx.overlaps(
            F.col("a"), F.col("b"), tx.overlap_key(F.col("a"), limit),
            tx.overlap_key(F.col("b"), limit), limit,
        ).alias("overlap"),
    )


@register
def select_overlap(s: Stages) -> DataFrame:
    return s.selection.where(
        F.col("drop_reason").isNull() | F.col("drop_reason").isin("DROP_OVERLAP", "DROP_BUDGET")
    ).select("request_id", "rank", "chunk_id", "drop_reason")


@register
def select_budget(s: Stages) -> DataFrame:
    return selection.selected(s.selection).select(
        "request_id", "rank", "chunk_id", "needs_trim", "reserved_tokens"
    )


@register
def select_metrics(s: Stages) -> DataFrame:
    return s.metrics


@register
def conflict_flag(s: Stages) -> DataFrame:
    return selection.conflict_counts(s.selection)


# --- assembly ----------------------------------------------------------------------------
@register
def assemble_citations(s: Stages) -> DataFrame:
    return s.placed.select(
        "request_id", "citation_anchor", "chunk_id", "knowledge_id", "knowledge_type",
        "event_date", "equipment_id", "source_reference", "rank", "similarity",
    )


@register
def cited_knowledge(s: Stages) -> DataFrame:
    """Every citation's knowledge id and whether the knowledge table has it."""
    known = s.documents.select("knowledge_id").distinct().withColumn("known", F.lit(True))
    return s.placed.select("request_id", "chunk_id", "knowledge_id").join(
        known, "knowledge_id", "left").withColumn("known", F.coalesce("known", F.lit(False)))


@register
def evidence_block(s: Stages) -> DataFrame:
    return s.evidence.select(
        "request_id", F.length("evidence_block_text").alias("n_chars"),
        ids.text_hash(F.col("evidence_block_text")).alias("evidence_hash"),
        F.transform("citations", lambda c: c["anchor"]).alias("anchors"),
        "evidence_count", "prompt_evidence_count",
    )


@register
def assemble_status(s: Stages) -> DataFrame:
    return s.bundle.select(
        "request_id", "assembly_status", "assembly_reason", "selected_count", "dropped_count",
        "top_similarity", "policy_version", "index_version", "embedding_model",
        "retrieval_top_k", "similarity_threshold",
    )


@register
def prompt_budget(s: Stages) -> DataFrame:
    return s.placed.select(
        "request_id", "citation_anchor", "block_tokens", "running_tokens", "in_prompt"
    )


@register
def prompt_build(s: Stages) -> DataFrame:
    return s.prompts.drop("prompt_hash", "prompt_template_version")


@register
def prompt_hash(s: Stages) -> DataFrame:
    return s.prompts.select("request_id", "prompt_hash")


@register
def prompt_drift(s: Stages) -> DataFrame:
    """A second run of the prompts with some changed, left out and added, against the first one."""
    first = materialize(s.prompts.select("request_id", "build_status", "prompt_text", "prompt_hash"))
    asked = F.col("request_id")
    second = first.where(~asked.endswith("3-0")).withColumn(
        "prompt_text", F.when(asked.endswith("1-0"), F.concat("prompt_text", F.lit("."))).otherwise(
            F.col("prompt_text"))).unionByName(
        first.where(asked.endswith("7-0")).withColumn("request_id", F.concat(F.lit("new-"), asked)))
    return drift.changes(first, second, ["request_id"])


# --- grounding ---------------------------------------------------------------------------
@register
def citation_extract(s: Stages) -> DataFrame:
    text = F.coalesce("raw_model_text", F.lit(""))
    return s.generations.select(
        "request_id", F.size(ct.cited_markers(text)).alias("markers"),
        ct.cited_anchors(text).alias("anchors"),
    )


@register
def answer_units(s: Stages) -> DataFrame:
    text = F.col("raw_model_text")
    units = s.generations.select("request_id", F.posexplode(ct.answer_units(text)).alias("n", "u"))
    return units.select(
        "request_id", "n", F.length("u").alias("n_chars"), ct.has_fact(F.col("u")).alias("fact"),
        F.length(ct.uncited_part(F.col("u"))).alias("uncited_chars"),
    )


@register
def validate_entities(s: Stages) -> DataFrame:
    joined = s.generations.join(
        s.bundle.select("request_id", "citations", "evidence_block_text"), "request_id", "left"
    )
    found = ct.suspicious_ids(F.col("raw_model_text"), grounding.MIN_ID_CHARS)
    return joined.select(
        "request_id", found.alias("suspicious"),
        F.array_except(found, grounding.allowed_entities()).alias("external"),
    )


@register
def validate_claims(s: Stages) -> DataFrame:
    """Verdicts where generations also list what they cite; the lists depend on the text's length
    and are right, doubled, wrong or empty."""
    kind = F.length("raw_model_text") % 4
    claimed = (
        F.when(kind == 0, F.array(F.lit("C0"))).when(kind == 1, F.array(F.lit("C0"), F.lit("C0")))
        .when(kind == 2, F.array(F.lit("C0"), F.lit("C99")))
        .otherwise(F.expr("cast(array() as array<string>)"))
    )
    listed = s.generations.withColumn("claimed_citations", claimed)
    return grounding.validate_generation(listed, s.bundle).select(
        "request_id", "validation_status", "failure_reason")


@register
def validate_generation(s: Stages) -> DataFrame:
    return s.verdicts


# --- responses and ledgers ---------------------------------------------------------------
@register
def package_response(s: Stages) -> DataFrame:
    return s.responses


@register
def validation_ledger(s: Stages) -> DataFrame:
    return ledgers.validation_rows(s.verdicts, s.bundle, RUN_ID, s.run_ts)


@register
def response_ledger(s: Stages) -> DataFrame:
    return ledgers.response_rows(s.responses, RUN_ID, s.run_ts)


@register
def validation_rollup(s: Stages) -> DataFrame:
    return ledgers.validation_rollup(
        ledgers.validation_rows(s.verdicts, s.bundle, RUN_ID, s.run_ts)
    )


@register
def attempt_classify(s: Stages) -> DataFrame:
    return response.classify_attempts(s.input("attempts"), 2).select(
        "event_id", "attempt_number", "error_class", "retryable", "attempt_status"
    )
