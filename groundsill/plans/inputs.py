"""Inputs of the registered queries, derived from the given tables.

The given tables hold orders, events, documents, vectors and conversations; the jobs expect
operational records, knowledge, embeddings, search requests and generated answers. Each input
below is one SELECT that reads whole tables and renames or decorates their rows. Values that
depend on ``key % n`` only vary what a row says, so that every rule meets rows that keep it and
rows that break it; no row is left out.

The text is plain SQL that Spark and the checking engine both run; ``Dialect`` holds the few
spellings that differ.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from groundsill.sources.gold import GOLD_COLUMNS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

MODEL = "hash-embed"
VERSION = "v1"
DIMENSION = 64


@dataclass(frozen=True)
class Dialect:
    """How a table is named and how the few differing functions are spelled."""

    table: str
    sha256: str
    vector_zip: str
    vector_head: str

    def of(self, name: str) -> str:
        return self.table.format(name=name)


CHECKER = Dialect(
    table="{name}",
    sha256="sha256({0})",
    vector_zip=(
        "list_transform(list_zip({0}, {1}),"
        " lambda z: CAST(z[1] AS DOUBLE) {2} CAST(z[2] AS DOUBLE))"
    ),
    vector_head="list_slice({0}, 1, {1})",
)


def _view(sf_dir: str, name: str) -> str:
    return f"src_{zlib.crc32(sf_dir.rstrip('/').encode())}_{name}"


def spark_dialect(sf_dir: str) -> Dialect:
    return Dialect(
        table=_view(sf_dir, "{name}"),
        sha256="sha2({0}, 256)",
        vector_zip="zip_with({0}, {1}, (x, y) -> CAST(x AS DOUBLE) {2} CAST(y AS DOUBLE))",
        vector_head="slice({0}, 1, {1})",
    )


def _string(value: str) -> str:
    return f"CAST({value} AS STRING)"


def _whole(value: str) -> str:
    """A double as the text of its whole part."""
    return _string(f"CAST(FLOOR({value}) AS BIGINT)")


def _day(value: str) -> str:
    return _string(f"CAST({value} AS DATE)")


def _choose(key: str, modulus: int, cases: dict[int, str], other: str) -> str:
    arms = " ".join(f"WHEN {rest} THEN {value}" for rest, value in cases.items())
    return f"CASE {key} % {modulus} {arms} ELSE {other} END"


def build(d: Dialect) -> dict[str, str]:
    """Every input by name. A later one may use an earlier one by its name."""
    q: dict[str, str] = {}

    q["gold_incident"] = f"""
        SELECT 'INC_' || {_string('o_orderkey')} AS incident_id,
          CASE WHEN o_orderkey % 29 = 0 THEN 'pending' ELSE {_day('o_orderdate')} END
            AS incident_date,
          'Unit_' || c_mktsegment AS equipment_name, c_mktsegment AS equipment_type,
          'LINE_' || {_string('c_nationkey')} AS line_id,
          CASE o_orderstatus WHEN 'F' THEN 'Bearing failure' WHEN 'O' THEN 'Overheat'
            ELSE 'Pressure drop' END AS failure_type,
          o_orderpriority AS failure_category,
          CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'wear at ' || c_name END AS root_cause,
          {_whole('o_totalprice / 1000')} AS downtime_minutes,
          'exchange of unit ' || {_string('o_custkey')} AS resolution_action,
          substr(o_orderpriority, 1, 1) AS severity, o_orderstatus AS shift,
          c_name AS reported_by,
          CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE c_name END AS verified_by,
          {_string('o_orderkey % 40')} AS environmental_temp_c,
          {_string('o_orderkey % 100')} AS humidity_percent,
          {_string('o_custkey % 50')} AS production_impact_units,
          {_string('o_orderkey % 9')} AS labor_hours,
          {_whole('o_totalprice')} AS parts_cost_usd, {_string('o_custkey')} AS mttr_minutes,
          {_whole('c_acctbal')} AS mtbf_hours
        FROM {d.of('orders')} JOIN {d.of('customer')} ON o_custkey = c_custkey"""

    q["gold_quality"] = f"""
        SELECT 'QM_' || {_string('l_orderkey')} || '_' || {_string('l_linenumber')}
            AS metric_id,
          'SKU_' || {_string('p_partkey')} AS product_sku, ' ' || p_name || ' ' AS product_name,
          'BATCH_' || {_string('l_suppkey')} AS batch_id,
          CASE WHEN l_orderkey % 31 = 0 THEN '2024-13-01' ELSE {_day('l_shipdate')} END
            AS inspection_date,
          CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE p_type END AS defect_type,
          CASE WHEN l_partkey % 12 = 0 THEN NULL ELSE ' ' || p_brand END AS defect_category,
          CASE WHEN l_orderkey % 14 = 0 THEN NULL ELSE {_whole('l_quantity')} END
            AS defect_count,
          CASE WHEN l_orderkey % 15 = 0 THEN NULL ELSE {_whole('l_extendedprice')} END
            AS total_inspected,
          CASE WHEN l_orderkey % 16 = 0 THEN NULL ELSE {_whole('l_discount * 100 + 0.5')} END
            AS defect_rate_percent,
          {_whole('l_tax * 1000 + 0.5')} AS defect_rate_ppm,
          CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE 'Stage ' || l_linestatus END
            AS inspection_stage,
          CASE WHEN l_suppkey % 8 = 0 THEN NULL ELSE 'rework ' || l_returnflag END
            AS corrective_action,
          '2' AS specification_limit_percent, 'Maximum' AS specification_type,
          'Inspector ' || {_string('l_suppkey')} AS inspector_name, 'Gauge' AS measurement_tool,
          {_whole('l_extendedprice')} AS cost_impact_usd, {_string('p_size')} AS rework_hours,
          {_string('l_linenumber')} AS scrap_count, l_returnflag AS shift,
          {_string('p_size % 40')} AS temperature_c, {_string('p_size')} AS humidity_percent,
          'LINE_' || {_string('l_linenumber')} AS line_id,
          'EQ_' || {_string('l_suppkey')} AS equipment_id
        FROM {d.of('lineitem')} JOIN {d.of('part')} ON l_partkey = p_partkey"""

    q["gold_maintenance"] = f"""
        SELECT 'MAINT_' || {_string('s_suppkey')} AS maintenance_id,
          'EQ_' || {_string('s_suppkey')} AS equipment_id, s_name AS equipment_name,
          'LINE_' || {_string('s_nationkey')} AS line_id,
          CASE WHEN s_suppkey % 2 = 0 THEN 'Preventive' ELSE 'Corrective' END
            AS maintenance_type,
          n_name AS maintenance_category,
          {_string("DATE '2024-01-01' + CAST(s_suppkey % 90 AS INT)")} AS maintenance_date,
          {_string('s_suppkey % 8')} AS duration_hours, 'Tech ' || n_name AS technician_name,
          'Level ' || {_string('n_regionkey')} AS certification_level,
          {_whole('s_acctbal')} AS total_cost_usd,
          'checked valve ' || {_string('s_suppkey')} AS work_performed,
          CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE 'Seal wear' END AS failure_mode,
          'OPERATIONAL' AS equipment_status, 'Scheduled' AS downtime_impact,
          'ROUTINE' AS work_priority
        FROM {d.of('supplier')} JOIN {d.of('nation')} ON s_nationkey = n_nationkey"""

    q["gold_production"] = f"""
        SELECT 'PROD_' || {_string('event_id')} AS metric_id,
          'LINE_' || {_string('user_id % 9')} AS line_id, {_day('ts')} AS shift_date,
          event_type AS shift, '480' AS planned_production_time_min,
          {_whole('value')} AS downtime_min, {_string('user_id')} AS operating_time_min,
          {_string('event_id % 900')} AS total_units_produced,
          {_string('event_id % 800')} AS good_units, {_string('event_id % 100')} AS defect_units,
          {_string('user_id % 100')} AS availability_percent,
          {_string('event_id % 97')} AS performance_percent,
          {_string('event_id % 93')} AS quality_percent,
          {_string('event_id % 89')} AS oee_percent, '75' AS target_oee_percent,
          'EQ_' || {_string('user_id')} AS equipment_ids_used,
          {_string('user_id % 6')} AS crew_size, 'Lead ' || {_string('user_id % 12')}
            AS shift_supervisor,
          CASE WHEN event_id % 10 = 0 THEN NULL ELSE props END AS notes
        FROM {d.of('events')}"""

    q["gold_sop"] = f"""
        SELECT 'SOP_' || {_string('doc_id')} AS sop_id, 'Title ' || source AS document_title,
          lang AS document_type, 'EQ_' || {_string('doc_id % 7')} AS equipment_id,
          'Machine ' || {_string('doc_id % 7')} AS equipment_name, '1.0' AS version,
          {_string("DATE '2023-01-01' + CAST(doc_id % 365 AS INT)")} AS effective_date,
          '2025-01-01' AS review_date, source AS author, source AS approver,
          'REG ' || lang AS regulatory_reference, {_string('n_chars % 50')} AS page_count,
          {_string('n_chars')} AS word_count, '2024-06-01' AS last_updated,
          text AS content_text
        FROM {d.of('documents')}"""

    # The incidents as lines of header CSV, as files of many origins bring them: some with commas and
    # quotes inside of fields, some with fields too many or too few, open quotes, headers and blanks.
    q["csv_incidents"] = """
        SELECT * FROM (
          SELECT incident_id, incident_date, equipment_name, equipment_type, line_id, failure_type,
            failure_category, root_cause, downtime_minutes,
            CASE WHEN incident_key % 5 = 0 THEN resolution_action || ', then "tested"'
              WHEN incident_key % 5 = 1 THEN '"sealed" ' || resolution_action
              ELSE resolution_action END AS resolution_action,
            severity, shift, reported_by, verified_by, environmental_temp_c, humidity_percent,
            production_impact_units, labor_hours, parts_cost_usd, mttr_minutes, mtbf_hours,
            incident_key,
            CASE WHEN incident_key % 43 = 1 THEN 'more' WHEN incident_key % 47 = 2 THEN 'fewer'
              WHEN incident_key % 53 = 3 THEN 'open' WHEN incident_key % 59 = 4 THEN 'blank'
              WHEN incident_key % 61 = 5 THEN 'header' ELSE 'good' END AS damage
          FROM (SELECT *, CAST(substr(incident_id, 5) AS BIGINT) AS incident_key FROM gold_incident)
          AS keyed) AS named"""
    quoted = " || ',' || ".join(
        f"""CASE WHEN {c} IS NULL THEN '' ELSE '"' || replace({c}, '"', '""') || '"' END"""
        for c in GOLD_COLUMNS["incident"])
    few = " || ',' || ".join(f"coalesce({c}, '')" for c in GOLD_COLUMNS["incident"][:4])
    q["csv_lines"] = f"""
        SELECT incident_key, damage, CASE damage WHEN 'fewer' THEN {few}
            WHEN 'blank' THEN repeat(' ', CAST(incident_key % 3 AS INT))
            WHEN 'header' THEN '{",".join(GOLD_COLUMNS["incident"])}'
            ELSE {quoted} || CASE damage WHEN 'more' THEN ',"extra",more'
              WHEN 'open' THEN ',"never closed' ELSE '' END END AS line
        FROM csv_incidents"""

    # Knowledge and chunks by document: five types, some missing, some texts not worth keeping.
    q["doc_knowledge"] = f"""
        SELECT doc_id, 'DOC_' || {_string('doc_id')} AS knowledge_id,
          CASE WHEN doc_id % 17 = 0 THEN NULL ELSE {_choose('doc_id', 5, {
              0: "' SOP '", 1: "'maintenance'", 2: "'Incident'", 3: "'production'"},
              "'quality'")} END AS knowledge_type,
          lang AS business_domain,
          CASE WHEN doc_id % 22 = 0 THEN 'On 125 , ' || text ELSE text END AS content_text,
          source AS source_reference,
          CASE WHEN doc_id % 11 = 0 THEN NULL
            ELSE DATE '2024-01-01' + CAST(doc_id % 30 AS INT) END AS event_date,
          CASE WHEN doc_id % 13 = 0 THEN NULL
            ELSE 'EQ_' || lpad({_string('doc_id % 7')}, 5, '0') END AS equipment_id,
          'LINE_A' || {_string('doc_id % 4')} AS line_id
        FROM {d.of('documents')}
        UNION ALL
        SELECT -1 - doc_id, 'POOR_' || {_string('doc_id')}, 'incident', lang,
          {_choose('doc_id', 3, {0: "' OK '", 1: "'n/a'"}, "'maintenance ok: pump replaced'")},
          source, DATE '2024-01-05', NULL, NULL
        FROM {d.of('documents')} WHERE doc_id % 31 = 3"""

    # The same texts with a heading at the start of most lines, to be cut at.
    q["headed_knowledge"] = """
        SELECT doc_id, knowledge_id, knowledge_type, business_domain,
          CASE doc_id % 4
            WHEN 0 THEN replace(content_text, chr(10), chr(10) || 'SAFETY: ')
            WHEN 1 THEN replace(content_text, chr(10), chr(10) || ' Step 12 : ')
            WHEN 2 THEN replace(content_text, chr(10), chr(10) || 'Procedure maintenance ')
            ELSE content_text END AS content_text,
          source_reference, event_date, equipment_id, line_id
        FROM doc_knowledge"""

    zeros = d.vector_zip.format("embedding", "embedding", "-")
    text_hash = d.sha256.format("content_text")
    chunk_id = d.sha256.format(f"knowledge_id || '|0|' || {text_hash}")
    q["embeds_run"] = f"""
        SELECT vec_id,
          CASE WHEN doc_id IS NULL THEN 'ORPHAN_' || {_string('vec_id')} ELSE {chunk_id} END
            AS knowledge_chunk_id,
          CASE WHEN vec_id % 43 = 0 THEN 'DOC_0' ELSE 'DOC_' || {_string('vec_id')} END
            AS knowledge_id,
          knowledge_type AS knowledge_type_effective, source_reference,
          'offline' AS embedding_provider, '{MODEL}' AS embedding_model_name,
          CASE WHEN vec_id % 23 = 0 THEN 'v0' ELSE '{VERSION}' END AS embedding_model_version,
          CASE WHEN vec_id % 41 = 0 THEN 63 ELSE {DIMENSION} END AS embedding_dimension,
          CASE WHEN vec_id % 47 = 0 THEN NULL WHEN vec_id % 53 = 7 THEN {zeros} ELSE embedding END
            AS embedding_vector,
          CASE WHEN vec_id % 37 = 0 THEN 'stale' ELSE {text_hash} END AS chunk_text_hash,
          CASE WHEN vec_id % 19 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
          CASE WHEN vec_id % 19 = 0 THEN 'TIMEOUT' END AS error_type,
          CASE WHEN vec_id % 19 = 0 THEN 'timeout' END AS error_message
        FROM {d.of('embeddings')} LEFT JOIN doc_knowledge ON vec_id = doc_id"""

    # Two runs: every vector was stored twice, and the later one counts.
    q["embeds"] = """
        SELECT embeds_run.*, 'run_2' AS pipeline_run_id,
          TIMESTAMP '2024-02-02 00:00:00' AS embedded_at FROM embeds_run
        UNION ALL
        SELECT embeds_run.*, 'run_1' AS pipeline_run_id,
          TIMESTAMP '2024-02-01 00:00:00' AS embedded_at FROM embeds_run"""

    # What a later run brings: every document gets a vector borrowed from another row.
    q["embed_changes"] = f"""
        SELECT doc_id AS vec_id, {chunk_id} AS knowledge_chunk_id, knowledge_id,
          knowledge_type AS knowledge_type_effective, source_reference,
          'offline' AS embedding_provider,
          CASE WHEN doc_id % 3 = 0 THEN 'other-model' ELSE '{MODEL}' END
            AS embedding_model_name,
          'v2' AS embedding_model_version, {DIMENSION} AS embedding_dimension,
          embedding AS embedding_vector, {text_hash} AS chunk_text_hash, 'SUCCESS' AS status,
          CAST(NULL AS STRING) AS error_type, CAST(NULL AS STRING) AS error_message,
          'run_3' AS pipeline_run_id, TIMESTAMP '2024-02-03 00:00:00' AS embedded_at
        FROM doc_knowledge JOIN {d.of('embeddings')}
          ON vec_id = doc_id % (SELECT count(*) FROM {d.of('embeddings')})"""

    doubled = d.vector_zip.format("embedding", "embedding", "+")
    q["raw_vectors"] = f"""
        SELECT vec_id, CASE WHEN vec_id % 31 = 4 THEN NULL WHEN vec_id % 29 = 3 THEN {zeros}
            WHEN vec_id % 17 = 2 THEN {d.vector_head.format(doubled, DIMENSION - 1)}
            ELSE {doubled} END AS vector
        FROM {d.of('embeddings')}"""

    filters = {
        0: '\'["sop"]\'',
        1: '\'{"knowledge_type_effective":["sop","maintenance"]}\'',
        2: '\'{"knowledge_type_effective":"incident"}\'',
        3: '\'{"knowledge_type_effective":[]}\'',
        4: '\'{"equipment_id":["EQ_00001"," EQ_00002 ","","EQ_00004"]}\'',
        5: '\'{"equipment_id":"  "}\'',
        6: '\'{"equipment_id":"EQ_00003"}\'',
        7: '\'{"event_date_start":"2024-01-03","event_date_end":"2024-01-27"}\'',
        8: '\'{"event_date_start":"2024-01-25","event_date_end":"2024-01-05"}\'',
        9: '\'{"event_date_start":"2024-01-05"}\'',
        10: '\'{"event_date_start":"soon","event_date_end":"2024-01-05"}\'',
        11: "'{}'",
        12: '\'{"knowledge_type_effective":["sop","quality"," incident"],'
            '"event_date_start":"2024-01-02","event_date_end":"2024-01-29"}\'',
    }
    broken = {
        0: '\'{"equipment_id": "EQ_1", bad}\'',
        1: "'{equipment_id: EQ_1}'",
        2: '\'{"knowledge_type_effective": 5}\'',
        3: '\'{"equipment_id": {"a": 1}}\'',
        4: '\'{"event_date_start": 5, "event_date_end": "2024-01-05"}\'',
        5: "'text'",
    }
    asked = f"""text
          || CASE WHEN conv_id % 3 = 0 THEN ' on 2024-01-' || lpad({_string('1 + conv_id % 30')},
             2, '0') ELSE '' END
          || {_choose('conv_id', 6, {0: "' quality'", 1: "' incident'", 2: "' maintenance'",
                                     3: "' procedure'", 4: "' DEFECT sop'"}, "''")}"""
    q["raw_requests"] = f"""
        SELECT conv_id, turn,
          CASE WHEN conv_id % 41 = 4 THEN repeat('x', 65) ELSE '' END
            || {_string('conv_id')} || '-' || {_string('turn')} AS request_id,
          {asked} AS query_text,
          {_choose('conv_id', 33, {9: "'  '"}, "' chunks '")} AS index_name,
          CASE WHEN conv_id % 37 = 1 THEN NULL ELSE {_choose('conv_id', 16, {
              0: "'Latest'", 5: "'v9'", 6: "'v0'"}, "'v1'")} END AS index_version,
          {_choose('conv_id', 15, {0: 'NULL', 1: "'0'", 2: "'25'", 3: "'five'"},
                   _string('1 + turn % 7 + conv_id % 3'))} AS top_k,
          {_choose('conv_id', 30, filters, 'NULL')} AS filters,
          {_choose('conv_id', 14, {3: "'0.25'", 5: "'1.5'", 6: "'high'"}, 'NULL')}
            AS min_similarity_override
        FROM {d.of('conversations')} WHERE role = 'user'
        UNION ALL
        SELECT conv_id, turn, 'poor-' || {_string('conv_id')} || '-' || {_string('turn')},
          {_choose('conv_id', 6, {0: "'aaaaaaaa bb cc'", 1: "'  '", 2: "NULL",
                                  3: "'12 34 56 78 9a'", 4: "'singleword'"},
                   "repeat(text || ' ', 100)")}, 'chunks', 'v1', '5', NULL, NULL
        FROM {d.of('conversations')} WHERE role = 'user' AND conv_id % 5 = 2
        UNION ALL
        SELECT conv_id, turn, 'broken-' || {_string('conv_id')} || '-' || {_string('turn')}, text,
          'chunks', 'v1', '5', {_choose('conv_id', 6, broken, broken[5])}, NULL
        FROM {d.of('conversations')} WHERE role = 'user' AND conv_id % 7 = 3"""

    # A request's vector is the sum of two stored ones, so it has two clear neighbours.
    total = f"(SELECT count(*) FROM {d.of('embeddings')})"
    q["query_pairs"] = f"""
        SELECT request_id, (conv_id * 7 + turn * 3) % {total} AS first_vec,
          (conv_id * 11 + turn * 5 + 1) % {total} AS second_vec
        FROM raw_requests"""
    q["query_vectors"] = f"""
        SELECT request_id, {d.vector_zip.format('a.embedding', 'b.embedding', '+')} AS query_vector
        FROM query_pairs JOIN {d.of('embeddings')} a ON a.vec_id = first_vec
        JOIN {d.of('embeddings')} b ON b.vec_id = second_vec"""

    # Published versions: what their manifests say and what is there; v0's manifest names one more.
    q["manifest_rows"] = """
        SELECT 'chunks' AS index_name, embedding_model_version AS index_version,
          CASE WHEN embedding_model_version = 'v0' THEN 1 ELSE 0 END + count(embedding_vector)
            AS vector_count
        FROM embeds GROUP BY embedding_model_version"""
    q["indexed_rows"] = """
        SELECT 'chunks' AS index_name, embedding_model_version AS index_version,
          vec_id AS vector_id, knowledge_id
        FROM embeds WHERE embedding_vector IS NOT NULL"""

    # Answers follow the user turn before them; what is appended decides the verdict.
    endings = {
        0: "text || ' [C0].'",
        1: "text || ' [C0] [C99]'",
        2: "'On 2024-01-10 the pump was replaced. ' || text",
        5: "'1. The belt was replaced on 2024-01-03 [C0].' || chr(10) || '2. ' || text"
           " || ' [C00] [C0]'",
        6: "text || ' Unit EQ_ZZ999 was checked [C0]'",
        7: "text || ' [C0]' || chr(10) || ' ' || chr(10) || ' The valve was repaired.'",
        8: "text || ' was replaced [C0] and then removed'",
        9: "text || ' Unit EQ_00001 was checked [C0]' || chr(10) || '3. eq_ seen [c0]'",
    }
    refusal = ("'NO_EVIDENCE: The provided evidence does not contain sufficient information to"
               " answer this question.'")
    q["generations"] = f"""
        SELECT {_string('conv_id')} || '-' || {_string('turn - 1')} AS request_id,
          {_choose('(conv_id + turn)', 10, endings, 'text')} AS raw_model_text,
          {_choose('conv_id', 21, {5: "'FAILED'", 9: "'NO_EVIDENCE'", 13: 'NULL'}, "'OK'")}
            AS generation_status,
          'model-' || {_string('conv_id % 3')} AS model_name,
          CAST(length(text) AS INT) AS prompt_tokens, CAST(turn AS INT) AS completion_tokens,
          CAST(length(text) + turn AS INT) AS total_tokens,
          CAST(conv_id % 900 AS INT) AS latency_ms
        FROM {d.of('conversations')} WHERE role = 'assistant'
        UNION ALL
        SELECT 'refused-' || {_string('conv_id')} || '-' || {_string('turn')},
          CASE WHEN conv_id % 2 = 0 THEN {refusal} ELSE 'NO_EVIDENCE: other' END, 'OK', 'model-r',
          1, 1, 2, 3
        FROM {d.of('conversations')} WHERE role = 'assistant' AND conv_id % 5 = 3"""

    q["attempts"] = f"""
        SELECT event_id, {_string('user_id')} AS request_id,
          CAST(1 + event_id % 3 AS INT) AS attempt_number,
          {_choose('event_id', 7, {0: "'Request Timeout after 30 s'", 1: "'HTTP 429'",
                                   2: "'Internal Server Error'", 3: "'Connection reset'",
                                   4: "'bad request'", 5: "'Rate limit, network busy'"},
                   'NULL')} AS error_message,
          'ProviderError' AS error_type,
          CAST(FLOOR(value * 10) AS INT) AS latency_ms, CAST(event_id % 500 AS INT) AS tokens,
          'run_' || {_string('event_id % 4')} AS pipeline_run_id,
          CASE WHEN event_id % 7 = 6 OR event_id % 4 = 1 THEN 'SUCCESS' ELSE 'FAILED' END
            AS status,
          event_id % 4 = 2 AND event_id % 101 = 0 AS dimension_mismatch,
          CAST(FLOOR(event_id / 50) AS BIGINT) AS batch_id, ts AS started_at, ts AS ended_at
        FROM {d.of('events')}"""
    return q


def needed(name: str, queries: dict[str, str]) -> list[str]:
    """``name`` and the inputs it builds on, in definition order."""
    wanted, names = {name}, list(queries)
    for other in reversed(names[: names.index(name)]):
        if any(re.search(rf"\b{other}\b", queries[w]) for w in wanted):
            wanted.add(other)
    return [n for n in names if n in wanted]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as its files are split; how fine is the session's setting."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input as a DataFrame over the parquet tables in ``sf_dir``."""
    queries = build(spark_dialect(sf_dir))
    steps = ", ".join(f"{n} AS ({queries[n]})" for n in needed(name, queries))
    for base in TABLES:
        if _view(sf_dir, base) in steps:
            table(spark, sf_dir, base).createOrReplaceTempView(_view(sf_dir, base))
    return spark.sql(f"WITH {steps} SELECT * FROM {name}")
