"""Words, phrases, codes and formats that decide results.

Everything here is data, stated once. Change a value and results change; the code that uses it
holds no other literals of this kind.
"""

# --- fixed values: knowledge types and domains -------------------------------------------
KNOWLEDGE_TYPES = ["incident", "quality", "maintenance", "production", "sop"]
DEFAULT_KNOWLEDGE_TYPE = "quality"
DOMAIN_BY_TYPE = {
    "incident": "operations",
    "quality": "quality",
    "maintenance": "manufacturing_operations",
    "production": "manufacturing_operations",
    "sop": "manufacturing_operations",
}
TYPE_SYNONYMS = {
    "maintenance": ["maint", "maintenance"],
    "incident": ["incident", "incidents"],
    "quality": ["quality", "defect", "defects"],
    "sop": ["sop", "procedure", "procedures"],
}
# Ordered: the first type with a matching keyword wins.
TYPE_KEYWORDS = [
    ("quality", ["quality", "defect"]),
    ("incident", ["incident"]),
    ("maintenance", ["maintenance"]),
    ("sop", ["sop", "procedure"]),
]

# --- fixed values: eligibility gate ------------------------------------------------------
PLACEHOLDERS = ["n/a", "na", "none", "tbd", "all good", "no issues", "ok", "passed"]
ACTION_SIGNALS = [
    "shutdown", "failure", "alarm", "trip", "leak", "replaced", "calibrated", "lubricated",
    "repaired", "inspection failed", "defect", "exceeded", "warning", "must", "do not",
    "before", "after", "stopped",
]
MEASURE_UNITS = ["%", "ppm", "usd", "hours", "hrs", "minutes", "min", "°c", "bar", "rpm"]
OUTCOME_SIGNALS = [
    "initiated", "completed", "failed", "triggered", "stopped", "started", "replaced",
]
SHORT_TEXT_CHARS = 120
SHORT_TEXT_EXEMPT_TYPES = ["sop", "maintenance"]
MIN_CHUNK_CHARS = 40

# --- fixed values: chunking --------------------------------------------------------------
SINGLE_CHUNK_TYPES = ["incident", "production", "quality"]
SECTION_TYPES = ["sop", "maintenance"]
SECTION_HEADINGS = [
    "SCOPE", "SAFETY", "PRE-STARTUP", "STARTUP", "OPERATION", "INSPECTION", "MAINTENANCE",
    "CALIBRATION", "WARNING", "NOTE",
]
PACK_HEADINGS = [
    "SCOPE:", "SAFETY", "PRE-", "STARTUP", "OPERATION", "PROCEDURE", "EMERGENCY",
    "MAINTENANCE", "REVISION",
]
PACK_CHARS = 2500
CHARS_PER_TOKEN = 4

# --- fixed values: quarantine ------------------------------------------------------------
MALFORMED_DATE_PREFIX = r"^On\s+(\d+(\.\d+)?)\s*,"
DATED_TYPES = ["incident", "maintenance", "production"]
MALFORMED_EVENT_DATE = "MALFORMED_EVENT_DATE_IN_TEXT"
MISSING_EVENT_DATE = "MISSING_EVENT_DATE"
SOP_TOKEN_OVERFLOW = "SOP_TOKEN_OVERFLOW"

# --- fixed values: index validation ------------------------------------------------------
INDEX_REQUIRED_COLUMNS = [
    "chunk_id", "knowledge_id", "embedding_vector", "embedding_dim", "embedding_model_name",
    "embedding_model_version", "knowledge_type",
]
INDEX_EMPTY = "NO_ROWS_IN_INDEX_INPUT"
INDEX_NULLS_PREFIX = "NULLS_IN_"
INDEX_DUPLICATES = "DUPLICATE_CHUNK_ID_MODEL_VERSION"
INDEX_DIMENSION = "EMBEDDING_DIMENSION_MISMATCH"
INDEX_LENGTH = "VECTOR_LENGTH_MISMATCH"
INDEX_KNOWLEDGE_ID = "KNOWLEDGE_ID_MISMATCH"
INDEX_NOT_FOUND = "INDEX_NOT_FOUND"
MANIFEST_MISMATCH = "MANIFEST_MISMATCH"

# --- fixed values: request validation, in the order the rules apply ----------------------
VERSION_ALIASES = ["latest", "current", "default"]
REQUEST_ID_INVALID = "Invalid request_id"
QUERY_NOT_STRING = "query_text must be a string"
QUERY_EMPTY = "query_text cannot be empty"
QUERY_TOO_LONG = "query_text exceeds maximum allowed length"
QUERY_LOW_QUALITY = "query_text failed quality gate (likely junk or OOD input)"
INDEX_NAME_REQUIRED = "index_name is required"
INDEX_VERSION_REQUIRED = "index_version is required"
INDEX_VERSION_ALIAS = "index_version must be immutable"
TOP_K_NOT_INTEGER = "top_k must be an integer"
TOP_K_RANGE = "top_k out of range"
FILTERS_NOT_OBJECT = "filters must be an object"
TYPE_FILTER_EMPTY = "knowledge_type_effective must be non-empty"
EQUIPMENT_FILTER_INVALID = "equipment_id invalid"
DATES_NOT_DATES = "event_date filters must be dates"
DATES_REVERSED = "event_date_start > event_date_end"
OVERRIDE_NOT_NUMERIC = "min_similarity_override must be numeric"
OVERRIDE_RANGE = "min_similarity_override out of range"

# --- fixed values: retrieval outcomes ----------------------------------------------------
SUCCESS = "SUCCESS"
NO_EVIDENCE = "NO_EVIDENCE"
FAILED = "FAILED"
OK = "OK"
PASSED = "PASSED"
NO_SURVIVORS = "No chunks meet similarity and filter criteria"
TOO_FEW_STRONG = "Query failed semantic validity check (likely OOD input)"
SPREAD_TOO_WIDE = "Query failed similarity distribution check (likely OOD)"

# --- fixed values: selection -------------------------------------------------------------
INJECTION_PHRASES = [
    "ignore previous instructions", "system prompt", "you are chatgpt", "developer message",
    "act as",
]
DROP_LOW_TOP = "NO_EVIDENCE_LOW_SIMILARITY"
DROP_FLOOR = "DROP_SIMILARITY_FLOOR"
DROP_EMPTY = "DROP_EMPTY_TEXT"
DROP_NOISE = "DROP_NOISE_TEXT"
DROP_TYPE = "DROP_KNOWLEDGE_TYPE"
DROP_EQUIPMENT_NULL = "DROP_EQUIPMENT_NULL"
DROP_EQUIPMENT_MISMATCH = "DROP_EQUIPMENT_MISMATCH"
DROP_DATE_NULL = "DROP_EVENTDATE_NULL"
DROP_DATE_MISMATCH = "DROP_EVENTDATE_MISMATCH"
DROP_DUPLICATE = "DROP_DUP_CHUNK_ID"
DROP_KNOWLEDGE_CAP = "DROP_KNOWLEDGE_ID_CAP"
DROP_OVERLAP = "DROP_OVERLAP"
DROP_BUDGET = "DROP_BUDGET"
FLAG_INJECTION = "INJECTION_RISK"
FLAG_CONFLICT = "POSSIBLE_CONFLICT"
EMPTY_RETRIEVAL = "EMPTY_RETRIEVAL_RESULTS"
EMPTY_AFTER_FILTERS = "ALL_DROPPED_AFTER_FILTERS"
EMPTY_AFTER_CAP = "ALL_DROPPED_AFTER_KNOWLEDGE_CAP"
EMPTY_AFTER_BUDGETS = "ALL_DROPPED_AFTER_BUDGETS"
CONFLICT_NUMBERS = 25

# --- fixed values: assembly and prompt ---------------------------------------------------
ASSEMBLY_NOT_SUCCESS = "RETRIEVAL_STATUS_NOT_SUCCESS"
ASSEMBLY_AFTER_SELECTION = "NO_EVIDENCE_AFTER_SELECTION"
ASSEMBLY_EMPTY = "NO_EVIDENCE_EMPTY_SELECTION"
CONTEXT_EXCEEDED = "CONTEXT_WINDOW_EXCEEDED"
PROMPT_NOT_READY = "ASSEMBLY_NOT_OK"
REFUSAL_PREFIX = "NO_EVIDENCE:"
REFUSAL = (
    "NO_EVIDENCE: The provided evidence does not contain sufficient information to answer"
    " this question."
)

# --- fixed values: grounding -------------------------------------------------------------
FACT_VERBS = [
    "performed", "replaced", "adjusted", "verified", "calibrated", "installed", "removed",
    "returned", "addressed", "fixed", "repaired", "changed",
]
FACT_FRAGMENTS = ["eq_", "line_"]
ID_PREFIXES = ["EQ_", "LINE_", "MAINT_", "SOP_"]
GENERATION_NOT_OK = "GENERATION_NOT_OK"
INVALID_REFUSAL = "INVALID_REFUSAL_FORMAT"
NO_CITATIONS = "NO_CITATIONS_PRESENT"
INVALID_CITATION = "INVALID_CITATION_REFERENCE"
UNCITED_FACT = "UNCITED_FACTUAL_STATEMENT"
EXTERNAL_KNOWLEDGE = "POSSIBLE_EXTERNAL_KNOWLEDGE"
CITATION_MISMATCH = "CITATION_MISMATCH"

# --- fixed values: provider errors, in the order the rules apply -------------------------
PROVIDER_ERRORS = [
    ("TIMEOUT", ["timeout"]),
    ("RATE_LIMIT_429", ["rate limit", "429"]),
    ("SERVER_5XX", ["5xx", "internal server error", "server error"]),
    ("NETWORK", ["connection", "network"]),
]

# Wording of the narratives. Each phrase names one field.
NARRATIVES = {
    "incident": [
        "Incident report of {incident_date}:", "line {line_id},", "machine {equipment_name}",
        "of type {equipment_type}.", "Observed failure: {failure_type};", "class: {failure_category}.",
        "Cause found: {root_cause}.", "Production stood still for {downtime_minutes} min.",
        "Remedy: {resolution_action}.", "Rated {severity}.",
    ],
    "quality": [
        "Inspection of {inspection_date}", "at the {inspection_stage} stage:", "{product_name}",
        "with item number {product_sku}", "from line {line_id}.", "Defect: {defect_type};",
        "class: {defect_category}.", "Rejected pieces: {defect_count};",
        "checked pieces: {total_inspected};", "share in percent: {defect_rate_percent}.",
        "Measure taken: {corrective_action}.",
    ],
    "maintenance": [
        "Service of {maintenance_date}:", "kind {maintenance_type},", "machine {equipment_name},",
        "number {equipment_id},", "line {line_id}.", "Field of work: {maintenance_category};",
        "reason: {failure_mode}.", "Work done: {work_performed}.",
        "Condition afterwards: {equipment_status}.",
    ],
    "production": [
        "Shift report of {shift_date},", "{shift} shift,", "line {line_id}.",
        "Effectiveness in percent: {oee_percent}", "(aim {target_oee_percent}).",
        "Pieces made: {total_units_produced};", "good: {good_units};", "defective: {defect_units};",
        "standstill in min: {downtime_min}.", "Speed in percent: {performance_percent};",
        "yield in percent: {quality_percent}.", "Remarks: {notes}.",
    ],
    "sop": [
        "{sop_id},", "{document_title},", "for {equipment_name}:", "{content_text}",
    ],
}


def phrase_parts(phrase: str) -> tuple[str, str, str]:
    """What stands before the field, the field's name, and what stands after it."""
    before, _, rest = phrase.partition("{")
    name, _, after = rest.partition("}")
    return before, name, after
