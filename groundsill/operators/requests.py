"""Raw search requests: normalised, judged, routed. One shuffle, by request id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from groundsill import fixed
from groundsill.functions import text as tx
from groundsill.functions.ids import text_hash
from groundsill.policy import GateConfig

_FILTERS = ["knowledge_type_effective", "equipment_id", "event_date_start", "event_date_end"]


def _kind(name: str) -> Column:
    """What a filter's JSON value is: STRING, ARRAY<...>, another type, or null if it is absent."""
    return F.schema_of_variant(F.try_variant_get("_json", f"$.{name}", "variant"))


def _strings(name: str) -> Column:
    """A JSON value that is a string or a list of strings, as an array of stripped strings."""
    listed = F.try_variant_get("_json", f"$.{name}", "array<string>")
    alone = F.try_variant_get("_json", f"$.{name}", "string")
    values = F.when(_kind(name).startswith("ARRAY"), listed).when(
        _kind(name) == "STRING", F.array(alone))
    return F.transform(values, tx.strip)


def _numbered(rows: DataFrame) -> DataFrame:
    """Requests that ask under the same id get a number behind it from the second on, in the order
    of what they say; so every id names one request."""
    said = F.to_json(F.struct("_raw_query", "index_name", "index_version", "_raw_k", "filters",
                              "_raw_override"))
    place = F.row_number().over(Window.partitionBy("request_id").orderBy(text_hash(said)))
    return rows.withColumn("_place", place).withColumn(
        "request_id", F.when(F.col("_place") > 1, F.concat_ws(
            "-", "request_id", F.col("_place").cast("string"))).otherwise(F.col("request_id"))
    ).drop("_place")


def validate(requests: DataFrame, gate: GateConfig = GateConfig()) -> DataFrame:
    """Every request with its parsed fields and ``error_message``: the first broken rule, or
    null. All columns arrive as text (``filters`` as a JSON object), so broken JSON or a wrong type
    is a finding and not a crash. A null or blank id is made from what the request says, and
    requests with the same id are numbered, so ids are unique."""
    parsed = requests.select(
        F.col("request_id"),
        F.col("query_text").alias("_raw_query"),
        tx.strip(F.col("query_text")).alias("query_text"),
        tx.strip(F.col("index_name")).alias("index_name"),
        tx.strip(F.col("index_version")).alias("index_version"),
        F.col("top_k").alias("_raw_k"),
        F.expr("try_cast(top_k as int)").alias("_k"),
        F.col("filters"),
        F.try_parse_json("filters").alias("_json"),
        F.col("min_similarity_override").alias("_raw_override"),
        F.expr("try_cast(min_similarity_override as double)").alias("min_similarity_override"),
    )
    said = F.to_json(F.struct("_raw_query", "index_name", "index_version", "_raw_k", "filters",
                              "_raw_override"))
    parsed = _numbered(parsed.withColumn("request_id", F.coalesce(
        F.when(tx.strip(F.col("request_id")) != "", F.col("request_id")),
        F.concat(F.lit("req-"), text_hash(said)))))
    parsed = parsed.withColumns({
        f"_{name}": F.try_variant_get("_json", f"$.{name}", "string") for name in _FILTERS})
    fields = parsed.withColumns({
        "top_k": F.when(F.col("_raw_k").isNull(), gate.default_top_k).otherwise(F.col("_k")),
        "type_filter": _strings("knowledge_type_effective"),
        "equipment_filter": _strings("equipment_id"),
        "event_date_start": F.expr("try_to_date(_event_date_start, 'yyyy-MM-dd')"),
        "event_date_end": F.expr("try_to_date(_event_date_end, 'yyyy-MM-dd')"),
    })

    def mistyped(name: str, lists: bool = True) -> Column:
        kind = _kind(name)
        fits = kind == "STRING"
        return F.coalesce(~(fits | kind.startswith("ARRAY") if lists else fits | (kind == "VOID")),
                          F.lit(False))

    present = [
        F.coalesce(F.col(f"_{name}"), F.lit("")) != ""
        for name in ("event_date_start", "event_date_end")
    ]
    no_date_text = mistyped("event_date_start", False) | mistyped("event_date_end", False)
    not_dates = F.col("event_date_start").isNull() | F.col("event_date_end").isNull()
    k, override = F.col("top_k"), F.col("min_similarity_override")
    text = F.col("query_text")
    has_filters = F.coalesce(tx.strip(F.col("filters")), F.lit("")) != ""
    rules = [
        (F.length("request_id") > gate.max_request_id_chars, fixed.REQUEST_ID_INVALID),
        (F.col("_raw_query").isNull(), fixed.QUERY_NOT_STRING),
        (text == "", fixed.QUERY_EMPTY),
        (F.length(text) > gate.max_query_chars, fixed.QUERY_TOO_LONG),
        (~tx.is_good_query(text, gate), fixed.QUERY_LOW_QUALITY),
        (F.coalesce("index_name", F.lit("")) == "", fixed.INDEX_NAME_REQUIRED),
        (F.coalesce("index_version", F.lit("")) == "", fixed.INDEX_VERSION_REQUIRED),
        (F.lower("index_version").isin(fixed.VERSION_ALIASES), fixed.INDEX_VERSION_ALIAS),
        (F.col("_raw_k").isNotNull() & F.col("_k").isNull(), fixed.TOP_K_NOT_INTEGER),
        ((k < 1) | (k > gate.max_top_k), fixed.TOP_K_RANGE),
        (has_filters & ~F.coalesce(
            F.schema_of_variant("_json").startswith("OBJECT"), F.lit(False)),
         fixed.FILTERS_NOT_OBJECT),
        ((F.size("type_filter") == 0) | mistyped("knowledge_type_effective"),
         fixed.TYPE_FILTER_EMPTY),
        (mistyped("equipment_id") | (
            (_kind("equipment_id") == "STRING") & (tx.strip(F.col("_equipment_id")) == "")),
         fixed.EQUIPMENT_FILTER_INVALID),
        (no_date_text | (present[0] | present[1]) & not_dates, fixed.DATES_NOT_DATES),
        (F.col("event_date_start") > F.col("event_date_end"), fixed.DATES_REVERSED),
        (F.col("_raw_override").isNotNull() & override.isNull(), fixed.OVERRIDE_NOT_NUMERIC),
        ((override < 0.0) | (override > 1.0) | F.isnan(override), fixed.OVERRIDE_RANGE),
    ]
    error = F.coalesce(*[F.when(broken, F.lit(message)) for broken, message in rules])
    return fields.select(
        "request_id",
        "query_text",
        text_hash(text).alias("query_text_hash"),
        "index_name", "index_version", "top_k",
        (k * gate.candidate_multiplier).alias("candidate_k"),
        "type_filter",
        F.filter("equipment_filter", lambda e: e != "").alias("equipment_filter"),
        "event_date_start", "event_date_end", "min_similarity_override",
        error.alias("error_message"),
    )


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("error_message").isNull()).drop("error_message")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("error_message").isNotNull())


def query_quality(requests: DataFrame, gate: GateConfig = GateConfig()) -> DataFrame:
    """What the lexical gate sees in each request, and its verdict."""
    text = tx.strip(F.col("query_text"))
    tokens = tx.query_tokens(text)
    return requests.select(
        "request_id",
        F.length(text).alias("n_chars"),
        F.size(tokens).alias("n_tokens"),
        F.size(F.filter(tokens, lambda t: t.rlike("[A-Za-z]"))).alias("n_alpha_tokens"),
        tx.has_repeat(text, 5).alias("has_repeat"),
        F.coalesce(tx.is_good_query(text, gate), F.lit(False)).alias("quality_ok"),
    )


def normalize_type(raw: Column) -> Column:
    """Synonyms to the one canonical name; anything else trimmed and lower-cased."""
    bare = F.lower(tx.strip(raw))
    branches = F
    for kind, names in fixed.TYPE_SYNONYMS.items():
        branches = branches.when(bare.isin(names), F.lit(kind))
    return branches.otherwise(bare)


def infer_type(question: Column) -> Column:
    """The type a question asks about, by its first matching keyword rule, or null."""
    low = F.lower(question)
    branches = F
    for kind, keywords in fixed.TYPE_KEYWORDS:
        hit = low.contains(keywords[0])
        for word in keywords[1:]:
            hit = hit | low.contains(word)
        branches = branches.when(hit, F.lit(kind))
    return branches


def route(requests: DataFrame, question: str = "query_text") -> DataFrame:
    """Adds the date found in the question, the inferred type and the first router to try."""
    found = tx.iso_date(F.col(question))
    return requests.withColumns({
        "parsed_iso_date": found,
        "inferred_type": infer_type(F.col(question)),
        "router": F.when(found.isNotNull(), "structured_event_date").otherwise("vector"),
    })
