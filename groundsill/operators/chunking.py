"""Knowledge becomes chunks: type resolution, eligibility gate, three ways to cut text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from groundsill import fixed
from groundsill.functions import text as tx
from groundsill.functions.ids import chunk_key
from groundsill.schemas import CHUNK

SECTION_PATTERN = (
    rf"\n\s*(?:{tx.any_of(fixed.SECTION_HEADINGS)}|Step\s+\d+)\s*:?"
).replace("\\-", "-")
PACK_PATTERN = rf"(?i)(?={tx.any_of(fixed.PACK_HEADINGS)})".replace("\\-", "-")


def with_effective_type(knowledge: DataFrame) -> DataFrame:
    """Missing type becomes the default; any other is trimmed and lower-cased."""
    kind = F.col("knowledge_type")
    return knowledge.withColumn(
        "knowledge_type_effective",
        F.when(kind.isNull(), fixed.DEFAULT_KNOWLEDGE_TYPE).otherwise(F.lower(F.trim(kind))),
    )


def with_eligibility(knowledge: DataFrame) -> DataFrame:
    """Adds the effective type and ``validation_status`` APPROVED or REJECTED."""
    typed = with_effective_type(knowledge)
    text = F.col("content_text")
    rejected = tx.is_placeholder(text) | tx.is_short_low_signal(
        text, F.col("knowledge_type_effective")
    )
    return typed.withColumn(
        "validation_status", F.when(rejected, "REJECTED").otherwise("APPROVED")
    )


def approved(knowledge: DataFrame) -> DataFrame:
    return with_eligibility(knowledge).where("validation_status = 'APPROVED'")


def eligibility_summary(knowledge: DataFrame) -> DataFrame:
    return (
        with_eligibility(knowledge)
        .groupBy("knowledge_type_effective", "validation_status")
        .agg(F.count("*").alias("rows"))
    )


def to_chunks(pieces: DataFrame, created_at: Column, also: Sequence[str] = ()) -> DataFrame:
    """Bring rows with ``chunk_index`` and ``chunk_text`` to the chunk contract, and keep ``also``."""
    return pieces.select(
        chunk_key(F.col("knowledge_id"), F.col("chunk_index"), F.col("chunk_text")).alias(
            "knowledge_chunk_id"
        ),
        "knowledge_id",
        F.col("knowledge_type").alias("knowledge_type_original"),
        "knowledge_type_effective",
        F.col("chunk_index").cast("int").alias("chunk_index"),
        "chunk_text",
        tx.tokens_chars4(F.col("chunk_text")).alias("chunk_token_count"),
        "business_domain", "equipment_id", "line_id", "event_date", "source_reference",
        created_at.cast("timestamp").alias("created_at"), *also,
    )


def _of_types(knowledge: DataFrame, types: list[str] | None) -> DataFrame:
    if types is None:
        return knowledge
    return knowledge.where(F.col("knowledge_type_effective").isin(types))


def single_chunks(knowledge: DataFrame, created_at: Column,
                  types: list[str] | None = fixed.SINGLE_CHUNK_TYPES,
                  also: Sequence[str] = ()) -> DataFrame:
    """One row, one chunk."""
    rows = _of_types(knowledge, types)
    return to_chunks(
        rows.withColumn("chunk_index", F.lit(0)).withColumnRenamed("content_text", "chunk_text"),
        created_at, also,
    )


def section_chunks(knowledge: DataFrame, created_at: Column,
                   types: list[str] | None = fixed.SECTION_TYPES,
                   also: Sequence[str] = ()) -> DataFrame:
    """Cut at headings that start a line. The heading is consumed; blank sections are dropped
    but keep their ordinal."""
    rows = _of_types(knowledge, types)
    cut = rows.select(
        *[c for c in rows.columns if c != "content_text"],
        F.posexplode(F.split("content_text", SECTION_PATTERN)).alias("chunk_index", "piece"),
    )
    trimmed = cut.withColumn("chunk_text", F.trim("piece")).where(F.col("chunk_text") != "")
    return to_chunks(trimmed.drop("piece"), created_at, also)


def pack_sections(text: Column, max_chars: int = fixed.PACK_CHARS) -> Column:
    """Array of packed pieces: cut before headings, then fill up while below ``max_chars``.

    A section too long for one piece is cut hard, so no piece exceeds the limit and no text is
    lost. Blank pieces do not occur.
    """

    def slices(part: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(part), F.lit(1)), F.lit(max_chars))
        return F.transform(starts, lambda i: F.substring(part, i, F.lit(max_chars)))

    parts = F.flatten(F.transform(F.split(text, PACK_PATTERN), slices))
    empty = F.expr("cast(array() as array<string>)")

    def closed(state: Column) -> Column:
        last = tx.strip(state["open"])
        return F.when(last == "", state["done"]).otherwise(F.concat(state["done"], F.array(last)))

    def step(state: Column, part: Column) -> Column:
        fits = F.length(state["open"]) + F.length(part) < max_chars
        return F.when(
            fits,
            F.struct(
                state["done"].alias("done"),
                F.concat(state["open"], F.lit(" "), part).alias("open"),
            ),
        ).otherwise(F.struct(closed(state).alias("done"), part.alias("open")))

    start = F.struct(empty.alias("done"), F.lit("").alias("open"))
    return F.aggregate(parts, start, step, closed)


def packed_chunks(knowledge: DataFrame, created_at: Column, types: list[str] | None = None,
                  max_chars: int = fixed.PACK_CHARS, also: Sequence[str] = ()) -> DataFrame:
    """Size-bounded pieces, numbered from 0 within each row."""
    rows = _of_types(knowledge, types)
    pieces = rows.select(
        *[c for c in rows.columns if c != "content_text"],
        F.posexplode(pack_sections(F.col("content_text"), max_chars)).alias(
            "chunk_index", "chunk_text"
        ),
    )
    return to_chunks(pieces, created_at, also)


def resplit_chunks(knowledge: DataFrame, created_at: Column, max_tokens: int,
                   types: list[str] | None = None,
                   max_chars: int = fixed.PACK_CHARS) -> DataFrame:
    """Sections first; a section with too many tokens is packed again; numbered from 0.

    Both passes work on the array of one row, so renumbering needs no shuffle.
    """

    def second_pass(section: Column) -> Column:
        return F.when(
            tx.tokens_chars4(section) > max_tokens, pack_sections(section, max_chars)
        ).otherwise(F.array(section))

    rows = _of_types(knowledge, types)
    sections = F.filter(
        F.transform(F.split("content_text", SECTION_PATTERN), lambda s: F.trim(s)),
        lambda s: s != "",
    )
    pieces = rows.select(
        *[c for c in rows.columns if c != "content_text"],
        F.posexplode(F.flatten(F.transform(sections, second_pass))).alias(
            "chunk_index", "chunk_text"
        ),
    )
    return to_chunks(pieces, created_at)


def all_chunks(knowledge: DataFrame, created_at: Column, also: Sequence[str] = ()) -> DataFrame:
    """Every approved row, cut the way its type asks for; its columns ``also`` are kept."""
    rows = approved(knowledge)
    parts = [
        single_chunks(rows, created_at, also=also),
        section_chunks(rows, created_at, ["maintenance"], also=also),
        packed_chunks(rows, created_at, ["sop"], also=also),
    ]
    return reduce(DataFrame.unionByName, parts).select(*CHUNK.fieldNames(), *also)


def chunk_checks(chunks: DataFrame) -> DataFrame:
    """Null ids, poor text and uniqueness. One shuffle, of one narrow row per id.

    Counting per id first keeps the distinct count spread out: a plain count(distinct) next to
    other counts would expand every row.
    """
    text = F.col("chunk_text")
    per_id = chunks.groupBy("knowledge_chunk_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("knowledge_id").isNull()).alias("null_parent"),
        F.count_if(text.isNull() | (F.length(F.trim(text)) < fixed.MIN_CHUNK_CHARS)).alias("bad"),
        F.count_if(F.col("chunk_token_count") <= 0).alias("no_tokens"),
    )
    has_id = F.col("knowledge_chunk_id").isNotNull()
    totals = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(~has_id, F.col("n"))), F.lit(0)).alias("null_chunk_id"),
        F.coalesce(F.sum("null_parent"), F.lit(0)).alias("null_knowledge_id"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_text"),
        F.coalesce(F.sum("no_tokens"), F.lit(0)).alias("no_tokens"),
        F.count_if(has_id).alias("distinct_ids"),
    )
    return totals.withColumn("ids_unique", F.col("total_rows") == F.col("distinct_ids"))


SKETCH_ITEMS = 4096
"""Exact up to so many rows a group; beyond, ranks are off by less than a thousandth."""


def token_sketches(chunks: DataFrame, part: str = "event_date", items: int = SKETCH_ITEMS) -> DataFrame:
    """Per type and ``part`` (a day, a run) what is needed to merge token statistics later: counts,
    extremes and a quantile sketch of bounded size. New parts are added without reading old rows."""
    return chunks.groupBy("knowledge_type_effective", part).agg(
        F.count("*").alias("rows"), F.min("chunk_token_count").alias("min_tokens"),
        F.max("chunk_token_count").alias("max_tokens"),
        F.kll_sketch_agg_bigint(F.col("chunk_token_count").cast("bigint"), items).alias("sketch"))


def merge_token_sketches(stored: DataFrame, items: int = SKETCH_ITEMS) -> DataFrame:
    """Token statistics by type over any set of stored parts. Quantiles are values that occur."""
    merged = stored.groupBy("knowledge_type_effective").agg(
        F.sum("rows").alias("rows"), F.min("min_tokens").alias("min_tokens"),
        F.max("max_tokens").alias("max_tokens"),
        F.kll_merge_agg_bigint("sketch", items).alias("sketch"))

    def quantile(share: float) -> Column:
        return F.kll_sketch_get_quantile_bigint("sketch", F.lit(share))

    return merged.select(
        "knowledge_type_effective", "rows", "min_tokens", quantile(0.5).alias("p50_tokens"),
        quantile(0.95).alias("p95_tokens"), "max_tokens")


def token_counts(chunks: DataFrame, part: str = "event_date") -> DataFrame:
    """How many chunks of a type and ``part`` have how many tokens: what exact statistics are merged
    from. Bounded by the distinct counts, that is by the longest text, not by the rows."""
    return chunks.groupBy("knowledge_type_effective", part, "chunk_token_count").agg(
        F.count("*").alias("rows"))


def merge_token_counts(stored: DataFrame) -> DataFrame:
    """As ``merge_token_sketches``, exact at any size: a quantile is the first value that so many
    hundredths of the rows do not exceed."""
    kind, tokens = "knowledge_type_effective", F.col("chunk_token_count")
    merged = stored.groupBy(kind, "chunk_token_count").agg(F.sum("rows").alias("rows"))
    known = F.sum(F.when(tokens.isNotNull(), F.col("rows")))
    ranked = merged.withColumns({
        "_upto": known.over(Window.partitionBy(kind).orderBy("chunk_token_count")),
        "_known": known.over(Window.partitionBy(kind))})

    def quantile(hundredths: int) -> Column:
        place = F.col("_known") - F.expr(f"_known * {100 - hundredths} div 100")
        return F.min(F.when(F.col("_upto") >= place, tokens)).cast("bigint")

    return ranked.groupBy(kind).agg(
        F.sum("rows").alias("rows"), F.min(tokens).alias("min_tokens"),
        quantile(50).alias("p50_tokens"), quantile(95).alias("p95_tokens"),
        F.max(tokens).alias("max_tokens"))


def token_stats(chunks: DataFrame) -> DataFrame:
    """Smallest, median and largest token count by type. The median keeps one counter per
    distinct count, so its state is bounded by the longest text, not by the rows."""
    return chunks.groupBy("knowledge_type_effective").agg(
        F.min("chunk_token_count").alias("min_tokens"),
        F.percentile("chunk_token_count", F.lit(0.5)).alias("p50_tokens"),
        F.max("chunk_token_count").alias("max_tokens"),
        F.count("*").alias("rows"),
    )
