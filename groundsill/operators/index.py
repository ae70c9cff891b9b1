"""From embeddings, chunks and knowledge to one validated, numbered vector table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from groundsill import fixed
from groundsill.functions import vectors as vx
from groundsill.operators.numbering import dense_numbers
from groundsill.policy import EmbeddingPin
from groundsill.session import materialize


def eligible_chunks(chunks: DataFrame) -> DataFrame:
    return chunks.where((~F.col("is_quarantined")) & F.col("eligible_at").isNotNull())


def pinned_embeddings(embeddings: DataFrame, pin: EmbeddingPin) -> DataFrame:
    return embeddings.where(
        (F.col("status") == "SUCCESS")
        & F.col("embedding_vector").isNotNull()
        & (F.col("embedding_dimension") == pin.dimension)
        & (F.col("embedding_model_name") == pin.model_name)
        & (F.col("embedding_model_version") == pin.model_version)
    )


def index_input(embeddings: DataFrame, chunks: DataFrame, knowledge: DataFrame,
                pin: EmbeddingPin) -> DataFrame:
    """The 21 columns an index is built from, one row per chunk of the pinned model.

    A vector can be 12 KB wide, so it is shuffled once only: deduplicated by chunk id, and
    joined by chunk id to two narrower sides that were prepared without it. The pinned version
    is a constant, so chunk id alone is the full key. The newest embedding of a chunk wins.
    """
    vectors = pinned_embeddings(embeddings, pin)
    newest = [
        F.col(c).desc()
        for c in ("embedded_at", "pipeline_run_id", "knowledge_id", "chunk_text_hash")
    ]
    first = Window.partitionBy("knowledge_chunk_id").orderBy(*newest)

    def one_per_chunk(df: DataFrame) -> DataFrame:
        # A row_number filter is cut to one row per key before the shuffle as well.
        return df.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")

    e = one_per_chunk(vectors).select(
        F.col("knowledge_chunk_id").alias("chunk_id"),
        F.col("knowledge_id").alias("e_knowledge_id"),
        "embedding_vector",
        F.col("embedding_dimension").alias("embedding_dim"),
        "embedding_model_name", "embedding_model_version", "chunk_text_hash", "embedded_at",
        F.col("pipeline_run_id").alias("embedding_run_id"),
    )
    owner = one_per_chunk(
        vectors.select(
            "knowledge_chunk_id", "knowledge_id", "embedded_at", "pipeline_run_id",
            "chunk_text_hash",
        )
    ).select(F.col("knowledge_chunk_id").alias("k_chunk_id"), "knowledge_id")
    k = owner.join(
        knowledge.select(
            "knowledge_id", "business_domain", "event_date", "equipment_id", "line_id",
            "source_reference",
        ),
        "knowledge_id",
    ).drop("knowledge_id")
    c = eligible_chunks(chunks).select(
        F.col("knowledge_chunk_id").alias("c_chunk_id"),
        F.col("knowledge_id").alias("c_knowledge_id"),
        F.col("knowledge_type_effective").alias("knowledge_type"),
        "chunk_index", "chunk_text", "chunk_token_count", "created_at",
        F.col("pipeline_run_id").alias("chunk_pipeline_run_id"),
    )
    joined = e.join(c, F.col("chunk_id") == F.col("c_chunk_id")).join(
        k, F.col("chunk_id") == F.col("k_chunk_id")
    )
    return joined.select(
        "chunk_id", F.col("e_knowledge_id").alias("knowledge_id"),
        "embedding_vector", "embedding_dim", "embedding_model_name", "embedding_model_version",
        "knowledge_type", "business_domain", "event_date", "equipment_id", "line_id",
        "source_reference",
        "chunk_index", "chunk_token_count", "chunk_text", "chunk_text_hash", "embedded_at",
        "embedding_run_id", "chunk_pipeline_run_id", "created_at",
        (F.col("e_knowledge_id") != F.col("c_knowledge_id")).alias("knowledge_id_mismatch"),
    )


def join_integrity(embeddings: DataFrame, chunks: DataFrame, knowledge: DataFrame,
                   pin: EmbeddingPin) -> DataFrame:
    """Rows that the inner joins of ``index_input`` leave out, as three counts in one row."""
    e = pinned_embeddings(embeddings, pin).select("knowledge_chunk_id", "knowledge_id")
    c = eligible_chunks(chunks).select("knowledge_chunk_id")
    without_chunk = e.join(c, "knowledge_chunk_id", "left_anti")
    without_vector = c.join(e, "knowledge_chunk_id", "left_anti")
    without_knowledge = e.join(c, "knowledge_chunk_id", "left_semi").join(
        knowledge.select("knowledge_id"), "knowledge_id", "left_anti"
    )

    def tagged(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("check"))

    found = (
        tagged(without_chunk, "embeddings_without_chunk")
        .unionAll(tagged(without_vector, "chunks_without_embedding"))
        .unionAll(tagged(without_knowledge, "chunks_without_knowledge"))
    )

    def count(name: str) -> Column:
        return F.count_if(F.col("check") == name).alias(name)

    return found.agg(
        count("embeddings_without_chunk"), count("chunks_without_embedding"),
        count("chunks_without_knowledge"),
    )


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def validate_index_input(rows: DataFrame, dimension: int) -> DataFrame:
    """Every hard rule in one job: counts, error codes, verdict.

    Rows are first folded per key on the map side; what is shuffled is one narrow record per
    key, without vectors or text.
    """
    null_names = {name: f"null_{name}" for name in fixed.INDEX_REQUIRED_COLUMNS}
    per_key = rows.groupBy("chunk_id", "embedding_model_version").agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(out) for c, out in null_names.items()],
        F.count_if(F.col("embedding_dim") != dimension).alias("dim_mismatch"),
        F.count_if(F.size("embedding_vector") != F.col("embedding_dim")).alias(
            "length_mismatch"
        ),
        F.count_if("knowledge_id_mismatch").alias("knowledge_id_mismatch"),
    )
    summed = ["n", *null_names.values(), "dim_mismatch", "length_mismatch",
              "knowledge_id_mismatch"]
    totals = per_key.agg(
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias("total_rows" if c == "n" else c)
          for c in summed],
    )
    rules = [(F.col("total_rows") == 0, fixed.INDEX_EMPTY)]
    rules += [
        (F.col(out) > 0, fixed.INDEX_NULLS_PREFIX + c.upper()) for c, out in null_names.items()
    ]
    rules += [
        (F.col("duplicate_keys") > 0, fixed.INDEX_DUPLICATES),
        (F.col("dim_mismatch") > 0, fixed.INDEX_DIMENSION),
        (F.col("length_mismatch") > 0, fixed.INDEX_LENGTH),
        (F.col("knowledge_id_mismatch") > 0, fixed.INDEX_KNOWLEDGE_ID),
    ]
    codes = F.array_compact(F.array(*[F.when(broken, F.lit(code)) for broken, code in rules]))
    return totals.withColumn("errors", codes).withColumn(
        "verdict", F.when(F.size("errors") == 0, fixed.PASSED).otherwise(fixed.FAILED)
    )


def require_valid(verdict: DataFrame) -> DataFrame:
    """The verdict row, or a failed job that names the broken rules."""
    message = F.concat(F.lit("index input: "), F.array_join("errors", ", "))
    return verdict.withColumn(
        "verdict",
        F.when(F.size("errors") == 0, F.col("verdict")).otherwise(
            F.raise_error(message).cast("string")
        ),
    )


def export_index(rows: DataFrame) -> DataFrame:
    """Numbered vectors with metadata in one dataset, sorted by chunk id.

    ``vector_id`` runs 0..n-1 by chunk id. Only narrow keys are numbered; vectors and texts join
    their number. Rows whose vector cannot be searched are in ``rejected_vectors``.

    Rows are written once before they are numbered, as keys are read for the ranges, for the numbers
    and for the join: ``rows`` is usually a join of three tables.
    """
    unit = materialize(rows.select(
        "chunk_id", vx.normalize(F.col("embedding_vector")).alias("unit_vector"),
        "knowledge_id", "knowledge_type", "event_date", "equipment_id", "line_id",
        "source_reference", "chunk_text",
    ).where(F.col("unit_vector").isNotNull()))
    numbers = dense_numbers(unit.select("chunk_id"), "chunk_id", "vector_id")
    return unit.join(numbers, "chunk_id")


def rejected_vectors(rows: DataFrame, dimension: int) -> DataFrame:
    """Rows that ``export_index`` cannot take, with the reason."""
    return rows.select(
        "chunk_id", "knowledge_id",
        vx.vector_error(F.col("embedding_vector"), dimension).alias("error_code"),
        vx.normalize(F.col("embedding_vector")).alias("_unit"),
    ).where(F.col("_unit").isNull()).drop("_unit")


def build_manifest(export: DataFrame, pin: EmbeddingPin, index_name: str, index_version: str,
                   export_run_id: str, built_at_utc: str, path: str) -> DataFrame:
    """One row that describes an export, with the count and dimension found in it."""
    found = export.agg(
        F.count("*").alias("vector_count"),
        F.max(F.size("unit_vector")).alias("embedding_dim"),
    )
    return found.select(
        F.lit(index_name).alias("index_name"),
        F.lit(index_version).alias("index_version"),
        F.lit(pin.model_name).alias("embedding_model_name"),
        F.lit(pin.model_version).alias("embedding_model_version"),
        F.coalesce("embedding_dim", F.lit(pin.dimension)).cast("int").alias("embedding_dim"),
        F.lit("cosine").alias("similarity"),
        F.col("vector_count").cast("bigint").alias("vector_count"),
        F.lit(export_run_id).alias("export_run_id"),
        F.lit(built_at_utc).alias("built_at_utc"),
        F.lit(f"{path}/vectors").alias("index_file"),
        F.lit(f"{path}/vectors").alias("id_map"),
        F.lit(f"{path}/vectors").alias("metadata"),
    )


def manifest_checks(manifest: DataFrame, export: DataFrame) -> DataFrame:
    """Compare a manifest with the vectors it names; ``error_code`` is null when they agree.

    Ids and keys are unique and dense exactly when, over n rows, their distinct counts are n
    and the ids run from 0 to n-1. Both distinct counts are taken after a fold per value.
    """
    by_id = export.groupBy("vector_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("chunk_id").isNull()).alias("no_key"),
        F.min(F.size("unit_vector")).alias("low"), F.max(F.size("unit_vector")).alias("high"),
    )
    ids = by_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("no_key"), F.lit(0)).alias("null_keys"),
        F.count("vector_id").alias("distinct_ids"),
        F.min("vector_id").alias("min_id"), F.max("vector_id").alias("max_id"),
        F.min("low").alias("min_dim"), F.max("high").alias("max_dim"),
    )
    keys = export.groupBy("chunk_id").agg(F.lit(1).alias("one")).agg(
        F.count("chunk_id").alias("distinct_keys")
    )
    # Three one-row tables meet on a constant.
    side = manifest.withColumn("_one", F.lit(1)).join(
        ids.withColumn("_one", F.lit(1)), "_one", "left"
    ).join(keys.withColumn("_one", F.lit(1)), "_one", "left").drop("_one")
    dense = (
        (F.col("null_keys") == 0)
        & (F.col("distinct_ids") == F.col("rows"))
        & (F.col("distinct_keys") == F.col("rows"))
        & (F.coalesce("min_id", F.lit(0)) == 0)
        & (F.coalesce(F.col("max_id") + 1, F.lit(0)) == F.col("rows"))
    )
    agrees = (F.col("rows") == F.col("vector_count")) & (
        F.col("rows").eqNullSafe(0)
        | ((F.col("min_dim") == F.col("embedding_dim"))
           & (F.col("max_dim") == F.col("embedding_dim")))
    )
    return side.withColumn("ids_dense", dense).withColumn(
        "error_code", F.when(~(dense & agrees), fixed.MANIFEST_MISMATCH)
    )
