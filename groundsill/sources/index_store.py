"""Published index versions: immutable folders, each complete once its manifest exists.

Layout: ``<root>/index_name=<name>/index_version=<version>/{vectors,manifest}``. The vectors
dataset holds id, key, unit vector and metadata together, so they cannot fall out of step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsill import fixed
from groundsill.operators.index import build_manifest
from groundsill.policy import EmbeddingPin
from groundsill.schemas import MANIFEST


def version_path(root: str, index_name: str, index_version: str) -> str:
    return f"{root.rstrip('/')}/index_name={index_name}/index_version={index_version}"


def publish(export: DataFrame, root: str, index_name: str, index_version: str,
            pin: EmbeddingPin, export_run_id: str, built_at_utc: str) -> str:
    """Write a version; refuse to touch one that exists. The manifest goes last, so a reader
    that finds it finds everything. It is computed from the written vectors."""
    spark = export.sparkSession
    path = version_path(root, index_name, index_version)
    export.write.mode("errorifexists").parquet(f"{path}/vectors")
    written = spark.read.parquet(f"{path}/vectors")
    manifest = build_manifest(
        written, pin, index_name, index_version, export_run_id, built_at_utc, path
    )
    manifest.coalesce(1).write.mode("errorifexists").json(f"{path}/manifest")
    return path


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Manifests of every published version under ``root``."""
    return spark.read.schema(MANIFEST).json(
        f"{root.rstrip('/')}/index_name=*/index_version=*/manifest"
    )


def load_index(spark: SparkSession, root: str, index_name: str, index_version: str) -> DataFrame:
    """Vectors of one published version, as a pruned read of one folder."""
    return spark.read.parquet(f"{version_path(root, index_name, index_version)}/vectors")


def catalog(manifests: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row per known version with what is there: a manifest, vectors, ids, metadata."""
    keys = ["index_name", "index_version"]
    found = vectors.groupBy(*keys).agg(
        F.count("*").alias("vectors_found"),
        F.count("vector_id").alias("ids_found"),
        F.count("knowledge_id").alias("metadata_found"),
    )
    return manifests.select(*keys, "vector_count").join(found, keys, "full").select(
        *keys,
        F.col("vector_count").isNotNull().alias("has_manifest"),
        (F.coalesce("vectors_found", F.lit(0)) > 0).alias("has_vectors"),
        (F.coalesce("ids_found", F.lit(0)) > 0).alias("has_id_map"),
        (F.coalesce("metadata_found", F.lit(0)) > 0).alias("has_metadata"),
        F.coalesce(F.col("vector_count") == F.col("vectors_found"), F.lit(False)).alias(
            "counts_agree"
        ),
    )


def check_versions(requests: DataFrame, versions: DataFrame) -> DataFrame:
    """Requests with ``index_error``: null when the asked version is complete and consistent.

    ``versions`` has one row per published version. It is joined, not broadcast by force, so
    the optimizer picks by size.
    """
    complete = (
        F.col("has_manifest") & F.col("has_vectors") & F.col("has_id_map")
        & F.col("has_metadata")
    )
    joined = requests.join(versions, ["index_name", "index_version"], "left")
    error = F.when(~F.coalesce(complete, F.lit(False)), fixed.INDEX_NOT_FOUND).when(
        ~F.col("counts_agree"), fixed.MANIFEST_MISMATCH
    )
    return joined.select(*[requests[c] for c in requests.columns if c not in (
        "index_name", "index_version")], "index_name", "index_version",
        error.alias("index_error"))
