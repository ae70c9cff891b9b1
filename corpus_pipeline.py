"""The corpus pipeline: documents in, a cleaned and mixed training corpus out.

Each stage works on all that its predecessor kept, and what it decides takes effect. A stage's result
is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsill.llm import decontaminate, langid, minhash, mixing, substring
from groundsill.llm.tables import table, without
from groundsill.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.3


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those for which no language is likelier than
    ``LEAST_SCORE`` over the whole text."""
    return langid.identify(docs.select(*COLUMNS)).where(
        (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at similarity 0.8 over five-word shingles, the one with the smallest id
    stays."""
    judged = minhash.near_duplicates(docs.select("doc_id", "text"), minhash.MinHash())
    return without(docs.select(*COLUMNS), "doc_id", judged.where("not kept").select("doc_id"))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 20 words and more that start earlier in the corpus; a document that is
    nothing else goes."""
    cut = substring.remove_repeats(docs.select(*COLUMNS), window=20)
    return cut.where("n_removed = 0 or n_removed < n_words").select(
        "doc_id", "text", "lang", "source",
        F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        .cast("bigint").alias("n_chars"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, give or take one edit in twenty characters."""
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that all sources weigh the same."""
    return mixing.mix(docs.select(*COLUMNS))


STAGES = [
    ("language_id", keep_known_languages),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontaminate", drop_leaks),
    ("poisson_mix", mix_sources),
]

# A recurrent network decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
