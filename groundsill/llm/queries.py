"""Registered queries of this subpackage and the SQL that some of them must match."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsill.llm import (
    decontaminate,
    extract,
    fim,
    langid,
    minhash,
    mixing,
    neighbours,
    phrases,
    pii,
    substring,
    tokens,
    urls,
    warc,
)
from groundsill.llm.tables import table

FOUR_WORDS = minhash.MinHash(shingle=4)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of the contract, then a list of all pages on hosts that call themselves spam."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in urls.RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {listed} AS t(rule, verdict)")
    spam = reduce(lambda a, b: a | b, [
        urls.host(F.col("url")).contains(word) for word in urls.SPAM_HOSTS])
    return urls.judge(pages, rules, pages.where(spam).select("url")).select(
        "page_id", "host", "path", "rule", "verdict")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(
        table(spark, sf_dir, "documents").select("doc_id", "text"), FOUR_WORDS)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document counted before and after four edits: its first line goes, a mark is put into its
    middle, the stretch after its first third becomes its source, and a line is added at its end."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    size = F.length("text")
    line = F.instr("text", "\n")
    edits = F.array(*[
        F.struct(F.greatest(start, F.lit(0)).cast("bigint").alias("start"),
                 length.cast("bigint").alias("length"), replacement.alias("replacement"))
        for start, length, replacement in [
            (F.lit(0), line, F.lit("")),
            (F.floor((size - line) / 2), F.lit(0), F.lit(" [edited] ")),
            (F.floor((size - line) / 3), F.lit(12), F.col("source")),
            (size - line + 20, F.lit(0), F.lit("\nSource: edited by hand.")),
        ]])
    return tokens.count_edited(documents, edits).select(
        "doc_id", "tokens_before", "tokens_after", "n_edits", "n_pretokens", "n_reencoded")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(embeddings, embeddings.where("vec_id % 20 = 0"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark"))


def op7_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_records(spark, warc.archive(table(spark, sf_dir, "pages")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return langid.identify(documents.select("doc_id", "text"), learn_from=documents).select(
        "doc_id", "held_out", "lang_pred", "score")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(documents, window=20, with_text=False).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("fim_text", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("form"), F.col("fim_text")), 256).alias("restored_sha256"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rules = F.filter("pii", lambda s: s["by_rule"])
    kinds = F.transform(rules, lambda s: s["kind"])
    return found.select(
        "doc_id",
        *[(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}")
          for kind in pii.KINDS],
        F.sha2(pii.listed(rules), 256).alias("base_sha256"),
        pii.listed(F.col("pii")).alias("spans"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_html_extraction": op2_html_extraction,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_neighbours": op5_neighbours,
    "op6_decontaminate": op6_decontaminate,
    "op7_poisson_mix": op7_poisson_mix,
    "op8_warc": op8_warc,
    "op9_language_id": op9_language_id,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_personal_data": op13_personal_data,
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": urls.SQL,
    "op3_minhash_near_dedup": minhash.sql(FOUR_WORDS),
    "op7_poisson_mix": mixing.sql("documents"),
    "op8_warc": warc.SQL,
    "op10_substring_dedup": substring.sql(),
    "op11_fill_in_middle": fim.sql(),
    "op12_phrase_collocations": phrases.sql(),
}
