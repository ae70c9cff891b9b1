"""Mixing sources to target weights by Poisson replication, with built-in functions only.

A source's mean repetition rate is the number of rows it should have over the number it has. Each
document draws its number of copies from the Poisson distribution with that mean: a uniform number,
taken from a hash of the seed and the document's id, is looked up in the distribution's cumulative
sums. Copies are exploded and dealt out and sorted by another hash, which is a global shuffle
that comes out the same on every run and on every retry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundsill.llm.tables import free_name
from groundsill.session import materialize

PART_MEAN = 8
"""A larger mean is drawn as a sum of equal parts of at most this mean, which is again Poisson."""
TERMS = 64
"""Cumulative sums per part; what lies beyond 64 at mean 8 is below 1e-30, finer than the draws."""


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from 48 bits of a hash of the parts."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 12)
    return (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(2**48))


def rates(documents: DataFrame, weights: DataFrame | None, rows: int | None,
          source_col: str) -> DataFrame:
    """``source, have, rate, parts, sums``: one row per source of ``documents``."""
    have = documents.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("have"))
    if weights is None:
        weighed = have.withColumn("weight", F.lit(1.0))
    else:
        given = weights.groupBy(F.col("source").alias("_s")).agg(
            F.sum(F.greatest(F.col("weight").cast("double"), F.lit(0.0))).alias("weight"))
        weighed = have.join(given, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        weighed = weighed.withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    # Sums as a join on one row, so that a long list of sources is not put into one window.
    total = weighed.agg(F.sum("have").alias("n"), F.sum("weight").alias("w")).select(
        F.lit(1).alias("one"), "n", "w")
    wanted = F.col("n") if rows is None else F.lit(rows)
    rate = F.coalesce(wanted * F.col("weight") / F.col("w") / F.col("have"), F.lit(0.0))
    parts = F.greatest(F.ceil(F.col("rate") / PART_MEAN), F.lit(1)).cast("int")
    mean = F.col("rate") / F.col("parts")
    first = F.exp(-mean)
    start = F.struct(F.array(first).alias("sums"), first.alias("term"), first.alias("sum"))

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * mean / k
        total = acc["sum"] + term
        return F.struct(F.concat(acc["sums"], F.array(total)).alias("sums"),
                        term.alias("term"), total.alias("sum"))

    return (
        weighed.withColumn("one", F.lit(1)).join(F.broadcast(total), "one").drop("one")
        .select("source", "have", rate.alias("rate")).withColumn("parts", parts)
        .withColumn("sums", F.aggregate(
            F.sequence(F.lit(1), F.lit(TERMS - 1)), start, step, lambda acc: acc["sums"]))
    )


def mix(documents: DataFrame, weights: DataFrame | None = None, rows: int | None = None,
        seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """Every document as often as it drew, in global random order.

    ``weights`` (``source, weight``) are the target shares, in any scale; without it all sources
    weigh the same. A source that is not listed has weight 0 and goes; negative weights count as 0. A
    null source is a source like others. ``rows`` is the mean size of the result; by default that
    of the input. Adds ``copy`` (from 1), ``n_copies`` and ``mix_key``, by which the rows of each
    partition are ordered and dealt out; columns of those names are replaced. A null id draws
    by its text instead; rows that repeat an id draw the same number.
    """
    base = documents.drop("copy", "n_copies", "mix_key")
    of, parts, sums = (free_name(base, f"mix_{n}") for n in ("source", "parts", "sums"))
    # Stored, so that its size is known and Spark broadcasts it only if it is small.
    table = materialize(rates(base, weights, rows, source_col)).select(
        F.col("source").alias(of), F.col("parts").alias(parts), F.col("sums").alias(sums))
    key = F.coalesce(F.col(id_col).cast("string"),
                     F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text_col), F.lit("")))))

    def drawn(part: Column) -> Column:
        u = uniform(F.lit(str(seed)), key, part.cast("string"))
        return F.aggregate(
            F.col(sums), F.lit(0), lambda n, s: n + F.when(s <= u, 1).otherwise(0))

    copies = F.aggregate(
        F.sequence(F.lit(1), F.col(parts)), F.lit(0), lambda n, part: n + drawn(part))
    order = F.conv(F.substring(F.md5(F.concat_ws(
        ":", F.lit(f"{seed} order"), key, F.col("copy").cast("string"))), 1, 15), 16, 10)
    return (
        base.join(table, F.col(source_col).eqNullSafe(F.col(of)))
        .withColumn("n_copies", copies).drop(of, parts, sums)
        .where("n_copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
        .withColumn("mix_key", order.cast("bigint"))
        .repartition("mix_key").sortWithinPartitions("mix_key")
    )


def sql(documents: str, seed: int = 17) -> str:
    """The same mix with equal weights as SQL, except for the order of rows."""
    return f"""
WITH RECURSIVE docs AS (SELECT * FROM {documents}),
have AS (SELECT source, count(*) AS have FROM docs GROUP BY source),
rated AS (
  SELECT source,
    (SELECT sum(have) FROM have) * CAST(1.0 AS DOUBLE) / (SELECT count(*) FROM have) / have AS rate
  FROM have),
parted AS (
  SELECT source, rate, greatest(CAST(ceil(rate / {PART_MEAN}) AS INTEGER), 1) AS parts FROM rated),
sums AS (
  SELECT source, parts, rate / parts AS mean, 0 AS k, exp(-(rate / parts)) AS term,
    exp(-(rate / parts)) AS total FROM parted
  UNION ALL
  SELECT source, parts, mean, k + 1, term * mean / (k + 1), total + term * mean / (k + 1)
  FROM sums WHERE k < {TERMS - 1}),
keyed AS (
  SELECT d.*, p.parts,
    coalesce(CAST(doc_id AS VARCHAR), 'text ' || md5(coalesce(text, ''))) AS draw_key
  FROM docs d JOIN parted p ON d.source IS NOT DISTINCT FROM p.source),
drawn AS (
  SELECT doc_id, text, source, draw_key, part,
    (CAST('0x' || substr(md5('{seed}:' || draw_key || ':' || part), 1, 12) AS BIGINT) + 0.5)
      / CAST(281474976710656 AS DOUBLE) AS u
  FROM keyed, unnest(generate_series(1, parts)) AS t(part)),
counted AS (
  SELECT d.doc_id, d.text, d.source, d.draw_key,
    CAST(sum((SELECT count(*) FROM sums s
      WHERE s.source IS NOT DISTINCT FROM d.source AND s.total <= d.u)) AS INTEGER) AS n_copies
  FROM drawn d GROUP BY ALL)
SELECT doc_id, text, source, n_copies, CAST(copy AS INTEGER) AS copy,
  CAST('0x' || substr(md5('{seed} order:' || draw_key || ':' || copy), 1, 15) AS BIGINT) AS mix_key
FROM counted, unnest(generate_series(1, n_copies)) AS t(copy)"""
