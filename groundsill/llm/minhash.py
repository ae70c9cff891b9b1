"""MinHash near-dedup with b-bit signatures.

A document's set holds its distinct word shingles. ``bands * rows`` hash functions give a minimum
each. Rows of minima make band keys, which only bring candidates together; of every minimum just the
lowest bits are kept, packed into a few longs, and equal bits are counted to estimate the similarity
of a candidate pair. Two different minima agree in their low ``b`` bits with chance 2^-b, which the
estimate takes out. A pair whose estimate lies within five standard deviations of the threshold goes
on, and is linked only if its full sets say so.

Hot groups. Documents with the same set are one class and stand for one node, however many they are.
Within a band bucket members are first compared with the bucket's smallest only, its head, so a bucket
of n makes n - 1 candidates. Around heads that some member is then not connected with, members are
compared among each other, but only across components, with the estimate and the full sets as part
of the join condition; so no link between different texts is lost and only links come out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundsill.llm import bloom
from groundsill.llm.components import components
from groundsill.llm.tables import in_small_batches
from groundsill.llm.words import MULTIPLIERS, hash_words, mix, runs_hash, slices
from groundsill.session import materialize, ship_with_tasks

ship_with_tasks(__name__)


@dataclass(frozen=True)
class MinHash:
    """``percent``: least Jaccard similarity of a link, in hundredths. With 40 bands of 5 rows a pair
    at 0.8 is missed with chance 1.2e-7. ``bits`` is b."""

    shingle: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 5
    bits: int = 2

    @property
    def functions(self) -> int:
        return self.bands * self.rows

    @property
    def longs(self) -> int:
        return -(-self.functions // 64)

    @property
    def least_estimate(self) -> float:
        """Five standard deviations below the threshold."""
        chance = 2.0**-self.bits
        share = chance + (1 - chance) * self.percent / 100
        spread = (share * (1 - share) / self.functions) ** 0.5 / (1 - chance)
        return self.percent / 100 - 5 * spread


_SEED = np.random.default_rng(97)
_XOR = _SEED.integers(0, 2**32, 1024, dtype=np.uint32)
_ODD = _SEED.integers(0, 2**31, 1024, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _sets(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows end to end, and where each row's begin."""
    found = hash_words(data, offsets, lower=True)
    count = found.count()
    full = np.maximum(count - length + 1, 0)
    before = np.cumsum(full) - full
    at = np.arange(full.sum()) - np.repeat(before, full) + np.repeat(found.first[:-1], full)
    hashed = mix(runs_hash(found.hashes, length, at))
    pieces, first = [], np.zeros(len(count) + 1, np.int64)
    for r in range(len(count)):
        if full[r]:
            one = np.unique(hashed[before[r] : before[r] + full[r]])
        elif count[r]:
            one = runs_hash(found.hashes, int(count[r]), found.first[r : r + 1])
            one = mix(one + MULTIPLIERS[254:255] * count[r : r + 1].astype(np.uint64))
        else:
            one = hashed[:0]
        pieces.append(one)
        first[r + 1] = first[r] + len(one)
    return np.concatenate(pieces) if pieces else hashed[:0], first


def _minima(values: np.ndarray, first: np.ndarray, functions: int) -> np.ndarray:
    """Minimum of every hash function over every row; all rows must have values."""
    short = (values >> np.uint64(32)).astype(np.uint32)
    rows = len(first) - 1
    out = np.empty((functions, rows), np.uint32)
    row = 0
    while row < rows:  # pieces that stay in the processor's cache
        end = max(int(np.searchsorted(first, first[row] + 32768, "right")) - 1, row + 1)
        piece, starts = short[first[row] : first[end]], first[row:end] - first[row]
        for k in range(functions):
            t = (piece ^ _XOR[k]) * _ODD[k]
            t ^= t >> np.uint32(16)
            t *= np.uint32(0x85EBCA6B)
            out[k, row:end] = np.minimum.reduceat(t, starts)
        row = end
    return out


def _planes(minima: np.ndarray, bits: int, longs: int) -> list[np.ndarray]:
    """Bit i of all minima of a row, packed into longs; one list entry per (bit, long)."""
    functions, rows = minima.shape
    out = []
    for bit in range(bits):
        padded = np.zeros((rows, longs * 64), np.uint8)
        padded[:, :functions] = ((minima >> np.uint32(bit)) & np.uint32(1)).T
        packed = np.packbits(padded, axis=1).view(">i8").astype(np.int64)
        out += [np.ascontiguousarray(packed[:, j]) for j in range(longs)]
    return out


def _texts(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return in_small_batches(documents).select(F.col(id_col).cast("long").alias("doc"),
                                              F.col(text_col).cast("string").alias("text"))


def marks(documents: DataFrame, how: MinHash, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per row: ``doc, n_shingles, k1, k2`` (128-bit hash of the set), signature longs
    ``s0, s1, ...`` and ``bands`` (keys). Rows without words have null keys."""
    names = [f"s{i}" for i in range(how.bits * how.longs)]
    schema = "doc bigint, n_shingles bigint, k1 bigint, k2 bigint, " + ", ".join(
        f"{n} bigint" for n in names) + ", bands array<bigint>"

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch.column("text")):
                values, first = _sets(data, offsets, how.shingle)
                size = np.diff(first)
                some = np.flatnonzero(size)
                where = np.full(len(size), -1)
                where[some] = np.arange(len(some))
                columns = []
                if len(some):
                    starts = np.concatenate([first[some], first[-1:]])
                    low = _minima(values, starts, how.functions)
                    for turn in (1, 2):
                        columns.append(np.add.reduceat(
                            mix(values * MULTIPLIERS[turn]), starts[:-1]).view(np.int64))
                    columns += _planes(low, how.bits, how.longs)
                    keys = np.empty((len(some), how.bands), np.int64)
                    for band in range(how.bands):
                        total = np.full(len(some), band, np.uint64) * MULTIPLIERS[200]
                        for r in range(how.rows):
                            total += low[band * how.rows + r].astype(np.uint64) * MULTIPLIERS[r]
                        keys[:, band] = mix(total).view(np.int64)
                else:
                    columns = [np.zeros(0, np.int64)] * (2 + len(names))
                    keys = np.zeros((0, how.bands), np.int64)
                listed = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(some) + 1) * how.bands, pa.int32()), pa.array(keys.ravel()))
                take = pa.array(where, mask=where < 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(row, end - row), pa.array(size, pa.int64())]
                    + [pa.array(c, pa.int64()).take(take) for c in columns] + [listed.take(take)],
                    ["doc", "n_shingles", "k1", "k2", *names, "bands"])

    return _texts(documents, id_col, text_col).mapInArrow(mark, schema)


def shingle_sets(documents: DataFrame, how: MinHash) -> DataFrame:
    """``doc, shingles`` from rows of ``doc, text``: the full set, hashed to 64 bits each."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch.column("text"), 1 << 20):
                values, first = _sets(data, offsets, how.shingle)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(row, end - row),
                     pa.ListArray.from_arrays(pa.array(first, pa.int32()),
                                              pa.array(values.view(np.int64)))],
                    ["doc", "shingles"])

    return documents.mapInArrow(collect, "doc bigint, shingles array<bigint>")


def estimate(how: MinHash, left: str, right: str) -> Column:
    """Similarity from bit counts, corrected for low bits that agree by chance."""
    differing = F.lit(0)
    for j in range(how.longs):
        unequal = F.lit(0).cast("bigint")
        for bit in range(how.bits):
            name = f"s{bit * how.longs + j}"
            unequal = unequal.bitwiseOR(
                F.col(f"{left}.{name}").bitwiseXOR(F.col(f"{right}.{name}")))
        differing = differing + F.bit_count(unequal)
    chance = 2.0**-how.bits
    return ((F.lit(1.0) - differing / how.functions) - chance) / (1 - chance)


def _sets_of(nodes: DataFrame, texts: DataFrame, how: MinHash) -> DataFrame:
    """Full sets of (at least) the documents in ``nodes``, made where their texts are read."""
    built = bloom.build(nodes, F.xxhash64("node"))
    return shingle_sets(bloom.maybe_in(texts, F.xxhash64("doc"), built), how).withColumnRenamed(
        "doc", "node")


def _similar(left: Column, right: Column, how: MinHash) -> Column:
    shared = F.size(F.array_intersect(left, right))
    return shared * 100 >= (F.size(left) + F.size(right) - shared) * how.percent


def _verified(pairs: DataFrame, texts: DataFrame, how: MinHash) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough."""
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")), texts, how)
    of_a, of_b = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
    return pairs.join(of_b, "b").join(of_a, "a").where(
        _similar(F.col("set_a"), F.col("set_b"), how)).select("a", "b")


def _across(pairs: DataFrame, found: DataFrame, signatures: DataFrame, texts: DataFrame,
            how: MinHash) -> DataFrame:
    """Links between components that comparing with heads alone did not show.

    Members of a bucket all have its head in common. Around each head that a member is not connected
    with, members of different components are compared, at the smallest head they share only;
    the full sets are part of the join condition, so that nothing but links comes out.
    """
    component = found.select("node", "component")
    sides = [pairs.select("a", "b")]
    for node, name in (("a", "of_a"), ("b", "of_b")):
        named = component.select(F.col("node").alias(node), F.col("component").alias(name))
        sides.append(sides[-1].join(named, node, "left").withColumn(name, F.coalesce(name, node)))
    heads = sides[-1].where("of_a <> of_b").select(F.col("a").alias("head")).distinct()
    stars = materialize(pairs.select(
        F.col("a").alias("head"), F.explode(F.array("a", "b")).alias("node")
    ).join(heads, "head", "left_semi").distinct())
    facts = (
        stars.groupBy("node").agg(F.collect_set("head").alias("heads"))
        .join(component, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .join(signatures.withColumnRenamed("doc", "node"), "node")
        .join(_sets_of(stars.select("node"), texts, how), "node")
    )
    rows = materialize(stars.join(facts, "node"))
    x, y = rows.alias("x"), rows.alias("y")
    return x.join(
        y,
        (F.col("x.head") == F.col("y.head")) & (F.col("x.node") < F.col("y.node"))
        & (F.col("x.component") != F.col("y.component"))
        & (estimate(how, "x", "y") >= how.least_estimate)
        & (F.array_min(F.array_intersect("x.heads", "y.heads")) == F.col("x.head"))
        & _similar(F.col("x.shingles"), F.col("y.shingles"), how),
    ).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def near_duplicates(documents: DataFrame, how: MinHash = MinHash(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Texts null or without words have no shingles and are linked with nothing. A null id can be
    neither a component nor linked: its row has a null component and is kept. Rows that
    repeat an id are one document with several texts. Other columns are not looked at.
    """
    texts = _texts(documents, id_col, text_col)
    marked = materialize(marks(documents, how, id_col, text_col))
    named = marked.where("n_shingles > 0 and doc is not null")
    carried = [c for c in marked.columns if c.startswith("s")] + ["bands"]
    members = materialize(named.groupBy("k1", "k2").agg(
        F.min("doc").alias("doc"), *[F.first(c).alias(c) for c in carried]))
    banded = members.select("doc", F.explode("bands").alias("key"))
    heads = materialize(banded.groupBy("key").agg(
        F.min("doc").alias("head"), F.max("doc").alias("last")).where("head < last").drop("last"))
    signatures = members.select("doc", *carried[:-1])
    to_head = banded.join(heads, "key").where("doc > head").select(
        F.col("head").alias("a"), F.col("doc").alias("b")).distinct().alias("p")
    pairs = materialize(
        to_head.join(signatures.alias("x"), F.col("p.a") == F.col("x.doc"))
        .join(signatures.alias("y"), F.col("p.b") == F.col("y.doc"))
        .select("p.a", "p.b", (estimate(how, "x", "y") >= how.least_estimate).alias("likely")))
    links = materialize(_verified(pairs.where("likely").select("a", "b"), texts, how))
    found = materialize(components(links))
    more = materialize(_across(pairs, found, signatures, texts, how))
    if not more.isEmpty():
        stars = found.where("component < node").select(
            F.col("component").alias("a"), F.col("node").alias("b"))
        found = materialize(components(stars.unionByName(more)))

    return (
        marked.select("doc", "n_shingles", "k1", "k2")
        .where("n_shingles > 0 and doc is not null")
        .join(members.select("k1", "k2", F.col("doc").alias("class_id")), ["k1", "k2"])
        .join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select("doc", "n_shingles",
                F.coalesce("component", "class_id").alias("component_id"))
        .unionByName(marked.where("n_shingles = 0 or doc is null").select(
            "doc", "n_shingles", F.col("doc").alias("component_id")))
        .select(F.col("doc").alias("doc_id"), "n_shingles", "component_id",
                F.coalesce(F.col("doc") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


def sql(how: MinHash) -> str:
    """The same result by comparing all documents of ``documents`` that share a shingle, as SQL."""
    n = how.shingle
    return f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {n} THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - {n - 2}),
      lambda i: array_to_string(ws[i:i + {n - 1}], ' '))) END AS said FROM split),
shingled AS (SELECT doc_id, len(said) AS size, unnest(said) AS shingle FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.size + b.size AS both_sizes, count(*) AS common
  FROM shingled a JOIN shingled b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared WHERE 100 * common >= {how.percent} * (both_sizes - common)),
either AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
  SELECT x, y FROM either UNION SELECT r.x, e.y FROM reached r JOIN either e ON r.y = e.x),
least AS (SELECT x, min(y) AS low FROM reached GROUP BY x)
SELECT doc_id, CAST(len(said) AS BIGINT) AS n_shingles,
  least(doc_id, coalesce(low, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(low, doc_id)) AS kept
FROM sets LEFT JOIN least ON doc_id = x"""
