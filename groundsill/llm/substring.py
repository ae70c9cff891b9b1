"""Substring dedup over prefix-partitioned suffix trees.

Every word position of every document starts a suffix. Two suffixes that agree on at least
``window`` words meet below one internal node of that depth in the suffix tree of the whole corpus.
All leaves below such a node but the earliest are repeats, and their first ``window`` words go.

The tree is never built as a whole. Suffixes are split by variable-length word prefixes: one word
where few suffixes share it, more words where many do, so that a group of prefixes fits a task's
memory. Each task builds the subtrees of its prefixes, as sorted leaves, and reads off the internal
nodes at the depth asked for; which node a leaf hangs under at that depth is told by a 64-bit hash of
its first ``window`` words.

Before anything is shuffled, a task keeps one leaf (the earliest) per node of its own rows and
settles the others itself, so a passage that a third of all documents share moves once per slice of
input, not once per copy. Leaves move as packed columns, one row per slice and group.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundsill.llm import bloom
from groundsill.llm.tables import free_name, in_small_batches
from groundsill.llm.words import Words, hash_words, mix, runs_hash, slices, together
from groundsill.session import materialize, ship_with_tasks

ship_with_tasks(__name__)

# A leaf: node, document, which of several texts under the document's id, first word.
LEAF = ["<u8", "<i8", "<i8", "<i4"]
PLACE = LEAF[1:]
KEY_BITS = 20
BLOCK_BYTES = 1 << 20
_LADDER = (1, 2, 4, 8, 16)


def pack(columns: list[np.ndarray]) -> bytes:
    """Columns as byte planes: bytes that hardly vary lie together and compress well."""
    n = len(columns[0])
    return b"".join(
        np.ascontiguousarray(c.view(np.uint8).reshape(n, -1).T).tobytes() for c in columns
    )


def unpack(data: bytes, kinds: list[str]) -> list[np.ndarray]:
    widths = [np.dtype(k).itemsize for k in kinds]
    n = len(data) // sum(widths)
    out, at = [], 0
    for kind, width in zip(kinds, widths, strict=True):
        planes = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * width
    return out


def depths(window: int) -> list[int]:
    """Prefix lengths that are tried, shortest first; the last is the whole window."""
    return [d for d in _LADDER if d < window] + [window]


def _key(prefix_hash: np.ndarray) -> np.ndarray:
    return (mix(prefix_hash) >> np.uint64(64 - KEY_BITS)).astype(np.int64)


class _Block:
    """All suffixes of some rows that are at least ``window`` words long."""

    def __init__(self, docs: np.ndarray, copies: np.ndarray, found: Words, window: int):
        self.hashes = found.hashes
        count = np.maximum(found.count() - window + 1, 0)
        self.doc = np.repeat(docs, count)
        self.copy = np.repeat(copies, count)
        before = np.cumsum(count) - count
        self.start = np.arange(count.sum()) - np.repeat(before, count)
        self.at = self.start + np.repeat(found.first[:-1], count)

    def prefix(self, depth: int, which: np.ndarray) -> np.ndarray:
        return runs_hash(self.hashes, depth, self.at[which])


def _blocks(batch: pa.RecordBatch, window: int) -> Iterator[_Block]:
    """The rows in as few blocks of about ``BLOCK_BYTES`` as it takes, equally large give or take a row,
    each in id order."""
    sizes = pa.compute.binary_length(batch.column("text").cast(pa.binary())).fill_null(0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    total = int(ends[-1]) if len(batch) else 0
    n = max(-(-total // BLOCK_BYTES), 1)
    cuts = np.searchsorted(ends, total * np.arange(1, n) / n) + 1
    edges = np.unique(np.concatenate([[0], cuts, [len(batch)]])).tolist()
    for row, end in itertools.pairwise(edges):
        part = batch.slice(row, end - row)
        part = part.filter(part.column("doc").is_valid())
        part = part.take(pa.compute.sort_indices(
            part, sort_keys=[("doc", "ascending"), ("copy", "ascending")]))
        hashed = [hash_words(data, offsets, lower=False)
                  for _, _, data, offsets in slices(part.column("text"))]
        if hashed:
            yield _Block(part.column("doc").to_numpy(), part.column("copy").to_numpy(),
                         together(hashed), window)


def _several(documents: DataFrame, id_col: str, text_col: str) -> DataFrame | None:
    """The ids that stand for more than one text, or None if there are none, as it should be."""
    said = F.xxhash64(F.col(text_col).cast("string"))
    found = materialize(
        documents.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_several"))
        .agg(F.min(said).alias("low"), F.max(said).alias("high")).where("low <> high").select("_several"))
    return None if found.isEmpty() else found


def _told_apart(documents: DataFrame, several: DataFrame | None, id_col: str, text_col: str,
                copy: str) -> DataFrame:
    """``documents`` with a column ``copy``: a hash of the text where the id stands for several, else 0."""
    if several is None:
        return documents.withColumn(copy, F.lit(0).cast("bigint"))
    own = F.col(id_col).cast("long")
    key, built = F.when(own.isNotNull(), F.xxhash64(own)), bloom.build(several, F.xxhash64("_several"))
    met = bloom.maybe_in(documents, key, built).join(several, own == F.col("_several"), "left")
    return met.withColumn(copy, F.when(
        F.col("_several").isNotNull(), F.xxhash64(F.col(text_col).cast("string"))).otherwise(F.lit(0))
    ).drop("_several").unionByName(
        bloom.not_in(documents, key, built).withColumn(copy, F.lit(0).cast("bigint")))


def _texts(documents: DataFrame, several: DataFrame | None, id_col: str, text_col: str) -> DataFrame:
    return _told_apart(in_small_batches(documents).select(
        F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")),
        several, "doc", "text", "copy")


def heavy_prefixes(texts: DataFrame, window: int, group_suffixes: int, resolution: int) -> tuple[int, list[np.ndarray]]:
    """How many groups the suffixes need, and which prefixes are too frequent for one group.

    A prefix that starts more than a share s of all suffixes also starts more than s/2 of them in
    blocks holding at least half of its suffixes; so each block reports only those above half the
    finest share, and nothing that matters is missed. The answer is one bit per prefix key
    and depth: its size does not depend on the corpus.
    """
    ladder = depths(window)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_depth, out_key, out_n = [0], [0], [0]
            for block in _blocks(batch, window):
                total = len(block.at)
                out_n[0] += total
                which = np.arange(total)
                for depth in ladder[:-1]:
                    if not len(which):
                        break
                    keys = _key(block.prefix(depth, which))
                    sizes = np.bincount(keys, minlength=1 << KEY_BITS)
                    often = sizes >= max(2.0, total / (2 * resolution))
                    found = np.flatnonzero(often)
                    out_depth += [depth] * len(found)
                    out_key += found.tolist()
                    out_n += sizes[found].tolist()
                    which = which[often[keys]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_depth, pa.int32()), pa.array(out_key, pa.int64()),
                 pa.array(out_n, pa.int64())], ["depth", "key", "n"])

    counted = texts.mapInArrow(
        count, "depth int, key bigint, n bigint").groupBy("depth", "key").agg(F.sum("n").alias("n"))
    total = 0
    rows = []
    for row in counted.where(f"depth = 0 or n > {group_suffixes // 2}").toLocalIterator():
        if row.depth == 0:
            total = row.n
        else:
            rows.append((row.depth, row.key))
    heavy = [np.zeros(1 << KEY_BITS, bool) for _ in ladder]
    for depth, key in rows:
        heavy[ladder.index(depth)][key] = True
    return max(1, -(-total // group_suffixes)), heavy


def _runs(starts: np.ndarray) -> bytes:
    """Sorted starts as [first, end) pairs of consecutive numbers."""
    starts = np.unique(starts)
    cut = np.flatnonzero(np.diff(starts) != 1)
    first = starts[np.concatenate([[0], cut + 1])]
    last = starts[np.concatenate([cut, [len(starts) - 1]])]
    return np.stack([first, last + 1], 1).astype("<i4").tobytes()


def repeats(documents: DataFrame, window: int = 20, id_col: str = "doc_id",
            text_col: str = "text", group_suffixes: int = 1 << 19,
            resolution: int = 4096, several: DataFrame | None = None) -> DataFrame:
    """Per document with repeats: ``doc``, ``copy`` and ``runs``, the starts of all windows of
    ``window`` words that also start earlier (smaller id, or same document and earlier start), as
    packed int32 pairs [first start, end start). Rows with a null id are left out.

    Rows that share id and text are one document. ``several`` lists the ids (``_several``) that stand
    for different texts: those are documents of their own, told apart and ordered among each
    other by ``copy``, a hash of the text; it is 0 for all others, and so are its bytes in a leaf."""
    if window < 1:
        raise ValueError("window must be at least 1")
    texts = _texts(documents, several, id_col, text_col)
    groups, heavy = heavy_prefixes(texts, window, group_suffixes, resolution)
    ladder = depths(window)
    buckets = max(groups, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def by_bucket(doc: np.ndarray, copy: np.ndarray, start: np.ndarray) -> Iterator[tuple[int, bytes]]:
        if not len(doc):
            return
        bucket = (mix(doc.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edge = np.flatnonzero(np.diff(bucket[order])) + 1
        for part in np.split(order, edge):
            yield int(bucket[part[0]]), pack([doc[part], copy[part], start[part].astype("<i4")])

    def repeated(node: np.ndarray, doc: np.ndarray, copy: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Of leaves in order, those that are not their node's first, nor that same one again."""
        head = np.ones(len(node), bool)
        head[1:] = node[1:] != node[:-1]
        first = np.maximum.accumulate(np.where(head, np.arange(len(node)), 0))
        return (doc != doc[first]) | (copy != copy[first]) | (start != start[first])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch, window):
                if not len(block.at):
                    continue
                node = mix(block.prefix(window, slice(None)))
                order = np.argsort(node, kind="stable")
                ordered = node[order]
                first = np.ones(len(order), bool)
                first[1:] = ordered[1:] != ordered[:-1]
                later = np.sort(order[repeated(
                    ordered, block.doc[order], block.copy[order], block.start[order])])
                keep = np.sort(order[first])
                chosen = np.zeros(len(keep), np.uint64)
                open_ = np.arange(len(keep))
                for k, depth in enumerate(ladder):
                    keys = _key(block.prefix(depth, keep[open_]))
                    chosen[open_] = (keys * len(ladder) + k).astype(np.uint64)
                    if depth == window:
                        chosen[open_] = node[keep[open_]]
                    open_ = open_[heavy[k][keys]]
                    if not len(open_):
                        break
                group = (mix(chosen) % np.uint64(groups)).astype(np.int64)
                by_group = np.lexsort((node[keep], group))
                edge = np.flatnonzero(np.diff(group[by_group])) + 1
                rows = [
                    (int(group[part[0]]), False,
                     pack([node[keep[part]], block.doc[keep[part]], block.copy[keep[part]],
                           block.start[keep[part]].astype("<i4")]))
                    for part in np.split(by_group, edge)
                ]
                rows += [(b % groups, True, data)
                         for b, data in by_bucket(
                             block.doc[later], block.copy[later], block.start[later])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.bool_()),
                     pa.array([r[2] for r in rows], pa.binary())], ["part", "settled", "data"])

    def nodes(table: pa.Table) -> pa.Table:
        settled = table.column("settled").to_pylist()
        data = table.column("data").to_pylist()
        parts = [unpack(d, LEAF)
                 for d, s in zip(data, settled, strict=True) if not s]
        out: list[tuple[int, bytes]] = []
        done = [unpack(d, PLACE) for d, s in zip(data, settled, strict=True) if s]
        if done:
            out += by_bucket(*(np.concatenate(c) for c in zip(*done, strict=True)))
        if parts:
            node, doc, copy, start = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.argsort(node, kind="stable")
            ordered = node[order]
            same = ordered[1:] == ordered[:-1]
            shared = np.zeros(len(order), bool)
            shared[1:] |= same
            shared[:-1] |= same
            order = order[shared]
            order = order[np.lexsort((start[order], copy[order], doc[order], node[order]))]
            later = order[repeated(node[order], doc[order], copy[order], start[order])]
            out += by_bucket(doc[later], copy[later], start[later])
        return pa.table({"bucket": pa.array([b for b, _ in out], pa.int64()),
                         "data": pa.array([d for _, d in out], pa.binary())})

    def per_document(table: pa.Table) -> pa.Table:
        parts = [unpack(d, PLACE) for d in table.column("data").to_pylist()]
        doc, copy, start = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((start, copy, doc))
        doc, copy, start = doc[order], copy[order], start[order]
        edge = np.flatnonzero((np.diff(doc) != 0) | (np.diff(copy) != 0)) + 1
        head = np.concatenate([[0], edge])
        return pa.table({"doc": pa.array(doc[head], pa.int64()),
                         "copy": pa.array(copy[head], pa.int64()),
                         "runs": pa.array([_runs(s) for s in np.split(start, edge)], pa.binary())})

    return (
        texts
        .mapInArrow(leaves, "part bigint, settled boolean, data binary")
        .groupBy("part").applyInArrow(nodes, "bucket bigint, data binary")
        .groupBy("bucket").applyInArrow(per_document, "doc bigint, copy bigint, runs binary")
    )


def _cut(text: str | None, runs: bytes | None, window: int) -> tuple[int, int, bytes, list, bool]:
    """Words, removed words, kept words joined by a space, removed spans, whether any went."""
    found = text.encode().split() if text else []
    if runs is None:
        return len(found), 0, b" ".join(found), [], False
    kept, spans, at = [], [], 0
    for first, end in np.frombuffer(runs, "<i4").reshape(-1, 2).tolist():
        end += window - 1
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(end, spans[-1][1])
        else:
            spans.append([first, end])
    for first, end in spans:
        kept += found[at:first]
        at = end
    kept += found[at:]
    return len(found), len(found) - len(kept), b" ".join(kept), spans, True


def remove_repeats(documents: DataFrame, window: int = 20, id_col: str = "doc_id",
                   text_col: str = "text", with_text: bool = True, **settings) -> DataFrame:
    """``documents`` with every word removed that a repeated window covers.

    Adds ``n_words``, ``n_removed``, ``removed_spans`` (word ranges [from, to) of maximal repeats)
    and ``kept_sha256`` (of the kept words joined by one space). With ``with_text`` the text
    column is replaced: an untouched text stays as it is, another is its kept words joined
    by one space; without it the text column is dropped.

    A null text has no words and stays null. A null id cannot be ordered: such rows are returned
    untouched. Rows that repeat an id and its text are one document and cut alike; different texts under one
    id are different documents, in the order of a hash of their texts. Columns whose names clash with the added ones are replaced.
    """
    added = ["n_words", "n_removed", "removed_spans", "kept_sha256"]
    several = _several(documents, id_col, text_col)
    found = repeats(documents, window, id_col, text_col, several=several, **settings)
    base = documents.drop(*added)
    carried = [c for c in base.columns if c != text_col]
    kept_columns = base.columns if with_text else carried
    types = dict((f.name, f.dataType.simpleString()) for f in base.schema.fields)
    runs, doc, copy, own = (free_name(base, n) for n in ("runs", "doc", "copy", "own_copy"))
    base = _told_apart(base, several, id_col, text_col, own)
    found = found.select(F.col("doc").alias(doc), F.col("copy").alias(copy), F.col("runs").alias(runs))
    # Only texts that may have repeats are shuffled to meet them; the others, and null ids, are cut
    # where they were read.
    found = materialize(found)
    key = F.xxhash64(F.col(id_col).cast("long"))
    key = F.when(F.col(id_col).isNotNull(), key)
    built = bloom.build(found, F.xxhash64(doc))
    joined = bloom.maybe_in(base, key, built).join(
        found.hint("shuffle_hash"),
        (F.col(id_col).cast("long") == F.col(doc)) & (F.col(own) == F.col(copy)), "left"
    ).drop(doc, copy).unionByName(
        bloom.not_in(base, key, built).withColumn(runs, F.lit(None).cast("binary")))
    schema = ", ".join(
        [f"`{c}` {'string' if c == text_col else types[c]}" for c in kept_columns]
        + ["n_words bigint", "n_removed bigint", "removed_spans array<array<int>>",
           "kept_sha256 string"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col)
            results, new_texts = [], []
            for text, run in zip(texts, batch.column(runs), strict=True):
                text = text.as_py()
                n, gone, kept, spans, touched = _cut(text, run.as_py(), window)
                results.append((n, gone, spans, hashlib.sha256(kept).hexdigest()))
                if with_text:
                    new_texts.append(kept.decode() if touched else text)
            columns = [
                pa.array(new_texts, pa.string()) if c == text_col else batch.column(c)
                for c in kept_columns
            ]
            columns += [
                pa.array([r[0] for r in results], pa.int64()),
                pa.array([r[1] for r in results], pa.int64()),
                pa.array([r[2] for r in results], pa.list_(pa.list_(pa.int32()))),
                pa.array([r[3] for r in results], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, kept_columns + added)

    return joined.mapInArrow(cut, schema)


def sql(window: int = 20) -> str:
    """Words, removed words and digest per row of ``documents`` as SQL, for unique ids."""
    return f"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, s, md5(array_to_string(ws[s:s + {window - 1}], ' ')) AS said
  FROM docs, unnest(range(1, len(ws) - {window - 2})) AS t(s)),
repeated AS (
  SELECT doc_id, s FROM windows
  QUALIFY row_number() OVER (PARTITION BY said ORDER BY doc_id, s) > 1),
placed AS (SELECT doc_id, i, ws[i] AS w FROM docs, unnest(range(1, len(ws) + 1)) AS t(i)),
covered AS (
  SELECT p.*, coalesce(i - s < {window}, FALSE) AS gone
  FROM placed p ASOF LEFT JOIN repeated r ON p.doc_id = r.doc_id AND p.i >= r.s),
counted AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
    string_agg(w, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM covered GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN counted USING (doc_id)"""
