"""Approximate nearest neighbours: a forest of random-projection trees, searched best first.

Every tree splits space by random hyperplanes at the median of a bounded sample. A vector lies
in one leaf of each tree. A query walks all trees through one shared priority queue: the next branch
opened is the one, of whatever tree, that the query is least on the wrong side of. Leaves are taken
until their shares of the sample add up to ``visit``; everything in them is scored exactly.

Inner products become angles by the usual extra component: vectors are scaled by the largest norm and
get the component that makes them unit length, queries get 0 there.

Leaves are cut into units of bounded size, and units dealt out to groups of bounded size. A task
holds one group's vectors and streams queries past them, so neither a crowded leaf nor a long list of
queries has to fit into memory. What is sent to all tasks is the forest, whose size the sample sets.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from groundsill.session import materialize, ship_with_tasks

ship_with_tasks(__name__)

UNIT_VECTORS = 1 << 14
GROUP_VECTORS = 48_000


@dataclass(frozen=True)
class Search:
    """``sample`` bounds what the forest is fitted on; ``visit`` is how much of the table a query
    looks at, adding up the shares of all trees, which overlap. Vectors without any structure need
    1.2 and more to find nine in ten of the nearest; clustered ones need far less."""

    k: int = 20
    trees: int = 12
    depth: int = 8
    sample: int = 1 << 14
    leaf: int = 8
    visit: float = 1.6
    seed: int = 11


@dataclass
class Forest:
    """Heap-ordered planes: node i of a tree has children 2i + 1 and 2i + 2."""

    depth: int
    largest: float
    normals: np.ndarray
    middles: np.ndarray

    @property
    def leaves(self) -> int:
        return 1 << self.depth


def usable(vector: Column, dimension: int | None = None) -> Column:
    """Not null, of the right length, all components finite, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)
    if dimension is not None:
        good = good & (F.size(vector) == dimension)
    return F.coalesce(good, F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _lifted(vectors: np.ndarray, largest: float) -> np.ndarray:
    scaled = vectors.astype(np.float64) / largest
    extra = np.sqrt(np.maximum(1 - (scaled * scaled).sum(1), 0))
    return np.concatenate([scaled, extra[:, None]], 1)


def fit(sample: np.ndarray, largest: float, how: Search) -> Forest:
    points = _lifted(sample, largest)
    depth = max(0, min(how.depth, int(np.log2(max(1, len(points) // how.leaf)))))
    if len(points) < 16 * how.k:  # too few to leave any out
        depth = 0
    chance = np.random.default_rng(how.seed)
    nodes = (1 << depth) - 1
    normals = chance.normal(size=(how.trees, nodes, points.shape[1]))
    normals /= np.linalg.norm(normals, axis=2, keepdims=True)
    middles = np.zeros((how.trees, nodes))
    for tree in range(how.trees):
        at = np.zeros(len(points), np.int64)
        for node in range(nodes):
            here = np.flatnonzero(at == node)
            side = points[here] @ normals[tree, node]
            middles[tree, node] = np.median(side) if len(side) else 0.0
            at[here] = 2 * node + 1 + (side >= middles[tree, node])
    return Forest(depth, largest, normals, middles)


def leaves_of(forest: Forest, vectors: np.ndarray) -> np.ndarray:
    """Leaf number of every vector in every tree."""
    points = _lifted(vectors, forest.largest)
    out = np.empty((len(points), len(forest.normals)), np.int32)
    for tree in range(len(forest.normals)):
        at = np.zeros(len(points), np.int64)
        for _ in range(forest.depth):
            side = np.einsum("nd,nd->n", points, forest.normals[tree, at])
            at = 2 * at + 1 + (side >= forest.middles[tree, at])
        out[:, tree] = at - (forest.leaves - 1)
    return out


def visited(forest: Forest, queries: np.ndarray, visit: float) -> list[list[int]]:
    """Leaves (tree * leaves + leaf) that each query looks at, nearest branch first."""
    trees, nodes, width = forest.normals.shape
    if not nodes:
        return [list(range(trees)) for _ in queries]
    points = np.zeros((len(queries), width))
    points[:, :-1] = queries
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    margins = points @ forest.normals.reshape(-1, width).T - forest.middles.reshape(-1)
    most = min(trees * forest.leaves, int(np.ceil(visit * forest.leaves)))
    out = []
    for row in margins.tolist():
        queue = [(0.0, tree, 0) for tree in range(trees)]
        found: list[int] = []
        while queue and len(found) < most:
            wrong, tree, node = heapq.heappop(queue)
            while node < nodes:  # down the side the query is on; the other side waits its turn
                margin = row[tree * nodes + node]
                near = 2 * node + 1 + (margin >= 0)
                far = 4 * node + 3 - near
                heapq.heappush(queue, (max(wrong, abs(margin)), tree, far))
                node = near
            found.append(tree * forest.leaves + node - nodes)
        out.append(found)
    return out


def _pack(ids: np.ndarray, units: np.ndarray, vectors: np.ndarray) -> bytes:
    head = np.array([len(ids), len(units), vectors.shape[1]], "<i8").tobytes()
    return head + ids.astype("<i8").tobytes() + units.astype("<i4").tobytes() + vectors.astype(
        "<f4" if vectors.dtype == np.float32 else "<f8").tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, m, width = np.frombuffer(data, "<i8", 3).tolist()
    ids = np.frombuffer(data, "<i8", n, 24)
    units = np.frombuffer(data, "<i4", m, 24 + 8 * n)
    rest = len(data) - 24 - 8 * n - 4 * m
    kind = "<f4" if rest == 4 * n * width else "<f8"
    return ids, units, np.frombuffer(data, kind, n * width, 24 + 8 * n + 4 * m).reshape(n, width)


class _Group:
    """The vectors of one group, by unit."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int):
        self.k = k
        units = np.concatenate([p[1] for p in parts])
        order = np.argsort(units, kind="stable")
        self.ids = np.concatenate([p[0] for p in parts])[order]
        self.vectors = np.concatenate([p[2] for p in parts])[order].astype(np.float64)
        names, first = np.unique(units[order], return_index=True)
        self.span = dict(zip(names.tolist(), zip(first, [*first[1:], len(order)], strict=True),
                             strict=True))

    def nearest(self, ids: np.ndarray, pairs: np.ndarray, queries: np.ndarray) -> tuple[list, list, list]:
        """Of the units that each query looks at here: its k best rows as query, id, score."""
        queries = queries.astype(np.float64)
        asked, units = pairs.reshape(-1, 2).T
        kept: dict[int, list[np.ndarray]] = {}
        for unit in np.unique(units).tolist():
            if unit not in self.span:
                continue
            a, b = self.span[unit]
            who = asked[units == unit]
            scores = queries[who] @ self.vectors[a:b].T
            scores[ids[who][:, None] == self.ids[None, a:b]] = -np.inf
            if b - a > self.k:
                cut = np.partition(scores, b - a - self.k, axis=1)[:, b - a - self.k]
                # Products summed in another order may differ in their last bits.
                cut = cut - 1e-9 * np.maximum(np.abs(cut), 1e-300)
            else:
                cut = np.full(len(who), -np.finfo(float).max)
            rows, columns = np.nonzero(scores >= cut[:, None])
            for r, part in zip(who[np.unique(rows)], np.split(
                    columns, np.flatnonzero(np.diff(rows)) + 1), strict=True) if len(rows) else ():
                kept.setdefault(int(r), []).append(part + a)
        out: tuple[list, list, list] = ([], [], [])
        for r, parts in kept.items():
            rows = np.concatenate(parts)
            _, first = np.unique(self.ids[rows], return_index=True)
            rows = rows[first]
            exact = (self.vectors[rows] * queries[r]).sum(axis=1)
            best = np.lexsort((self.ids[rows], -exact))[: self.k]
            out[0].append(np.full(len(best), ids[r]))
            out[1].append(self.ids[rows[best]])
            out[2].append(exact[best])
        return out


def search(vectors: DataFrame, queries: DataFrame, how: Search = Search(), id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its ``k`` nearest found by inner product in
    double precision, nearest first, equal scores by smaller id; never the query's own id.

    Rows whose id is null or whose vector is null, zero, of another length than most, or holds a
    null or non-finite component take no part, on either side. Rows that repeat id and vector
    count once. Of vectors that are equal only the ``k + 1`` smallest ids are indexed: further ones
    can be in no result.
    """
    spark = vectors.sparkSession

    def plain(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(
            F.col("id").isNotNull() & usable(F.col("v")))

    sizes = plain(vectors).groupBy(F.size("v").alias("d")).agg(
        F.count("*").alias("n"),
        F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("norm"))
    common = sizes.orderBy(F.desc("n"), "d").first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if common is None:
        return empty
    same = Window.partitionBy("v").orderBy("id")
    indexed = plain(vectors).where(F.size("v") == common.d).withColumn(
        "copy", F.dense_rank().over(same)).where(F.col("copy") <= how.k + 1).select("id", "v").distinct()
    chosen = indexed.select("v", F.xxhash64(F.lit(how.seed), "id", "v").alias("o")).orderBy(
        "o").limit(how.sample).select("v").toArrow()
    forest = fit(_matrix(chosen.column("v")), float(np.sqrt(common.norm)), how)
    trees = how.trees

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = leaves_of(forest, _matrix(batch.column("v"))) if len(batch) else np.zeros((0, trees), np.int32)
            code = leaf + np.arange(trees, dtype=np.int32) * forest.leaves
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.FixedSizeListArray.from_arrays(
                    pa.array(code.ravel(), pa.int32()), trees).cast(pa.list_(pa.int32()))],
                ["id", "v", "codes"])

    kind = dict(indexed.dtypes)["v"]
    placed = materialize(indexed.mapInArrow(place, f"id bigint, v {kind}, codes array<int>"))
    counts = np.zeros(trees * forest.leaves, np.int64)
    for row in placed.select(F.explode("codes").alias("c")).groupBy("c").count().toLocalIterator():
        counts[row.c] = row["count"]
    parts = np.maximum(-(-counts // UNIT_VECTORS), 1)
    first = np.cumsum(parts) - parts
    # Each group gives up to k rows per query, so there are no more of them than memory asks for.
    groups = max(1, int(-(-counts.sum() // GROUP_VECTORS)))

    def dealt(kind_no: int, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([g for g, _ in rows], pa.int64()), pa.array([kind_no] * len(rows), pa.int32()),
             pa.array([d for _, d in rows], pa.binary())], ["part", "kind", "data"])

    def vector_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            ids = batch.column("id").to_numpy()
            values = _matrix(batch.column("v"))
            codes = batch.column("codes").flatten().to_numpy().reshape(len(ids), trees)
            # A leaf's units are dealt by id, so that a retried task deals as before.
            unit = first[codes] + (ids[:, None] * 0x9E3779B1 >> 7) % parts[codes]
            group = unit % groups
            rows = []
            for g in np.unique(group).tolist():
                r, t = np.nonzero(group == g)
                rows.append((g, _pack(ids[r], unit[r, t], values[r])))
            yield dealt(0, rows)

    def query_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                some = batch.slice(at, 512)
                ids, values = some.column("id").to_numpy(), _matrix(some.column("v"))
                pairs: dict[int, list[tuple[int, int]]] = {}
                for q, found in enumerate(visited(forest, values, how.visit)):
                    for code in found:
                        for unit in range(int(first[code]), int(first[code] + parts[code])):
                            pairs.setdefault(unit % groups, []).append((q, unit))
                rows = []
                for g, listed in pairs.items():
                    grid = np.array(listed, np.int64)
                    own, grid[:, 0] = np.unique(grid[:, 0], return_inverse=True)
                    rows.append((g, _pack(ids[own], grid.ravel(), values[own])))
                yield dealt(1, rows)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts_here, group = None, [], None
        for batch in batches:
            for g, what, data in zip(batch.column("part").to_pylist(), batch.column("kind").to_pylist(),
                                     batch.column("data"), strict=True):
                if g != now:
                    now, parts_here, group = g, [], None
                if what == 0:
                    parts_here.append(_unpack(data.as_py()))
                    continue
                if group is None:
                    if not parts_here:
                        continue
                    group, parts_here = _Group(parts_here, how.k), [None]
                found = group.nearest(*_unpack(data.as_py()))
                if found[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c)) for c in found], ["query_id", "vec_id", "score"])

    shape = "part bigint, kind int, data binary"
    asked = plain(queries).where(F.size("v") == common.d).distinct()
    met = (
        placed.mapInArrow(vector_rows, shape)
        .unionByName(asked.mapInArrow(query_rows, shape))
        .repartition(groups, "part").sortWithinPartitions("part", "kind")
        .mapInArrow(meet, "query_id bigint, vec_id bigint, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.distinct().withColumn("rank", F.row_number().over(best).cast("int")).where(
        F.col("rank") <= how.k).select("query_id", "rank", "vec_id", "score")
