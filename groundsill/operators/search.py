"""Exact top-k cosine search of a table of queries against a table of vectors, pruned by bounds.

Vectors are dealt to cells around pivots, and a cell remembers how near and how far from its pivot they
lie. Angles between unit vectors are a metric, so the angle from a query to a cell's pivot bounds the score
of everything in the cell. A query first visits the cells nearest to it that hold k vectors; their k-th
score is a floor. Then it visits those of the other cells whose bound reaches the floor, and no others;
within a task a rising floor leaves out cells once more. Nothing is approximate: where vectors have no
structure all cells are visited.

Neighbouring cells share a part, large cells are cut over several, so that parts hold equally many vectors
whatever the data, and a query travels once to each part it needs. A part's vectors fit into a task. There
are no more parts than that asks for or than balances what is moved: a part has several tasks, each of
which holds its vectors and takes a share of the queries. Matrices are bounded by blocks of both sides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from groundsill.session import in_small_batches, materialize, ship_with_tasks

ship_with_tasks(__name__)

# Matrix products may round differently from a plain sum by a few units in the last place;
# anything this close to the cut is scored again exactly.
_SLACK = 1e-9
# An angle is told from its cosine with an error of up to the root of the cosine's.
_ANGLE_SLACK = 1e-6
_QUERY_BLOCK = 256
_TILE = 4096
# Queries and cells, or vectors and pivots, that are looked at together.
_BOUNDED = 1 << 18
_TASK_PAIRS = 1 << 27
PART_BYTES = 32 << 20
"""What a task holds of the vectors, about three times over while it sorts them."""
MAX_CELLS = 1024
MAX_PIVOT_BYTES = 32 << 20
"""What a task and the driver hold of the pivots; wider vectors get fewer of them."""


@dataclass(frozen=True)
class Cells:
    """Pivots as rows, the least and largest angle and the number of vectors of each cell, and the
    first and last part its vectors are in."""

    pivots: np.ndarray
    near: np.ndarray
    far: np.ndarray
    count: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def bounds(self, queries: np.ndarray, only: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Per query and cell a score that nothing in the cell exceeds; no number for a query that
        has none."""
        return self.reach(_angles(queries, self.pivots[only]), only)

    def reach(self, angle: np.ndarray, only: np.ndarray | slice = slice(None)) -> np.ndarray:
        closest = np.maximum(np.maximum(angle - self.far[only], self.near[only] - angle) - _ANGLE_SLACK, 0)
        return np.where(self.count[only] > 0, np.cos(np.minimum(closest, np.pi)) + _SLACK, -np.inf)


def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore", over="ignore"):
        return np.arccos(np.clip(vectors @ pivots.T, -1.0, 1.0))


def _matrix(column: pd.Series, dimension: int) -> np.ndarray:
    if len(column) == 0:
        return np.zeros((0, dimension))
    return np.stack(column.to_list()).astype(np.float64, copy=False)


def _blocks(n: int, width: int) -> Iterator[slice]:
    """``n`` rows in runs that make no more than ``_BOUNDED`` entries of ``width`` columns."""
    step = max(_BOUNDED // max(width, 1), 1)
    return (slice(start, start + step) for start in range(0, n, step))


@dataclass(frozen=True)
class _Part:
    """The vectors of a task, cell by cell: ``names`` are their ids in order, ``items`` the places of the
    ids, ``start`` where each of ``cells`` begins. Components are rows, in both precisions; ``rough`` is
    none where single precision cannot hold them."""

    names: np.ndarray
    items: np.ndarray
    exact: np.ndarray
    rough: np.ndarray | None
    cells: np.ndarray
    start: np.ndarray


class _Best:
    """The k best vectors seen so far for each query, by (score desc, id asc).

    ``floor`` is a score that the k-th best of all vectors is known to reach.
    """

    def __init__(self, vectors: np.ndarray, k: np.ndarray, floor: np.ndarray):
        self.vectors, self.k = vectors, k.astype(np.int64)
        self.exact = np.ascontiguousarray(vectors.T)
        self.rough = _single(vectors)
        self.norm = np.linalg.norm(vectors, axis=1) if self.rough is not None else None
        self.cut = floor.copy()
        self.kept = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))]
        self.held = 0
        self.most_held = max(2 * int(self.k.sum()), _TILE)

    def add(self, only: np.ndarray, part: _Part, tile: slice, wanted: np.ndarray | None) -> None:
        """A tile of a part's vectors for some queries; ``wanted`` says which of the pairs count."""
        cut, k = self.cut[only], self.k[only]
        if self.rough is not None and part.rough is not None:
            # Products of single precision are off by so much at most (dimension x unit x lengths).
            longest = np.sqrt(np.square(part.rough[:, tile], dtype=np.float64).sum(axis=0).max())
            unit = (len(part.exact) + 8) * 2.0**-23
            slack = _SLACK + unit * self.norm[only] * longest
            near = self.rough[only] @ part.rough[:, tile]
        else:
            slack = np.full(len(only), _SLACK)
            with np.errstate(invalid="ignore", over="ignore"):
                near = self.vectors[only] @ part.exact[:, tile]
            # A score that is no number is no hit and must not raise the cut.
            near[~np.isfinite(near)] = -np.inf
        if wanted is not None:
            near[~wanted] = -np.inf
        width = near.shape[1]
        passing = (near >= (cut - slack)[:, None]) & (near > -np.inf)
        # The k-th best of this tile alone is a valid lower bound for the k-th best overall.
        many = passing.sum(axis=1) > 4 * k
        for size in np.unique(k[many & (k <= width)]):
            same = np.flatnonzero(many & (k == size))
            kth = np.partition(near[same], width - size, axis=1)[:, width - size]
            cut[same] = np.maximum(cut[same], kth - slack[same])
            passing[same] &= near[same] >= (cut[same] - slack[same])[:, None]
        self.cut[only] = cut
        query, place = np.nonzero(passing)
        if len(query) == 0:
            return
        query, place = only[query], place + tile.start
        exact = np.zeros(len(query))
        with np.errstate(invalid="ignore", over="ignore"):
            for mine, theirs in zip(self.exact, part.exact, strict=True):
                # Same order and rounding as a plain sum over the array's elements.
                exact += theirs[place] * mine[query]
        self.kept.append((query, exact, part.items[place]))
        self.held += len(query)
        if self.held > self.most_held:
            self._settle()

    def _settle(self) -> None:
        query, score, item = (np.concatenate(c) for c in zip(*self.kept, strict=True))
        order = np.lexsort((item, -score, query))
        query, score, item = query[order], score[order], item[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        last = place == self.k[query] - 1
        self.cut[query[last]] = np.maximum(self.cut[query[last]], score[last])
        among = place < self.k[query]
        self.kept, self.held = [(query[among], score[among], item[among])], 0

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self._settle()
        return self.kept[0]


def _single(matrix: np.ndarray) -> np.ndarray | None:
    """In single precision, or none where that could leave its range (or is no number)."""
    return matrix.astype(np.float32) if matrix.size == 0 or np.abs(matrix).max() < 1e15 else None


_HITS = "query_id string, item_id string, score double, k int"
_DEALT = "id string, vec array<double>, cell int, angle double"
_SEEDED = "id string, vec array<double>, k int, seeds array<int>"
_SENT = "part int, id string, vec array<double>, k int, floor double, seeds array<int>, pairs bigint"


@dataclass(frozen=True)
class Search:
    """``hits`` and what they took: ``visits`` has ``query_id`` and ``pairs``, the number of vectors
    in the cells that the query was sent to, in one row per journey; ``vectors`` is their number."""

    hits: DataFrame
    visits: DataFrame
    vectors: int

    def share(self) -> float:
        """Of all pairs of a query and a vector, those that were sent to be scored."""
        found = self.visits.agg(
            F.sum("pairs").alias("pairs"), F.count_distinct("query_id").alias("queries")).first()
        return (found.pairs or 0) / max((found.queries or 0) * self.vectors, 1)


def _deal(vectors: DataFrame, pivots: np.ndarray, dimension: int) -> DataFrame:
    def nearest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for block in _blocks(len(whole), len(pivots)):
                frame = whole.iloc[block]
                angle = _angles(_matrix(frame["vec"], dimension), pivots)
                usable = np.isfinite(angle).all(axis=1)
                angle = angle[usable]
                cell = angle.argmin(axis=1) if len(angle) else np.zeros(0, np.int64)
                yield frame[usable].assign(
                    cell=cell.astype("int32"), angle=angle[np.arange(len(angle)), cell])

    return in_small_batches(vectors).mapInPandas(nearest, _DEALT)


def _chain(pivots: np.ndarray) -> list[int]:
    """The cells in an order in which neighbours follow each other: always to the nearest one left."""
    left, order = set(range(len(pivots))), []
    at = 0
    while left:
        left.discard(at)
        order.append(at)
        if left:
            rest = np.fromiter(left, np.int64)
            at = int(rest[(pivots[rest] @ pivots[at]).argmax()])
    return order


def _layout(pivots: np.ndarray, stats: list, parts: int) -> Cells:
    """Cells laid end to end along the chain and cut into parts of equally many vectors."""
    n = len(pivots)
    near, far, count = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
    for row in stats:
        near[row.cell], far[row.cell], count[row.cell] = row.near, row.far, row.n
    each = max(-(-int(count.sum()) // parts), 1)
    first, last, so_far = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    for cell in _chain(pivots):
        first[cell] = min(so_far // each, parts - 1)
        so_far += int(count[cell])
        last[cell] = max(min((so_far - 1) // each, parts - 1), first[cell])
    return Cells(pivots, near, far, count, first, last)


def _with_seeds(queries: DataFrame, cells: Cells, dimension: int) -> DataFrame:
    """Queries that can have hits, with the cells they visit first: those of highest bound, nearest pivot
    first among equal ones, that hold k vectors together."""

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for block in _blocks(len(whole), len(cells.pivots)):
                frame = whole.iloc[block]
                angle, k = _angles(_matrix(frame["vec"], dimension), cells.pivots), frame["k"].to_numpy()
                usable = np.isfinite(angle).all(axis=1) & (k > 0)
                frame, angle, k = frame[usable], angle[usable], k[usable]
                if frame.empty:
                    continue
                order = np.lexsort((angle, -cells.reach(angle)), axis=1)
                count = cells.count[order]
                first = (np.cumsum(count, axis=1) - count < k[:, None]) & (count > 0)
                yield frame.assign(seeds=[
                    one[chosen].astype("int32") for one, chosen in zip(order, first, strict=True)])

    return in_small_batches(queries).mapInPandas(choose, _SEEDED)


def _send(queries: DataFrame, cells: Cells, dimension: int, seeds: bool) -> DataFrame:
    """Queries to the parts of the cells they are to visit: their seeds, or else all other cells that can
    reach the floor."""
    columns = [c.split()[0] for c in _SENT.split(", ")]

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for block in _blocks(len(whole), len(cells.pivots)):
                frame = whole.iloc[block]
                wanted = np.zeros((len(frame), len(cells.pivots)), bool)
                for one, chosen in zip(wanted, frame["seeds"], strict=True):
                    one[np.asarray(chosen, np.int64)] = True
                if not seeds:
                    bound = cells.bounds(_matrix(frame["vec"], dimension))
                    wanted = ~wanted & (bound >= frame["floor"].to_numpy()[:, None]) & (cells.count > 0)
                q, cell = np.nonzero(wanted)
                if not len(q):
                    continue
                # One row per part of each cell, gathered to one row per part and query.
                span = cells.last[cell] - cells.first[cell] + 1
                row = np.repeat(np.arange(len(q)), span)
                step = np.arange(len(row)) - np.repeat(np.cumsum(span) - span, span)
                q, cell, part = q[row], cell[row], cells.first[cell[row]] + step
                pairs = np.where(step == 0, cells.count[cell], 0)
                order = np.lexsort((q, part))
                q, part, pairs = q[order], part[order], pairs[order]
                start = np.flatnonzero(np.append(True, (np.diff(part) != 0) | (np.diff(q) != 0)))
                yield frame.iloc[q[start]].assign(
                    part=part[start].astype("int32"), pairs=np.add.reduceat(pairs, start))[columns]

    return in_small_batches(queries).mapInPandas(choose, _SENT)


def _meet(dealt: DataFrame, sent: DataFrame, cells: Cells, parts: int, dimension: int,
          seeds: bool, slices: int = 1) -> DataFrame:
    """Hits of each query in each part it was sent to. A part has ``slices`` tasks: its vectors go to
    all of them, each of its queries to one."""
    spans = [[c, int(a), int(b - a + 1)] for c, (a, b) in enumerate(
        zip(cells.first, cells.last, strict=True))]
    spark = dealt.sparkSession
    where = spark.createDataFrame(spans, "cell int, first int, parts int")
    part = F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    v = dealt.join(F.broadcast(where), "cell").withColumn("slice", copies).select(
        (part * slices + F.col("slice")).cast("int").alias("task"),
        F.lit(0).alias("asks"), "id", "vec", F.lit(0).alias("k"), F.lit(0.0).alias("floor"),
        F.array("cell").alias("seeds"))
    q = sent.select(
        (F.col("part") * slices + F.pmod(F.xxhash64("id"), F.lit(slices))).cast("int").alias("task"),
        F.lit(1).alias("asks"), "id", "vec", "k", "floor", "seeds")

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, held, part = None, [], None
        for frame in frames:
            for (at, asks), rows in frame.groupby(["task", "asks"], sort=False):
                if at != task:
                    task, held, part = at, [], None
                if not asks:
                    held.append((rows["id"].to_numpy(), _matrix(rows["vec"], dimension),
                                 np.array([c[0] for c in rows["seeds"]])))
                    continue
                if held:
                    part, held = _part(held), []
                if part is None:
                    continue
                for start in range(0, len(rows), _QUERY_BLOCK):
                    yield _answers(rows.iloc[start : start + _QUERY_BLOCK], part, cells, dimension, seeds)

    both = v.unionByName(q).repartitionById(parts * slices, "task").sortWithinPartitions("task", "asks")
    return in_small_batches(both).mapInPandas(score, _HITS)


def _part(held: list) -> _Part:
    ids = np.concatenate([h[0] for h in held]).astype(object)
    cell = np.concatenate([h[2] for h in held])
    by_id = sorted(range(len(ids)), key=ids.__getitem__)
    item = np.empty(len(ids), np.int64)
    item[by_id] = np.arange(len(ids))
    order = np.lexsort((item, cell))
    exact = np.ascontiguousarray(np.concatenate([h[1] for h in held])[order].T)
    present, start = np.unique(cell[order], return_index=True)
    return _Part(ids[by_id], item[order], exact, _single(exact), present, np.append(start, len(ids)))


def _answers(rows: pd.DataFrame, part: _Part, cells: Cells, dimension: int,
             seeds: bool) -> pd.DataFrame:
    vectors, k = _matrix(rows["vec"], dimension), rows["k"].to_numpy()
    best = _Best(vectors, k, rows["floor"].to_numpy())
    bound = cells.bounds(vectors, part.cells)
    wanted = np.zeros(bound.shape, bool)
    for one, chosen in zip(wanted, rows["seeds"], strict=True):
        one[:] = np.isin(part.cells, chosen)
    if not seeds:
        wanted = ~wanted & (bound >= best.cut[:, None])
    # Cells of high bounds first, so that the cut rises early; runs of cells where most are wanted.
    if wanted.mean() > 0.5:
        size = np.diff(part.start)
        run = np.cumsum(size) // _TILE
        runs = [np.flatnonzero(run == r) for r in np.unique(run)]
    else:
        gain = np.where(wanted, bound, 0).sum(axis=0)
        runs = [np.array([c]) for c in np.argsort(-gain) if wanted[:, c].any()]
    for run in runs:
        mine = wanted[:, run] & (bound[:, run] >= best.cut[:, None] - _SLACK)
        only = np.flatnonzero(mine.any(axis=1))
        if not len(only):
            continue
        mine, first, end = wanted[np.ix_(only, run)], part.start[run[0]], part.start[run[-1] + 1]
        pairs = None if mine.all() else np.repeat(mine, np.diff(part.start)[run], axis=1)
        for start in range(first, end, _TILE):
            tile = slice(start, min(start + _TILE, end))
            best.add(only, part, tile, None if pairs is None else pairs[:, start - first : tile.stop - first])
    query, score, item = best.result()
    return pd.DataFrame({
        "query_id": rows["id"].to_numpy()[query], "item_id": part.names[item], "score": score,
        "k": k[query].astype("int32")})


def _split(vectors: int, queries: int, wanted: int, dimension: int, tasks: int, least: int) -> tuple[int, int]:
    """Parts and slices of the second round: as many tasks as the pairs are worth, ``least`` at least and
    ``tasks`` at most. Vectors are copied per slice, queries and their hits per part; what is moved in
    all is least where both weigh the same. A part is never larger than ``PART_BYTES``."""
    count = max(min(-(-vectors * queries // _TASK_PAIRS), tasks), min(least, tasks), 1)
    row = 8 * dimension + 100
    parts = round((count * vectors * row / max(queries * row + wanted * 100, 1)) ** 0.5)
    parts = max(min(parts, count), -(-vectors * 8 * dimension // PART_BYTES), 1)
    return parts, max(round(count / parts), 1)


def search(queries: DataFrame, vectors: DataFrame, dimension: int, *,
           query_id: str = "request_id", query_vector: str = "query_vector",
           k: str = "candidate_k", item_id: str = "chunk_id",
           item_vector: str = "unit_vector", partitions: int | None = None,
           cells: int | None = None) -> Search:
    """The ``k`` best items per query by similarity descending, then item id ascending.

    Both sides must hold unit vectors of ``dimension`` and unique ids; ``k`` is a column, so
    every query asks for its own number. Hits have query id, ``rank`` from 0, item id and
    ``similarity``. ``partitions`` (by default ``spark.sql.shuffle.partitions``) is the number of tasks,
    more if a task's vectors would take over ``PART_BYTES``; queries only pass through. ``cells`` is the
    number of pivots, vectors that a hash of their ids puts first: at most ``MAX_CELLS``, and no more than fit
    ``MAX_PIVOT_BYTES``; by default four a partition, 16 at least. A vector with a component that is no
    finite number is no hit; a query that has one, or has no vector, gets none.

    Sampling the pivots and summing up the cells are jobs of their own, run at once, as is the first
    round of visits.
    """
    spark = vectors.sparkSession
    tasks = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    v = vectors.select(
        F.col(item_id).cast("string").alias("id"), F.col(item_vector).cast("array<double>").alias("vec"))
    q = queries.where(F.col(query_vector).isNotNull()).select(
        F.col(query_id).cast("string").alias("id"),
        F.col(query_vector).cast("array<double>").alias("vec"), F.col(k).cast("int").alias("k"))
    most = min(cells or max(4 * tasks, 16), MAX_CELLS, max(MAX_PIVOT_BYTES // (8 * dimension), 1))
    finite = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sample = v.where(finite).orderBy(F.xxhash64("id"), "id").limit(most).toPandas()
    if sample.empty:
        none = q.select("id").limit(0)
        return Search(
            none.select(F.col("id").alias(query_id), F.lit(0).alias("rank"), F.col("id").alias(item_id),
                        F.lit(0.0).alias("similarity")),
            none.select(F.col("id").alias("query_id"), F.lit(0).cast("bigint").alias("pairs")), 0)
    pivots = np.unique(_matrix(sample["vec"], dimension), axis=0)
    dealt = materialize(_deal(v, pivots, dimension))
    stats = dealt.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("angle").alias("near"), F.max("angle").alias("far")).collect()
    n = sum(row.n for row in stats)
    dealt = dealt.drop("angle")

    most = max(tasks, -(-n * 8 * dimension // PART_BYTES))
    laid = _layout(pivots, stats, most)
    # Written once: the queries with their vectors are sent out two times, and what a query has seen in
    # the first round must be what it leaves out in the second.
    q = materialize(_with_seeds(q, laid, dimension))
    asked = q.agg(F.count("*").alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    no_floor = F.lit(float("-inf"))
    seeds = _send(q.withColumn("floor", no_floor), laid, dimension, seeds=True)
    # Written once: their k-th score is the floor of the second round, and they are hits themselves.
    early = materialize(_merge(_meet(dealt, seeds, laid, most, dimension, seeds=True)))
    floors = early.groupBy("query_id").agg(
        F.when(F.count("*") >= F.max("k"), F.min("score")).alias("floor"))
    again = q.join(floors, q["id"] == floors["query_id"], "left").select(
        "id", "vec", "k", "seeds", F.coalesce("floor", no_floor).alias("floor"))
    parts, slices = _split(n, asked.n, asked.k, dimension, tasks, spark.sparkContext.defaultParallelism)
    laid = _layout(pivots, stats, parts)
    sent = _send(again, laid, dimension, seeds=False)
    late = _meet(dealt, sent, laid, parts, dimension, seeds=False, slices=slices)
    hits = _merge(early.select("query_id", "item_id", "score", "k").unionByName(late)).select(
        F.col("query_id").alias(query_id), "rank", F.col("item_id").alias(item_id),
        F.col("score").alias("similarity"))
    visits = seeds.unionByName(sent).select(F.col("id").alias("query_id"), "pairs")
    return Search(hits, visits, n)


def knn_topk(queries: DataFrame, vectors: DataFrame, dimension: int, **columns) -> DataFrame:
    """The hits of ``search``."""
    return search(queries, vectors, dimension, **columns).hits


def _merge(hits: DataFrame) -> DataFrame:
    """Fold the hits of parts to the final k per query; a query has k per part at most."""
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("item_id"))
    return hits.withColumn("rank", F.row_number().over(best) - 1).where(F.col("rank") < F.col("k"))


def resolve(hits: DataFrame, export: DataFrame, item_id: str = "chunk_id") -> DataFrame:
    """Attach ids and metadata to hits. Nothing is lost: a hit without metadata stays, marked
    in ``resolve_error``; the search rank is carried along as a column."""
    side = export.drop("unit_vector")
    error = F.when(F.col("vector_id").isNull(), "ID_NOT_IN_MAP").when(
        F.col("knowledge_id").isNull(), "METADATA_MISSING"
    )
    return hits.join(side, item_id, "left").withColumn("resolve_error", error)


def require_resolved(resolved: DataFrame) -> DataFrame:
    """The same rows, or a failed job at the first hit that could not be resolved."""
    message = F.concat(F.col("resolve_error"), F.lit(": "), F.col("chunk_id"))
    return resolved.withColumn(
        "resolve_error",
        F.when(F.col("resolve_error").isNotNull(), F.raise_error(message).cast("string")),
    )


def sample_ids(export: DataFrame, n: int) -> DataFrame:
    """The ``n`` smallest chunk ids. Ids are hashes of content, so this is a sample that comes out
    the same on every run."""
    return export.select("chunk_id").orderBy("chunk_id").limit(n)


def self_retrieval(export: DataFrame, dimension: int, sample: DataFrame) -> DataFrame:
    """Search the vectors of the sampled chunk ids among all; one row per probe with its best hit."""
    asked = export.join(sample.select("chunk_id"), "chunk_id", "left_semi")
    probes = asked.select(
        F.col("chunk_id").alias("probe_id"), F.col("unit_vector").alias("query_vector"),
        F.lit(1).alias("one"),
    )
    best = knn_topk(probes, export, dimension, query_id="probe_id", k="one")
    return best.select(
        "probe_id", F.col("chunk_id").alias("hit_id"), "similarity",
        (F.col("probe_id") == F.col("chunk_id")).alias("hit_self"),
    )


def self_recall(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("*").alias("probes"), F.count_if("hit_self").alias("self_hits"),
        (F.count_if("hit_self") / F.greatest(F.count("*"), F.lit(1))).alias("recall"),
    )
