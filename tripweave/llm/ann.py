"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

The largest inner product with a query is the smallest distance after every vector gets one
more component that brings all to the same norm. A Gaussian (2-stable) projection to a few
dimensions turns a squared distance into that distance times a chi-square variable, so
neighbours in the projection come roughly in the right order. They are taken from a
kd-tree in the order of their projected distance and verified by their true inner product.
The search of a query ends when the next projected distance is so large that a nearer
vector would, with probability ``CONFIDENCE``, have come before.

The upper levels of the tree deal the rows out to cells; a cell of many rows is split by a
hash of the ids. A query first searches its own cell; the others are visited only where the
same test, with the distances found so far, does not rule them out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import settled

PROJECTED = 12  # dimensions of the projection
CONFIDENCE = 0.98
SEED = 97
SAMPLE_ROWS = 20_000  # bound of the sample on which the upper levels of the tree are fitted
SHARD_ROWS = 8192  # rows that one local tree holds, about
LEAF_ROWS = 64
QUERIES = 256  # queries searched together
DATA, QUERY = 0, 1


def projection(dims: int) -> np.ndarray:
    """The random matrix for vectors of ``dims`` components and the added one."""
    return np.random.default_rng((SEED, dims)).standard_normal((dims + 1, PROJECTED))


def chi_square_quantile(probability: float, freedom: int = PROJECTED) -> float:
    """For an even number of degrees of freedom, by bisection of the closed form."""
    low, high = 0.0, 100.0 * freedom
    for _ in range(200):
        half = (low + high) / 4
        beyond = math.exp(-half) * sum(half**i / math.factorial(i) for i in range(freedom // 2))
        low, high = ((low + high) / 2, high) if 1 - beyond < probability else (low, (low + high) / 2)
    return low


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` (doubles) of the rows that take part: an id, and finite components that are not all zero."""
    finite = F.expr("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    nonzero = F.expr("exists(embedding, x -> x <> 0)")
    return vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(finite & nonzero).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vector")
    )


class Router:
    """The upper levels of the tree: which cell a projected point lies in, and how near each cell comes to it."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []
        self.tree = self._grow(sample, depth, np.full(PROJECTED, -np.inf), np.full(PROJECTED, np.inf))
        self.low, self.high = (np.array(side) for side in zip(*self.boxes))

    def _grow(self, points, depth, low, high):
        if depth == 0 or len(points) < 16 or not np.ptp(points, axis=0).any():
            self.boxes.append((low, high))
            return len(self.boxes) - 1
        axis = int(np.argmax(np.ptp(points, axis=0)))
        border = float(np.median(points[:, axis]))
        under, over, left, right = points[:, axis] <= border, points[:, axis] > border, high.copy(), low.copy()
        if not over.any():
            self.boxes.append((low, high))
            return len(self.boxes) - 1
        left[axis] = right[axis] = border
        return axis, border, self._grow(points[under], depth - 1, low, left), self._grow(points[over], depth - 1, right, high)

    def cells(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int32)
        waiting = [(self.tree, np.arange(len(points)))]
        while waiting:
            node, own = waiting.pop()
            if isinstance(node, int):
                out[own] = node
                continue
            axis, border, under, over = node
            goes = points[own, axis] <= border
            waiting += [(under, own[goes]), (over, own[~goes])]
        return out

    def squares(self, points: np.ndarray) -> np.ndarray:
        return box_squares(points, self.low, self.high)


def box_squares(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    out = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        here = points[:, axis, None]
        out += np.maximum(np.maximum(low[None, :, axis] - here, here - high[None, :, axis]), 0) ** 2
    return out


def lifted(vectors: np.ndarray, norm: float, query: bool) -> np.ndarray:
    """Vectors with the component that brings them to ``norm``; a query is scaled to it."""
    squares = (vectors**2).sum(axis=1)
    if query:
        vectors, rest = vectors * (norm / np.sqrt(squares))[:, None], np.zeros(len(vectors))
    else:
        rest = np.sqrt(np.maximum(norm**2 - squares, 0))
    return np.hstack((vectors, rest[:, None]))


class Shard:
    """A kd-tree over the projections of some vectors. Of equal vectors, more than ``k`` + 1 ids are never needed."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm: float, k: int):
        order = np.argsort(ids, kind="stable")
        _, first, kind = np.unique(vectors[order], axis=0, return_index=True, return_inverse=True)
        grouped = np.lexsort((ids[order], kind))
        counts = np.bincount(kind)
        starts = np.cumsum(counts) - counts
        ids, distinct = ids[order][grouped], vectors[order][first]
        self.k, self.norm = k, norm
        self.matrix = projection(vectors.shape[1])
        points = lifted(distinct, norm, False) @ self.matrix
        leaves = list(self._leaves(points, np.arange(len(points))))
        order = np.concatenate(leaves)
        self.vectors, self.copies = distinct[order], np.minimum(counts[order], k + 1)
        self.ids = [ids[s : s + c] for s, c in zip(starts[order], self.copies)]
        self.bounds = np.cumsum([0, *map(len, leaves)])
        self.low = np.array([points[leaf].min(axis=0) for leaf in leaves])
        self.high = np.array([points[leaf].max(axis=0) for leaf in leaves])

    @staticmethod
    def _leaves(points: np.ndarray, own: np.ndarray) -> Iterator[np.ndarray]:
        waiting = [own]
        while waiting:
            own = waiting.pop()
            if len(own) <= LEAF_ROWS:
                yield own
                continue
            axis = int(np.argmax(np.ptp(points[own], axis=0)))
            half = len(own) // 2
            parted = own[np.argpartition(points[own, axis], half)]
            waiting += [parted[half:], parted[:half]]

    def search(self, ids: np.ndarray, queries: np.ndarray, least: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """Per query the ids and exact scores of the nearest found. ``least``: a score that k vectors are known to reach."""
        scale = self.norm / np.sqrt((queries**2).sum(axis=1))
        squares = box_squares(lifted(queries, self.norm, True) @ self.matrix, self.low, self.high)
        order = np.argsort(squares, axis=1)
        squares = np.take_along_axis(squares, order, axis=1)
        keep = min(2 * self.k + 2, len(self.vectors))
        best = np.full((len(queries), keep), -np.inf)
        who = np.zeros((len(queries), keep), np.int64)
        stop, quantile = np.full(len(queries), len(self.low)), chi_square_quantile(CONFIDENCE)
        active, rank, step = np.arange(len(queries)), 0, 4
        while len(active) and rank < len(self.low):
            taken = order[active, rank : rank + step]
            for leaf in np.unique(taken):
                self._verify(int(leaf), active[(taken == leaf).any(axis=1)], queries, best, who)
            rank += step
            step = min(2 * step, 32)
            if rank < len(self.low):
                reached = best[active, self.k] if keep > self.k else np.full(len(active), -np.inf)
                reached = np.maximum(reached, least[active])
                far = np.maximum(2 * self.norm**2 - 2 * self.norm * (reached * scale[active] / self.norm), 0)
                active = active[squares[active, rank] < quantile * far]
        return self._exact(ids, queries, best, who)

    def _verify(self, leaf, rows, queries, best, who) -> None:
        """Score a leaf's vectors for some queries and keep each query's best, in descending order."""
        own = np.arange(self.bounds[leaf], self.bounds[leaf + 1])
        scores = np.hstack((best[rows], queries[rows] @ self.vectors[own].T))
        names = np.hstack((who[rows], np.broadcast_to(own, (len(rows), len(own)))))
        order = np.argsort(-scores, axis=1, kind="stable")[:, : best.shape[1]]
        best[rows], who[rows] = np.take_along_axis(scores, order, axis=1), np.take_along_axis(names, order, axis=1)

    def _exact(self, ids, queries, best, who) -> list[tuple[np.ndarray, ...]]:
        row, column = np.nonzero(best > -np.inf)
        found = who[row, column]
        exact = np.zeros(len(found))
        for axis in range(queries.shape[1]):  # one order of summation for all, so equal vectors score alike
            exact += queries[row, axis] * self.vectors[found, axis]
        copies = self.copies[found]
        row, exact = np.repeat(row, copies), np.repeat(exact, copies)
        names = np.concatenate([self.ids[i] for i in found]) if len(found) else np.zeros(0, np.int64)
        other = names != ids[row]
        row, exact, names = row[other], exact[other], names[other]
        order = np.lexsort((names, -exact, row))
        row, exact, names = row[order], exact[order], names[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept = place < self.k
        return ids[row[kept]], names[kept], exact[kept]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dims)


ROW = "dims int, cell int, shard int, kind int, id long, least double, vector binary"
ROW_NAMES = ["dims", "cell", "shard", "kind", "id", "least", "vector"]


def _rows(dims, cells, shards, kind, ids, least, vectors) -> pa.RecordBatch:
    n = len(ids)
    columns = [
        pa.array(np.full(n, dims, np.int32)),
        pa.array(np.asarray(cells, np.int32)),
        pa.array(np.asarray(shards, np.int32)),
        pa.array(np.full(n, kind, np.int32)),
        pa.array(np.asarray(ids, np.int64)),
        pa.array(np.asarray(least, np.float64)),
        pa.array([v.tobytes() for v in np.ascontiguousarray(vectors)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ROW_NAMES)


def _by_dims(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimensions, rows, vectors) for each length of the lists in a column."""
    lists = batch.column(at)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    for dims in np.unique(lengths):
        rows = np.flatnonzero(lengths == dims)
        yield int(dims), rows, lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


class Index:
    """Cells of all vectors in a scratch table, with what is needed to route queries to them."""

    def __init__(self, vectors: DataFrame, k: int):
        self.k, rows = k, usable(vectors)
        norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
        self.n, largest = rows.agg(F.count("*"), F.max(norm)).first()
        self.norm = largest or 1.0
        depth = max(0, math.ceil(math.log2(max(1, self.n) / SHARD_ROWS)))
        sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).collect()
        points = [lifted(np.array([r["vector"]]), self.norm, False) @ projection(len(r["vector"])) for r in sample]
        self.router = Router(np.concatenate(points) if points else np.zeros((0, PROJECTED)), depth)
        self.rows = settled(self._dealt(rows), "vectors")
        counts = self.rows.groupBy("dims", "cell").count().collect()  # a row for each cell
        self.shards = {(r["dims"], r["cell"]): max(1, round(r["count"] / SHARD_ROWS)) for r in counts}

    def _dealt(self, rows: DataFrame) -> DataFrame:
        norm, router = self.norm, self.router

        def run(batches):
            for batch in batches:
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                for dims, own, vectors in _by_dims(batch, 1):
                    cells = router.cells(lifted(vectors, norm, False) @ projection(dims))
                    yield _rows(dims, cells, np.zeros(len(own)), DATA, ids[own], np.full(len(own), -np.inf), vectors)

        return rows.mapInArrow(run, ROW)

    def _routed(self, queries: DataFrame, home: bool) -> DataFrame:
        """A row of each query for each shard of its own cell, or of the others that its score does not rule out."""
        norm, router, shards = self.norm, self.router, self.shards
        quantile = chi_square_quantile(CONFIDENCE)

        def run(batches):
            for batch in batches:
                for dims in np.unique(batch.column(0).to_numpy(zero_copy_only=False)):
                    own = batch.filter(pa.array(batch.column(0).to_numpy(zero_copy_only=False) == dims))
                    ids, least = (own.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
                    vectors = _matrix(own.column(3), dims)
                    points = lifted(vectors, norm, True) @ projection(int(dims))
                    at_home = router.cells(points)
                    scale = norm / np.sqrt((vectors**2).sum(axis=1))
                    far = np.maximum(2 * norm**2 - 2 * least * scale, 0)
                    near = router.squares(points) < quantile * far[:, None]
                    for cell in range(near.shape[1]):
                        goes = np.flatnonzero(at_home == cell if home else near[:, cell] & (at_home != cell))
                        for shard in range(shards.get((int(dims), cell), 0)):
                            yield _rows(dims, np.full(len(goes), cell), np.full(len(goes), shard), QUERY, ids[goes], least[goes], vectors[goes])

        return queries.select("dims", "id", "least", "vector").mapInArrow(run, ROW)

    def _found(self, routed: DataFrame) -> DataFrame:
        """``query_id, vec_id, score``: the nearest in each shard of the queries sent there.

        A shard's vectors come first and are indexed; its queries follow as a stream.
        """
        norm, k = self.norm, self.k
        shards = F.create_map(*(F.lit(x) for (d, c), n in self.shards.items() for x in (f"{d}:{c}", n))) if self.shards else None
        data = self.rows
        if shards is not None:
            name = F.concat_ws(":", "dims", "cell")
            data = data.withColumn("shard", F.pmod(F.xxhash64("id"), F.element_at(shards, name)).cast("int"))

        def run(batches):
            key, held, shard = None, [], None
            for batch in batches:
                keys = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:4]], 1)
                borders = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
                for start, stop in zip([0, *borders], [*borders, len(keys)]):
                    if start == stop:
                        continue
                    part, own = batch.slice(start, stop - start), tuple(keys[start, :3])
                    if own != key:
                        key, held, shard = own, [], None
                    ids = part.column(4).to_numpy(zero_copy_only=False)
                    vectors = _matrix(part.column(6), own[0])
                    if keys[start, 3] == DATA:
                        held.append((ids, vectors))
                        continue
                    if shard is None and held:
                        shard, held = Shard(*(np.concatenate(x) for x in zip(*held)), norm, k), []
                    if shard is None:
                        continue
                    least = part.column(5).to_numpy(zero_copy_only=False)
                    for at in range(0, len(ids), QUERIES):
                        some = slice(at, at + QUERIES)
                        columns = shard.search(ids[some], vectors[some], least[some])
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

        together = data.unionByName(routed).repartition("dims", "cell", "shard")
        ordered = together.sortWithinPartitions("dims", "cell", "shard", "kind", "id")
        return ordered.mapInArrow(run, "query_id long, vec_id long, score double")

    def nearest(self, queries: DataFrame) -> DataFrame:
        """``query_id, rank, vec_id, score`` for rows of ``vec_id, embedding``; a query's own id is no candidate."""
        asked = usable(queries).dropDuplicates(["vec_id"])
        packed = asked.mapInArrow(_packed, "dims int, id long, vector binary")
        packed = settled(packed.withColumn("least", F.lit(float("-inf"))), "queries")
        at_home = settled(self._found(self._routed(packed, True)), "home")
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        reached = at_home.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == self.k)
        known = reached.select(F.col("query_id").alias("id"), F.col("score").alias("reached"))
        known = packed.join(known, "id", "left").withColumn("least", F.coalesce("reached", "least"))
        elsewhere = self._found(self._routed(known, False))
        ranked = at_home.unionByName(elsewhere).withColumn("rank", F.row_number().over(best))
        return ranked.where(F.col("rank") <= self.k).select("query_id", "rank", "vec_id", "score")


def _packed(batches):
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for dims, own, vectors in _by_dims(batch, 1):
            columns = [pa.array(np.full(len(own), dims, np.int32)), pa.array(ids[own]), pa.array([v.tobytes() for v in vectors], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["dims", "id", "vector"])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """Each query's ``k`` nearest found among ``vectors`` by inner product, nearest first, ties to the smaller id.

    Vectors without an id, null, zero, or with a null or non-finite component take no part,
    neither as queries nor as candidates; vectors of different lengths never meet. A query
    that is repeated is asked once; repeated rows are candidates each. An empty table gives
    no rows.
    """
    return Index(vectors, k).nearest(queries)
