"""Nearest neighbours by inner product: stable projections, a kd-tree, and a chi-square stopping test.

Method: vectors get one more component that makes the largest inner product the smallest distance
(sqrt(M^2 - |x|^2), M the largest norm; 0 for queries). ``PROJECTED`` Gaussian (2-stable) projections of
them are indexed by a kd-tree: its upper part is fitted on a bounded sample and deals all rows to cells,
its lower part is built in each cell. For a query, the squared projected distance of a row divided by its
squared distance follows a chi-square law, so rows are verified in the order of the tree's leaves by
projected distance, and the search stops when the next leaf is so far that a row closer than the k-th
best found would lie there with probability below ``MISS``.

Two rounds, both plain joins: each query is searched in its own cell, which gives a bound; then it visits
the cells that the stopping test does not exclude under that bound. Cells of more than ``BLOCK`` rows
are dealt as several blocks, each with its own tree, and queries come in blocks too, so no task holds a
cell whole. Scores are inner products of the original vectors in double precision, never estimates.

Defined results: null, zero and non-finite vectors, and those of another length than most, take no part;
equal scores are ordered by id; rows with the query's own id are never its neighbours, other copies are;
with fewer candidates than k all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsift.llm.grouped import runs
from quillsift.session import written

PROJECTED = 8
SEED = 17
MISS = 0.01
SAMPLE = 20_000
CELL = 4096
BLOCK = 8192
QUERY_BLOCK = 2048
LEAF = 128
ROUNDING = 1e-12
FOUND = "query_id long, vec_id long, score double"


def chi_square_quantile(p: float, freedom: int) -> float:
    """x with P(chi-square of an even number of degrees <= x) = p, by bisection of the Poisson sum."""

    def upper(x: float) -> float:
        return math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(freedom // 2))

    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if 1 - upper(middle) < p else (low, middle)
    return low


def projection(width: int) -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(width + 1, PROJECTED))


def projected(vectors: np.ndarray, norm: float, query: bool) -> np.ndarray:
    """Projections of the vectors with their additional component."""
    rest = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(norm**2 - (vectors**2).sum(axis=1), 0))
    return np.hstack([vectors, rest[:, None]]) @ projection(vectors.shape[1])


class Cells:
    """Upper kd-tree: boxes from cutting the sample at medians of its widest side, in preorder arrays."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.axis, self.cut, self.left, self.right, self.boxes = [], [], [], [], []
        box = (np.full(PROJECTED, -np.inf), np.full(PROJECTED, np.inf))
        self._grow(sample, cells, box)

    def _grow(self, rows: np.ndarray, cells: int, box: tuple) -> int:
        own = len(self.axis)
        for part in (self.axis, self.cut, self.left, self.right):
            part.append(-1)
        spread = rows.max(axis=0) - rows.min(axis=0) if len(rows) > 1 else np.zeros(PROJECTED)
        axis = int(spread.argmax())
        cut = float(np.median(rows[:, axis])) if len(rows) else 0.0
        low = rows[:, axis] <= cut
        if cells <= 1 or len(rows) < 4 or low.all():
            self.left[own] = len(self.boxes)
            self.boxes.append(box)
            return own
        self.axis[own], self.cut[own] = axis, cut
        upper, lower = box[1].copy(), box[0].copy()
        upper[axis], lower[axis] = cut, cut
        self.left[own] = self._grow(rows[low], cells // 2, (box[0], upper))
        self.right[own] = self._grow(rows[~low], cells - cells // 2, (lower, box[1]))
        return own

    def cell_of(self, rows: np.ndarray) -> np.ndarray:
        axis, cut, left, right = map(np.array, (self.axis, self.cut, self.left, self.right))
        node = np.zeros(len(rows), dtype=np.int64)
        open_rows = np.arange(len(rows))
        while True:
            open_rows = open_rows[axis[node[open_rows]] >= 0]
            if not len(open_rows):
                return left[node]
            at = node[open_rows]
            low = rows[open_rows, axis[at]] <= cut[at]
            node[open_rows] = np.where(low, left[at], right[at])

    def distances(self, rows: np.ndarray) -> np.ndarray:
        """(rows, cells): squared distance to each box."""
        low, high = (np.array([b[i] for b in self.boxes]) for i in (0, 1))
        out = np.zeros((len(rows), len(low)))
        for d in range(PROJECTED):
            out += np.maximum(np.maximum(low[None, :, d] - rows[:, d, None], rows[:, d, None] - high[None, :, d]), 0) ** 2
        return out


class Tree:
    """Lower kd-tree of one block: rows in leaves of LEAF, and each leaf's box."""

    def __init__(self, points: np.ndarray):
        order, starts = [], []

        def split(rows: np.ndarray) -> None:
            if len(rows) <= LEAF:
                starts.append(sum(map(len, order)))
                order.append(rows)
                return
            own = points[rows]
            axis = int((own.max(axis=0) - own.min(axis=0)).argmax())
            half = len(rows) // 2
            ranked = rows[np.argpartition(own[:, axis], half)]
            split(ranked[:half])
            split(ranked[half:])

        split(np.arange(len(points)))
        self.order = np.concatenate(order)
        self.starts = np.array([*starts, len(points)])
        self.low = np.array([points[rows].min(axis=0) for rows in order])
        self.high = np.array([points[rows].max(axis=0) for rows in order])

    def distances(self, places: np.ndarray) -> np.ndarray:
        """(places, leaves): squared distance to each leaf's box."""
        out = np.zeros((len(places), len(self.low)))
        for d in range(places.shape[1]):
            at = places[:, d, None]
            out += np.maximum(np.maximum(self.low[None, :, d] - at, at - self.high[None, :, d]), 0) ** 2
        return out


class Block:
    """Rows of one block in the order of its tree's leaves."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm: float):
        self.tree = Tree(projected(vectors, norm, False))
        self.ids, self.vectors, self.norm = ids[self.tree.order], vectors[self.tree.order], norm

    def nearest(self, query: np.ndarray, far: np.ndarray, own: int, k: int, factor: float, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """Up to k (ids, scores); leaves by projected distance until the test holds.

        ``bound`` is the k-th best score known from elsewhere, or -inf. A product of the whole leaf
        finds the rows that can matter, within rounding; their scores are then summed row by row, so
        that equal vectors have equal scores.
        """
        length = float(query @ query)
        slack = ROUNDING * self.norm * math.sqrt(length)
        starts = self.tree.starts
        best_ids, best, least = np.zeros(0, dtype=np.int64), np.zeros(0), bound
        for leaf in np.argsort(far, kind="stable").tolist():
            if far[leaf] > factor * max(0.0, self.norm**2 + length - 2 * least):
                break
            begin, end = starts[leaf], starts[leaf + 1]
            rows = begin + np.flatnonzero(self.vectors[begin:end] @ query >= least - slack)
            rows = rows[self.ids[rows] != own]
            if not len(rows):
                continue
            scores = np.concatenate([best, (self.vectors[rows] * query).sum(axis=1)])
            names = np.concatenate([best_ids, self.ids[rows]])
            pick = np.lexsort((names, -scores))[:k]
            best_ids, best = names[pick], scores[pick]
            if len(best) >= k:
                least = max(bound, float(best[k - 1]))
        return best_ids, best


def usable(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): finite, nonzero double vectors of the commonest length."""
    rows = vectors.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").limit(1).first()
    return rows.where(F.size("v") == (common["n"] if common else 0))


def _stack(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def placed(rows: DataFrame, cells: Cells, norm: float) -> DataFrame:
    """``rows`` (vec_id, v, is_query) with the cell of each."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = _stack(batch.column("v"))
                own = cells.cell_of(projected(vectors, norm, False))
                yield batch.append_column("cell", pa.array(own, pa.int64()))

    return rows.mapInArrow(place, "vec_id long, v array<double>, cell long")


def searched(tasks: DataFrame, k: int, factor: float, norm: float) -> DataFrame:
    """FOUND from rows (cell, block, part, is_query, vec_id, v, bound), sorted by block and part."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["cell", "block", "part"]):
            asks = group.column("is_query").to_numpy()
            ids, vectors = group.column("vec_id").to_numpy(), _stack(group.column("v"))
            bounds = group.column("bound").to_numpy()
            if asks.all() or not asks.any():
                continue
            block = Block(ids[~asks], vectors[~asks], norm)
            queries = vectors[asks]
            far = block.tree.distances(projected(queries, norm, True))
            out: list[list] = [[], [], []]
            for query, row, own, bound in zip(queries, far, ids[asks].tolist(), bounds[asks].tolist()):
                near, scores = block.nearest(query, row, own, k, factor, bound)
                out[0].append(np.full(len(near), own))
                out[1].append(near)
                out[2].append(scores)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x), t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"]
            )

    return tasks.repartition("cell", "block", "part").sortWithinPartitions("cell", "block", "part").mapInArrow(search, FOUND)


def _tasks(points: DataFrame, visits: DataFrame, sizes: DataFrame) -> DataFrame:
    """Points once for each block of queries that visits their cell, queries once for each block of points.

    The broadcast table has one row per cell, fewer than the upper tree's sample has vectors.
    """
    parts = visits.groupBy("cell").agg(F.count("*").alias("asked")).join(sizes, "cell").select(
        "cell", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks"), F.ceil(F.col("asked") / QUERY_BLOCK).cast("long").alias("parts")
    )
    parts = F.broadcast(parts)
    code = F.xxhash64("vec_id")
    held = points.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(
        "cell", F.pmod(code, F.col("blocks")).alias("block"), "part", F.lit(False).alias("is_query"), "vec_id", "v", F.lit(-math.inf).alias("bound")
    )
    asked = visits.join(parts, "cell").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "cell", "block", F.pmod(code, F.col("parts")).alias("part"), F.lit(True).alias("is_query"), "vec_id", "v", "bound"
    )
    return held.union(asked)


def search(vectors: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", embedding: str = "embedding", miss: float = MISS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose id is divisible by ``every``."""
    rows = written(usable(vectors, key, embedding), "vectors")
    count, largest = rows.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()
    if not count:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    norm = math.sqrt(largest)
    chance = F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.where(chance < SAMPLE / count).limit(2 * SAMPLE).orderBy("vec_id").select("v").collect()
    sample = np.array([r["v"] for r in picked]) if picked else np.zeros((0, 1))
    places = projected(sample, norm, False) if picked else np.zeros((0, PROJECTED))
    cells = Cells(places, max(1, math.ceil(count / CELL)))
    factor = chi_square_quantile(1 - miss, PROJECTED)
    points = written(placed(rows, cells, norm), "placed")
    sizes = points.groupBy("cell").agg(F.count("*").alias("n"))
    queries = points.where(F.col("vec_id") % every == 0).distinct()
    home = searched(_tasks(points, queries.withColumn("bound", F.lit(-math.inf)), sizes), k, factor, norm)
    home = written(home, "home")
    worst = home.groupBy("query_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("score"), asc=False).alias("scores"))
    worst = worst.select("query_id", F.when(F.col("n") >= k, F.element_at("scores", F.least(F.col("n"), F.lit(k)).cast("int"))).otherwise(F.lit(-math.inf)).alias("bound"))
    asking = queries.join(worst, F.col("vec_id") == F.col("query_id"), "left").drop("query_id").fillna({"bound": -math.inf})

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = _stack(batch.column("v"))
            far = cells.distances(projected(own, norm, True))
            reach = factor * np.maximum(norm**2 + (own**2).sum(axis=1) - 2 * batch.column("bound").to_numpy(), 0)
            reach = np.where(np.isfinite(reach), reach, np.inf)
            home_cell = batch.column("cell").to_numpy()
            query, cell = np.nonzero(far <= reach[:, None])
            keep = home_cell[query] != cell
            query, cell = query[keep], cell[keep]
            taken = batch.take(pa.array(query)).drop_columns(["cell"])
            yield taken.append_column("cell", pa.array(cell, pa.int64()))

    visits = written(asking.select("vec_id", "v", "bound", "cell").mapInArrow(visit, "vec_id long, v array<double>, bound double, cell long"), "visits")
    away = searched(_tasks(points, visits, sizes), k, factor, norm)
    best = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id")))
    merged = home.union(away).groupBy("query_id").agg(F.slice(best, 1, k).alias("best"))
    return merged.select("query_id", F.posexplode("best").alias("pos", "b")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.less")).alias("score")
    )
