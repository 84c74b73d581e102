"""Nearest neighbours by inner product through low-dimensional stable projections and a kd-tree.

One more component puts all vectors on a sphere, and queries are stretched to
it, so that the largest inner product is the smallest Euclidean distance. A Gaussian matrix projects vectors to a few dimensions; the squared
ratio of a projected to a true distance is chi-square distributed. A kd-tree
over the projections, fitted on a bounded sample, gives cells that partition
all vectors. A query takes projected neighbours in growing projected distance,
first in its own cell, then round by round in more and more others, verifies each
on the original vectors, and stops once a closer vector would, with the given chance, have had
a projection nearer than the next one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import read
from shelfmark.session import Steps, stage

K = 20
# Dimensions of the projection; even, for the closed form of the chi-square test.
PROJECTED = 8
# Chance with which each true neighbour is among the verified ones.
CONFIDENCE = 0.96
SEED = 20
# Queries whose cells are worked out at a time.
_ROUTED = 256
# Vectors that the kd-tree is fitted on, at most, and vectors that a cell should hold.
MAX_SAMPLE = 65_536
CELL_ROWS = 2048
# By how much the number of cells that a query has been to may grow in a round.
GROWTH = 8
# Vectors of a cell that a task holds at a time; larger cells are cut by a hash.
BLOCK_ROWS = 16_384


def chi_square(x: float, freedom: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, freedom // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def chi_square_limit(chance: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, freedom) < chance else (low, mid)
    return high


@dataclass(frozen=True)
class Tree:
    """A complete kd-tree: ``axis`` and ``cut`` of the inner nodes in heap order, and the boxes of the leaves."""

    axis: np.ndarray
    cut: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def cells(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), dtype=np.int64)
        for _ in range(int(math.log2(len(self.low)))):
            right = points[np.arange(len(points)), self.axis[at]] >= self.cut[at]
            at = 2 * at + 1 + right
        return at - len(self.axis)

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Least squared distance of each point to each cell."""
        out = np.zeros((len(points), len(self.low)))
        for d in range(points.shape[1]):
            x = points[:, d : d + 1]
            gap = np.maximum(np.maximum(self.low[:, d] - x, x - self.high[:, d]), 0.0)
            out += gap * gap
        return out


def fit_tree(points: np.ndarray, leaves: int) -> Tree:
    """Median cuts along the widest axis."""
    dim = points.shape[1]
    inner = leaves - 1
    axis, cut = np.zeros(inner, dtype=np.int64), np.zeros(inner)
    low, high = np.full((leaves, dim), -np.inf), np.full((leaves, dim), np.inf)
    todo = [(0, points, low[0].copy(), high[0].copy())]
    while todo:
        node, own, lo, hi = todo.pop()
        if node >= inner:
            low[node - inner], high[node - inner] = lo, hi
            continue
        d = int(np.ptp(own, axis=0).argmax()) if len(own) else 0
        at = float(np.median(own[:, d])) if len(own) else 0.0
        axis[node], cut[node] = d, at
        right = own[:, d] >= at
        lo2, hi2 = lo.copy(), hi.copy()
        hi2[d] = lo2[d] = at
        todo += [(2 * node + 1, own[~right], lo, hi2), (2 * node + 2, own[right], lo2, hi)]
    return Tree(axis, cut, low, high)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


@dataclass(frozen=True)
class Projection:
    """Projection of vectors with their extra component, which makes all norms ``top``, and of stretched queries."""

    matrix: np.ndarray
    top: float

    def data(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.top**2 - (vectors * vectors).sum(axis=1), 0.0))
        return vectors @ self.matrix[:-1] + rest[:, None] * self.matrix[-1]

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors * (self.top / _lengths(vectors))[:, None]) @ self.matrix[:-1]


def gaussian(dim: int, projected: int) -> np.ndarray:
    """A Gaussian matrix. Its last row, along which the differences of all long and short vectors lie, has the
    expected length, so that one draw cannot put off the test for most queries alike."""
    matrix = np.random.default_rng(SEED).standard_normal((dim + 1, projected))
    matrix[-1] *= math.sqrt(projected) / np.linalg.norm(matrix[-1])
    return matrix


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def distance(score, length, top):
    """Squared distance between a stretched query and a vector on the sphere."""
    return np.maximum(2.0 * top * (top - score / length), 0.0)


class Best:
    """The best ``k`` of one query: largest score first, then smallest id."""

    def __init__(self, k: int, length: float, top: float, floor: float) -> None:
        self.k, self.length, self.top, self.floor = k, length, top, floor
        self.score, self.tie, self.row = np.zeros(0), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def add(self, score: np.ndarray, tie: np.ndarray, row: np.ndarray) -> None:
        score, tie, row = (np.r_[a, b] for a, b in ((self.score, score), (self.tie, tie), (self.row, row)))
        order = np.lexsort((tie, -score))[: self.k]
        self.score, self.tie, self.row = score[order], tie[order], row[order]

    def leave(self, floor: float) -> None:
        """Only what is not worse than the k-th of an earlier search."""
        kept = self.score >= floor
        self.score, self.tie, self.row = self.score[kept], self.tie[kept], self.row[kept]

    def distance(self) -> float:
        """Squared distance of the k-th best so far, by what this or an earlier search found."""
        kth = self.score[-1] if len(self.score) == self.k else -np.inf
        return distance(max(kth, self.floor), self.length, self.top)


def search_block(
    best: Best, query: np.ndarray, reach: np.ndarray, vectors: np.ndarray, ties: np.ndarray, rows: np.ndarray, limit: float
) -> None:
    """Verify projected neighbours of one query in order of ``reach`` (squared) until the stopping test holds."""
    order = np.argsort(reach)
    at, step = 0, 4 * best.k
    while at < len(order) and reach[order[at]] < limit * best.distance():
        next_ = order[at : at + step]
        best.add(vectors[next_] @ query, ties[next_], rows[next_])
        at, step = at + step, 2 * step


def usable(vector: Column) -> Column:
    """Neither null nor zero, all components present and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    projected: int = PROJECTED,
    confidence: float = CONFIDENCE,
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``queries`` selects, its ``k`` nearest found.

    A row is not its own neighbour: no candidate has the query's id. Fewer
    candidates than ``k`` are all returned. Ties go to the smaller id. Rows
    with a null id or an unusable vector take no part, nor do vectors whose
    length is not the most frequent one. A row that is repeated counts once;
    equal vectors with different ids all count, but are searched as one. An
    empty table gives an empty result.

    Memory of a task: ``block_rows`` vectors and one batch of queries. The tree
    and the boxes of at most ``MAX_SAMPLE / 16`` cells go to every task.
    """
    if projected % 2:
        raise ValueError("the projection needs an even number of dimensions")
    spark = vectors.sparkSession
    steps = Steps()
    valid = vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), queries.alias("q")
    )
    sizes = valid.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"))
    usual = sizes.orderBy(F.desc("rows"), F.desc("n")).first()
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = usual["n"]
    valid = valid.filter(F.size("v") == dim)
    # Of equal vectors the k + 1 smallest ids can be among the results. Spark cuts a group down before it is shuffled.
    alike = Window.partitionBy(F.xxhash64("v"), "v").orderBy("id")
    members = valid.select("id", "v").withColumn("_n", F.dense_rank().over(alike)).filter(F.col("_n") <= k + 1)
    distinct = members.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    distinct = steps.stage(distinct.withColumn("row", F.monotonically_increasing_id()), "vectors")
    count = distinct.count()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    top = float(distinct.agg(F.max(norm)).first()[0])
    projection = Projection(gaussian(dim, projected), top)
    share = min(1.0, MAX_SAMPLE / count)
    hashed = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = distinct.filter(hashed < share).select("v").limit(2 * MAX_SAMPLE).toArrow()
    points = projection.data(_matrix(sample.column("v").combine_chunks())) if sample.num_rows else np.zeros((0, projected))
    leaves = 1 << max(0, min(math.ceil(math.log2(max(1, count / cell_rows))), int(math.log2(MAX_SAMPLE / 16))))
    tree = fit_tree(points, leaves)
    limit = chi_square_limit(confidence, projected)
    def cell_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _matrix(b.column("v"))
            cells = tree.cells(projection.data(v)) if len(v) else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells), b.column("row"), b.column("tie"), b.column("v")], names=["cell", "row", "tie", "v"]
            )

    placed = distinct.select("row", F.col("ids")[0].alias("tie"), "v")
    placed = steps.stage(placed.mapInArrow(cell_of, "cell long, row long, tie long, v array<double>"), "cells")
    # A cell above the block size is cut by the row number, however uneven the cells are. At most a row per cell.
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("bigint").alias("cuts"))
    cuts = np.ones(leaves, dtype=np.int64)
    for cell in sizes.collect():
        cuts[cell["cell"]] = cell["cuts"]
    of_cell = F.broadcast(spark.createDataFrame([(i, int(n)) for i, n in enumerate(cuts)], "cell long, cuts long"))
    data = placed.join(of_cell, "cell").select(
        "cell", F.pmod("row", "cuts").alias("cut"), "row", "tie", "v", F.lit(None).cast("double").alias("floor"),
        F.lit(0).alias("kind"),
    )
    shape = "cell long, cut long, row long, tie long, v array<double>, floor double"
    asked = steps.stage(valid.filter("q").select("id", "v").distinct(), "asked")
    asked_rows = steps.stage(
        asked.withColumn("h", F.xxhash64("v")).join(
            distinct.select("row", F.col("v").alias("_v"), F.xxhash64("v").alias("h")), "h"
        ).filter(F.col("v") == F.col("_v")).select("id", "row"), "asked-rows",
    )
    searched = distinct.select("row", "v").join(asked_rows.select("row").distinct(), "row")

    def route(low: int, high: int):
        """Queries, with the k-th score so far, to those of their ``low``-th to ``high``-th cells that the test leaves."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, len(whole), _ROUTED):
                    b = whole.slice(at, _ROUTED)
                    v, floor = _matrix(b.column("v")), b.column("floor").to_numpy(zero_copy_only=False)
                    gaps = tree.distances(projection.queries(v))
                    chosen = np.argsort(gaps, axis=1, kind="stable")[:, low:high]
                    near = np.take_along_axis(gaps, chosen, axis=1) < limit * distance(floor, _lengths(v), top)[:, None]
                    q, place = np.nonzero(near | (low == 0))
                    cell = chosen[q, place]
                    times = cuts[cell]
                    cut = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    q, cell = np.repeat(q, times), np.repeat(cell, times)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell), pa.array(cut), *[b.column(c).take(pa.array(q)) for c in ("row", "tie", "v", "floor")]],
                        names=["cell", "cut", "row", "tie", "v", "floor"],
                    )

        return run

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a cell's block first, then the queries for it."""
        block, held, ready = None, [], None
        for b in batches:
            key = list(zip(b.column("cell").to_pylist(), b.column("cut").to_pylist(), b.column("kind").to_pylist(), strict=True))
            edges = [0, *[i for i in range(1, len(key)) if key[i] != key[i - 1]], len(key)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo == hi:
                    continue
                part = b.slice(lo, hi - lo)
                if key[lo][:2] != block:
                    block, held, ready = key[lo][:2], [], None
                v = _matrix(part.column("v"))
                row, tie = part.column("row").to_numpy(), part.column("tie").to_numpy()
                if key[lo][2] == 0:
                    held.append((v, tie, row))
                    continue
                if not held:
                    continue
                if ready is None:
                    all_v, ties, rows = (np.concatenate(x) for x in zip(*held, strict=True))
                    ready = (all_v, ties, rows, projection.data(all_v))
                all_v, ties, rows, points_ = ready
                floors = part.column("floor").to_numpy()
                out: list[tuple[np.ndarray, Best]] = []
                asked_points, lengths = projection.queries(v), _lengths(v)
                for i in range(len(v)):
                    best = Best(k + 1, float(lengths[i]), top, float(floors[i]))
                    gap = points_ - asked_points[i]
                    search_block(best, v[i], (gap * gap).sum(axis=1), all_v, ties, rows, limit)
                    best.leave(float(floors[i]))
                    out.append((row[i], best))
                yield pa.RecordBatch.from_pydict(
                    {
                        "asked": np.repeat([r for r, _ in out], [len(x.row) for _, x in out]).astype(np.int64),
                        "row": np.concatenate([x.row for _, x in out]),
                        "tie": np.concatenate([x.tie for _, x in out]),
                        "score": np.concatenate([x.score for _, x in out]),
                    }
                )

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(int(cuts.sum()), 100_000))

    def hits_of(routed: DataFrame) -> DataFrame:
        dealt = data.unionByName(routed.withColumn("kind", F.lit(1))).repartition(parts, "cell", "cut")
        dealt = dealt.sortWithinPartitions("cell", "cut", "kind").select("cell", "cut", "kind", "row", "tie", "v", "floor")
        return dealt.mapInArrow(search, "asked long, row long, tie long, score double")

    order = Window.partitionBy("asked").orderBy(F.desc("score"), "tie")
    chosen: DataFrame | None = None
    low, high = 0, 1
    while low < leaves:
        # The k-th score of each round bounds what the next one hands on: some hits per query, however many cells.
        floor = F.lit(float("-inf"))
        if chosen is None:
            known = searched.withColumn("floor", floor)
        else:
            floors = chosen.filter(F.col("n") == k + 1).select(F.col("asked").alias("row"), F.col("score").alias("floor"))
            known = searched.join(floors, "row", "left").withColumn("floor", F.coalesce("floor", floor))
        routed = known.select("row", F.lit(0).cast("bigint").alias("tie"), "v", "floor").mapInArrow(route(low, high), shape)
        if routed.isEmpty():  # cells further away are ruled out as well
            break
        hits = hits_of(routed)
        hits = hits if chosen is None else hits.unionByName(chosen.drop("n"))
        chosen = steps.stage(hits.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1), "hits")
        low, high = high, min(leaves, high * GROWTH)
    if chosen is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    ids = chosen.join(distinct.select("row", "ids"), "row").select("asked", "score", F.explode("ids").alias("vec_id"))
    by_id = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    ranked = ids.withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1)
    listed = ranked.groupBy("asked").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("hits"))
    own = asked_rows.join(listed, asked_rows["row"] == listed["asked"])
    others = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("id")), 1, k)
    out = stage(
        own.select(F.col("id").alias("query_id"), F.posexplode(others).alias("p", "h")).select(
            "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("h.vec_id").alias("vec_id"), F.col("h.score").alias("score")
        ),
        "neighbours",
    )
    steps.release()
    return out


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
