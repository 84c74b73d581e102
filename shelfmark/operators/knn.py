"""Exact top-k similarity search for many queries at once.

Scores are matrix products over Arrow batches. Each task keeps only its best
``k`` rows per query, so what leaves a task does not depend on how many corpus
rows it read; pairs are never materialised as rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.vectors import METRICS, resolve_metric
from shelfmark.operators.blocks import Blocks, learn_centres, nearest, spread, unit
from shelfmark.operators.joins import skew_join
from shelfmark.session import Steps, stage

# Queries go to every task only below both bounds; above, they go in blocks.
MAX_SHARED_QUERIES = 16_384
MAX_SHARED_BYTES = 128 << 20
# Beyond them: vectors that blocks are learned from, blocks, and rows per block, about.
BLOCK_SAMPLE = 16_384
MAX_BLOCKS = 2_048
BLOCK_ROWS = 2_048
# Rows of blocks that a task holds, their bytes, and queries that one copy of them serves, about.
PIECE_ROWS = 262_144
PIECE_BYTES = 128 << 20
GROUP_QUERIES = 131_072
# Fewer queries a copy, as far as it takes to get this many tasks.
TASKS = 64
MAX_TASKS = 4_096
_LEAST_QUERIES = 4_096

SCORE_DIGITS = 6
_QUERY_STEP = 512
_PAIR_STEP = 500_000
# Pairs whose vectors are side by side at a time, so that they stay in the processor's cache.
_COST_STEP = 2_048
# Of the queries scored together, one in so many says in which order the blocks come.
_ORDER_STEP = 8
_ROUTE_STEP = 8_192
_ROW_STEP = 8_192
_TAXI_STEP = 1_024
# Taxicab codes: levels of a component, components that add up to less than 256, most components, and rows and queries at a time.
_LEVELS = 64
_LANES = 4
_CODED_DIM = 512
_CODED_ROWS = 256
_CODED_QUERIES = 32
# Most of the mean distance to the centre that the rounding of codes may take up.
_CODED_LOSS = 0.1
# Squared norms up to here are worked with in single precision.
_NARROW = 1e12
_MERGE_SALTS = 32
# Pieces whose hits of a query may meet in one task.
_FEW_PIECES = 256


@dataclass(frozen=True)
class Found:
    """Search result, with the bound on its rows when it is known.

    ``compared`` counts the (query, row) pairs that were scored, where bounds chose them.
    """

    hits: DataFrame
    max_rows: int | None
    compared: int | None = None


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if n == 0:
        return np.zeros((0, 0))
    if column.null_count or len(values) % n:
        raise ValueError("vectors must be present and of one size")
    return values.reshape(n, -1)


def _labels(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()
    return np.asarray(column.to_pylist(), dtype=str)


def _rounded_up(limit: np.ndarray, kind: np.dtype) -> np.ndarray:
    if kind == np.float64:
        return limit
    with np.errstate(over="ignore"):
        return np.nextafter(limit.astype(kind), kind.type(np.inf))


def _places(near: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` of a matrix with few true values, eight at a time."""
    flat = near.reshape(-1)
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64))
    if len(words) > whole // 64:
        return np.flatnonzero(flat)
    found = (words[:, None] * 8 + np.arange(8)).reshape(-1)
    return np.concatenate([found[flat[found]], whole + np.flatnonzero(flat[whole:])])


class Grid:
    """Components of vectors as levels of one step, so that taxicab distances can be bounded from below in bytes.

    A component beyond the last level is taken to be there, which makes
    distances smaller at most. What rounding to a level takes away is known for
    each vector: ``off``, in steps.
    """

    def __init__(self, low: np.ndarray, step: float) -> None:
        self.low = low
        self.step = step

    @staticmethod
    def of(rows: np.ndarray) -> Grid | None:
        """The grid of some rows; None if levels would tell little about their distances."""
        if not len(rows) or not 0 < rows.shape[1] <= _CODED_DIM:
            return None
        centre = rows.mean(axis=0)
        step = 6.0 * rows.std(axis=0).max() / (_LEVELS - 1)
        # Not for infinite values, nor where a step is near to the precision of the values.
        if not np.isfinite(step) or not step > 1e-9 * (1e-200 + np.abs(rows).max()):
            return None
        grid = Grid(centre - _LEVELS // 2 * step, step)
        if grid.code(rows)[2].mean() > _CODED_LOSS * np.abs(rows - centre).sum(axis=1).mean() / step:
            return None
        return grid

    def code(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Levels, their sums, and ``off`` of each vector. Levels are filled up to whole lanes of pairs."""
        with np.errstate(invalid="ignore", over="ignore"):
            at = np.clip((vectors - self.low) / self.step, 0, _LEVELS - 1)
            levels = np.rint(at)
            off = np.abs(at - levels).sum(axis=1)
            width = -(-vectors.shape[1] // (2 * _LANES)) * 2 * _LANES
            codes = np.zeros((len(vectors), width), np.uint8)
            codes[:, : vectors.shape[1]] = levels
        return codes, codes.sum(axis=1, dtype=np.int64), off


class Codes:
    """Rows by their levels, in pieces that stay in the processor's cache."""

    def __init__(self, grid: Grid, rows: np.ndarray) -> None:
        self.grid = grid
        codes, total, off = grid.code(rows)
        self.n = len(rows)
        pieces = -(-self.n // _CODED_ROWS)
        filled = np.zeros((pieces * _CODED_ROWS, codes.shape[1]), np.uint8)
        filled[: self.n] = codes
        # By pairs of components, the two of a pair side by side: (piece, pair, row, 2).
        self.pieces = np.ascontiguousarray(filled.reshape(pieces, _CODED_ROWS, -1, 2).transpose(0, 2, 1, 3))
        self.half = np.ceil((total + off) / 2).astype(np.int16)

    def larger(self, asked: np.ndarray) -> np.ndarray:
        """Sums of the larger level of each component (queries, rows), less half of the row's sum and what it is off."""
        pairs = asked.shape[1] // 2
        found = np.empty((len(asked), len(self.pieces) * _CODED_ROWS), np.int16)
        for start in range(0, len(asked), _CODED_QUERIES):
            some = np.ascontiguousarray(asked[start : start + _CODED_QUERIES])
            n = len(some)
            query = np.empty((n, pairs, _CODED_ROWS, 2), np.uint8)
            query.view(np.uint16)[..., 0] = some.view(np.uint16)[:, :, None]
            most = np.empty_like(query)
            few = np.empty((n, pairs // _LANES, _CODED_ROWS, 2), np.uint8)
            words = few.view(np.uint16)[..., 0]
            high = np.empty_like(words)
            for i, piece in enumerate(self.pieces):
                np.maximum(query, piece, out=most)
                np.add.reduce(most.reshape(n, _LANES, -1), axis=1, dtype=np.uint8, out=few.reshape(n, -1))
                np.right_shift(words, 8, out=high)
                np.bitwise_and(words, 255, out=words)
                np.add(words, high, out=high)
                place = found[start : start + n, i * _CODED_ROWS : (i + 1) * _CODED_ROWS]
                np.add.reduce(high, axis=1, dtype=np.uint16, out=place.view(np.uint16))
        return np.subtract(found[:, : self.n], self.half)


class Part:
    """Corpus rows made ready to be scored by any number of queries."""

    def __init__(self, ids: np.ndarray, corpus: np.ndarray, metric: str) -> None:
        self.ids = ids
        self.corpus = unit(corpus) if metric == "COSINE" else corpus
        squares = (self.corpus * self.corpus).sum(axis=1)
        self.largest = squares.max(initial=0.0)
        # Single precision sorts out; what is left is scored in double precision.
        self.kind = np.float32 if self.largest < _NARROW else np.float64
        grid = Grid.of(self.corpus) if metric == "MANHATTAN" else None
        self.codes = None if grid is None else Codes(grid, self.corpus)
        if self.codes is not None:
            return
        if metric == "EUCLID":
            side = np.column_stack([self.corpus, squares, np.ones(len(squares))])
        else:
            side = self.corpus
        # By component for MANHATTAN, so that sums run along rows.
        self.side = np.ascontiguousarray(side.T if metric == "MANHATTAN" else side, dtype=self.kind)


class Scorer:
    """Costs (smaller is better) of corpus rows for a block of queries under one metric."""

    def __init__(self, metric: str, queries: np.ndarray) -> None:
        self.metric = metric
        self.queries = unit(queries) if metric == "COSINE" else queries
        self.sign = -1.0 if METRICS[metric] else 1.0
        self.squares = (self.queries * self.queries).sum(axis=1)
        if metric == "EUCLID":
            side = np.column_stack([-2.0 * self.queries, np.ones(len(queries)), self.squares])
        else:
            side = self.queries if metric == "MANHATTAN" else -self.queries
        narrow = self.squares.max(initial=0.0) < _NARROW
        self.sides = {np.float64: side, np.float32: side.astype(np.float32) if narrow else None}

    def near(self, part: Part, asked: np.ndarray, worst: np.ndarray, k: int) -> np.ndarray:
        """Which rows may be among the best ``k`` of the ``asked`` queries and no worse than ``worst``: (queries, rows)."""
        if part.codes is not None:
            return self._near_codes(part, asked, worst, k)
        rough = self.rough(part, None if len(asked) == len(self.queries) else asked)
        limit = self.rough_limit(worst, part)[asked]
        near = rough <= _rounded_up(limit, rough.dtype)[:, None]
        if len(part.ids) > k and np.count_nonzero(near) > 4 * k * len(asked):
            # Many rows would do so far: nothing worse than the batch's own k-th row can survive.
            kth = np.partition(rough, k - 1, axis=1)[:, k - 1].astype(np.float64)
            near &= rough <= _rounded_up(self.kth_limit(kth, part, asked), rough.dtype)[:, None]
        return near

    def _near_codes(self, part: Part, asked: np.ndarray, worst: np.ndarray, k: int) -> np.ndarray:
        codes = part.codes
        levels, total, off = codes.grid.code(self.queries[asked])
        larger = codes.larger(levels)

        def reached(cost: np.ndarray) -> np.ndarray:
            # |a - b| = 2 max(a, b) - a - b, and the distance is that many steps less what both are off, at least.
            most = (cost + 2 * 10.0**-SCORE_DIGITS) / codes.grid.step + total + off + 1e-3
            most = np.clip(np.floor(most / 2), -32_768, 32_767)
            return larger <= np.nan_to_num(most, nan=-32_768).astype(np.int16)[:, None]

        near = reached(worst[asked])
        if codes.n > k and np.count_nonzero(near) > 4 * k * len(asked):
            # Many rows would do so far: none that is worse than k rows of this part can survive.
            best = np.argpartition(larger, k - 1, axis=1)[:, :k]
            near &= reached(self.exact_pairs(part, np.repeat(asked, k), best.reshape(-1)).reshape(-1, k).max(axis=1))
        return near

    def kind(self, part: Part) -> type:
        return part.kind if self.sides[part.kind] is not None else np.float64

    def rough(self, part: Part, some: np.ndarray | None = None) -> np.ndarray:
        """One row per query; in the order of the exact costs up to ``slack``. Squared for EUCLID."""
        kind = self.kind(part)
        asked, rows = self.sides[kind], part.side.astype(kind, copy=False)
        if some is not None:
            asked = asked[some]
        if self.metric != "MANHATTAN":
            return asked @ rows.T
        found = np.empty((len(asked), rows.shape[1]), kind)
        for at in range(0, rows.shape[1], _TAXI_STEP):
            piece = np.ascontiguousarray(rows[:, at : at + _TAXI_STEP])
            larger, twice = np.empty_like(piece), np.full(len(piece), 2, kind)
            # |a - b| = 2 max(a, b) - a - b
            for i, q in enumerate(asked[:, :, None]):
                np.maximum(piece, q, out=larger)
                found[i, at : at + _TAXI_STEP] = twice @ larger
        found -= asked.sum(axis=1)[:, None]
        found -= rows.sum(axis=0)
        return found

    def slack(self, part: Part) -> np.ndarray:
        """Most that a rough cost of each query is off."""
        size = 1.0 + self.squares + part.largest
        if self.kind(part) is np.float64:
            return 1e-9 * size
        dim = self.queries.shape[1]
        return 2.6e-7 * (dim + 4) * (np.sqrt(dim) if self.metric == "MANHATTAN" else 1.0) * size

    def rough_limit(self, cost: np.ndarray, part: Part) -> np.ndarray:
        """Bound on rough costs that no row with an exact cost up to ``cost`` exceeds."""
        limit = cost + 2 * 10.0**-SCORE_DIGITS
        return (limit * limit if self.metric == "EUCLID" else limit) + self.slack(part)

    def kth_limit(self, rough: np.ndarray, part: Part, some: np.ndarray) -> np.ndarray:
        """Bound on the rough costs of rows as good as one that has this rough cost."""
        slack = self.slack(part)[some]
        most = rough + slack
        if self.metric == "EUCLID":
            return (np.sqrt(np.maximum(most, 0.0)) + 2 * 10.0**-SCORE_DIGITS) ** 2 + slack
        return most + 2 * 10.0**-SCORE_DIGITS + slack

    def exact_pairs(self, part: Part, query: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Rounded costs of (query number, row number) pairs, few vectors at a time."""
        steps = range(0, len(row), _COST_STEP)
        costs = [self.exact(part.corpus[row[at : at + _COST_STEP]], query[at : at + _COST_STEP]) for at in steps]
        return np.concatenate(costs) if costs else np.zeros(0)

    def exact(self, corpus: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Rounded costs of (corpus row, query number) pairs."""
        asked = self.queries[query]
        if self.metric == "MANHATTAN":
            cost = np.abs(corpus - asked).sum(axis=1)
        elif self.metric == "EUCLID":
            gap = corpus - asked
            cost = np.sqrt((gap * gap).sum(axis=1))
        else:
            cost = -(corpus * asked).sum(axis=1)
        return np.round(cost, SCORE_DIGITS) + 0.0


class BestK:
    """The best ``k`` rows seen so far for each of a block of queries; ties go to the smaller id."""

    def __init__(self, queries: np.ndarray, k: int, metric: str) -> None:
        self.k = k
        self.scorer = Scorer(metric, queries)
        self.worst = np.full(len(queries), np.inf)
        self.query = np.zeros(0, dtype=np.int64)
        self.cost = np.zeros(0)
        self.id: np.ndarray | None = None
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def add(self, part: Part, some: np.ndarray | None = None, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> None:
        """Rows for all queries or ``some`` of them; ``wanted`` tells which pairs (query, row) count here."""
        asked = np.arange(len(self.worst)) if some is None else some
        near = self.scorer.near(part, asked, self.worst, self.k)
        query, row = np.divmod(_places(near), near.shape[1])
        query = asked[query]
        if wanted is not None and len(row):
            good = wanted(query, row)
            query, row = query[good], row[good]
        self._pairs(part, query, row)

    def add_pairs(self, part: Part, query: np.ndarray, row: np.ndarray) -> None:
        """The same for chosen pairs (query, row) only; no pair may come twice."""
        self._pairs(part, query, row)

    def _pairs(self, part: Part, query: np.ndarray, row: np.ndarray) -> None:
        # Pairs go through in steps, so that very many ties do not blow up memory.
        for at in range(0, len(row), _PAIR_STEP):
            q, r = query[at : at + _PAIR_STEP], row[at : at + _PAIR_STEP]
            cost = self.scorer.exact_pairs(part, q, r)
            good = cost <= self.worst[q]
            self.waiting.append((q[good], part.ids[r[good]], cost[good]))
            self.n_waiting += len(self.waiting[-1][0])
            # A merge sorts all that is held, so it waits for as many.
            if self.n_waiting > self.k * len(self.worst) or not np.isfinite(self.worst).all():
                self._settle()

    def _settle(self) -> None:
        if self.n_waiting:
            self._merge(*map(np.concatenate, zip(*self.waiting)))
        self.waiting, self.n_waiting = [], 0

    def _merge(self, query: np.ndarray, ids: np.ndarray, cost: np.ndarray) -> None:
        query = np.concatenate([self.query, query])
        cost = np.concatenate([self.cost, cost])
        ids = ids if self.id is None else np.concatenate([self.id, ids])
        order = np.lexsort((ids, cost, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        kept = order[rank < self.k]
        self.query, self.cost, self.id = query[rank < self.k], cost[kept], ids[kept]
        full = np.nonzero(np.bincount(self.query, minlength=len(self.worst)) == self.k)[0]
        # A bound that was known before may be the better one.
        self.worst[full] = np.minimum(self.worst[full], self.cost[np.searchsorted(self.query, full, side="right") - 1])

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self._settle()
        ids = np.zeros(0, dtype=np.int64) if self.id is None else self.id
        return self.query, ids, self.scorer.sign * self.cost + 0.0


def _best_of(
    corpus_batches: Iterator[tuple[np.ndarray, np.ndarray]],
    query_ids: np.ndarray,
    query_vectors: np.ndarray,
    k: int,
    metric: str,
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    steps = range(0, len(query_ids), _QUERY_STEP)
    best = [BestK(query_vectors[at : at + _QUERY_STEP], k, metric) for at in steps]
    for ids, vectors in corpus_batches:
        if len(ids):
            part = Part(ids, vectors, metric)
            for keeper in best:
                keeper.add(part)
    found = []
    for at, keeper in zip(steps, best):
        query, ids, scores = keeper.result()
        found.append((query_ids[at : at + _QUERY_STEP][query], ids, scores))
    return found


def _hit_schema(corpus: DataFrame, queries: DataFrame, id_col: str, query_col: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(query_col, queries.schema[query_col].dataType),
            T.StructField(id_col, corpus.schema[id_col].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _column(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(values if values.dtype.kind in "iU" else values.tolist(), type=kind)


def _hit_batches(found, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for query, ids, scores in found:
        if len(ids):
            arrays = [_column(query, schema.field(0).type), _column(ids, schema.field(1).type), pa.array(scores, type=pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}
    return pa.schema([pa.field(f.name, kinds[f.dataType.simpleString()]) for f in schema.fields])


def keep_best(hits: DataFrame, k: int, metric: str, id_col: str, query_col: str, few: bool = False) -> DataFrame:
    """The best ``k`` hits per query with ``rank`` from 1.

    In two rounds, so that the candidates of one query from very many tasks do
    not meet in one task at first; in one if there are ``few`` of each query.
    """
    better = F.col("score").desc() if METRICS[metric] else F.col("score").asc()
    if few:
        final = Window.partitionBy(query_col).orderBy(better, F.col(id_col))
        return hits.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
    salted = hits.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(_MERGE_SALTS)))
    first = Window.partitionBy(query_col, "_salt").orderBy(better, F.col(id_col))
    final = Window.partitionBy(query_col).orderBy(better, F.col(id_col))
    some = salted.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k).drop("rank", "_salt")
    return some.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)


def top_k(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 30,
    metric: str = "COSINE",
    *,
    id_col: str = "id",
    query_col: str = "query_id",
    vector_col: str = "vector",
    max_shared_queries: int = MAX_SHARED_QUERIES,
) -> Found:
    """``query_col, id_col, score, rank`` of the ``k`` best corpus rows for every query.

    Both inputs carry ``vector_col``; ids are unique. Equal scores are ranked by id.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    metric = resolve_metric(metric)
    corpus = corpus.select(id_col, vector_col)
    queries = queries.select(query_col, vector_col)
    schema = _hit_schema(corpus, queries, id_col, query_col)
    shared = queries.limit(max_shared_queries + 1).toArrow()
    if shared.num_rows <= max_shared_queries and shared.nbytes <= MAX_SHARED_BYTES:
        hits = _shared_queries(corpus, shared, k, metric, schema)
        max_rows = shared.num_rows * k
    else:
        hits, compared, few = _blocked(corpus, queries, k, metric, schema)
        return Found(keep_best(hits, k, metric, id_col, query_col, few), None, compared)
    return Found(keep_best(hits, k, metric, id_col, query_col), max_rows)


def _shared_queries(corpus: DataFrame, shared: pa.Table, k: int, metric: str, schema: T.StructType) -> DataFrame:
    if shared.num_rows == 0:
        return corpus.sparkSession.createDataFrame([], schema)
    value = (_labels(shared.column(0)), _matrix(shared.column(1)))
    sent = corpus.sparkSession.sparkContext.broadcast(value)
    arrow_schema = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, query_vectors = sent.value
        rows = ((_labels(b.column(0)), _matrix(b.column(1))) for b in batches)
        yield from _hit_batches(_best_of(rows, query_ids, query_vectors, k, metric), arrow_schema)

    return corpus.mapInArrow(run, schema)


def _blocked(corpus: DataFrame, queries: DataFrame, k: int, metric: str, schema: T.StructType) -> tuple[DataFrame, int, bool]:
    """Any number of queries: dealt to those blocks of the corpus that their bounds do not rule out.

    The corpus goes into blocks around centres learned from a sample, and every
    block's radius and largest norm are measured on all of its rows. Queries
    visit the blocks that come first for them; what they find there bounds
    their k-th cost, and only blocks that may go below it are visited then.
    Only the sample and one row per block pass through the driver.
    """
    session = corpus.sparkSession
    steps = Steps()
    blocks, dealt = _deal(corpus, metric, steps)
    if blocks is None:
        return session.createDataFrame([], schema), 0, True
    # A query has up to k hits of each piece.
    few = int(Shelves.of_blocks(blocks).pieces.sum()) <= _FEW_PIECES
    query_col, id_col = schema.names[:2]
    asked = steps.stage(queries.toDF(query_col, "vector"), "queries").withColumn("worst", F.lit(float("inf")))
    found, compared = _visit(dealt, asked, blocks, k, False, schema)
    best = steps.stage(keep_best(found, k, metric, id_col, query_col, few), "best")
    sign = -1.0 if METRICS[metric] else 1.0
    reached = best.filter(F.col("rank") == k).select(query_col, (F.col("score") * sign).alias("worst"))
    bounded = asked.drop("worst").join(reached, query_col)
    rest, more = _visit(dealt, steps.stage(bounded, "bounded"), blocks, k, True, schema)
    hits = stage(best.drop("rank").unionByName(rest), "hits")
    steps.release()
    return hits, compared + more, few


def _deal(corpus: DataFrame, metric: str, steps: Steps) -> tuple[Blocks | None, DataFrame]:
    """The blocks, and the corpus as ``block, piece, id, vector``: a piece is what one task holds at a time."""
    id_col, vector_col = corpus.columns
    n = corpus.count()
    if n == 0:
        return None, corpus
    # By a hash of the id, so that a run that is repeated learns the same.
    share = F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = corpus.filter(share < BLOCK_SAMPLE / n).select(vector_col).limit(2 * BLOCK_SAMPLE).toArrow()
    if sample.num_rows == 0:
        sample = corpus.select(vector_col).limit(1).toArrow()
    rows = _prepared(_matrix(sample.column(0)), metric)
    centres = learn_centres(rows, max(1, min(MAX_BLOCKS, n // BLOCK_ROWS)))
    sent = corpus.sparkSession.sparkContext.broadcast(centres)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = _prepared(_matrix(batch.column(1)), metric)
                of = nearest(vectors, sent.value)
                sizes = np.linalg.norm(vectors, axis=1), spread(metric, vectors, sent.value, of)
                columns = [pa.array(of.astype(np.int32)), batch.column(0), batch.column(1), *map(pa.array, sizes)]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "id", "vector", "norm", "away"])

    kinds = [corpus.schema[c].dataType.simpleString() for c in corpus.columns]
    schema = f"block int, id {kinds[0]}, vector {kinds[1]}, norm double, away double"
    made = steps.stage(corpus.mapInArrow(deal, schema), "dealt")
    per_block = made.groupBy("block").agg(F.count("*").alias("n"), F.max("away").alias("radius"), F.max("norm").alias("norm"))
    held, radius, norm = np.zeros(len(centres), np.int64), np.zeros(len(centres)), np.zeros(len(centres))
    for r in per_block.collect():
        held[r["block"]], radius[r["block"]], norm[r["block"]] = r["n"], r["radius"], r["norm"]
    return Blocks(metric, centres, held, radius, norm), made.select("block", "id", "vector")


@dataclass(frozen=True)
class Shelves:
    """Blocks that are held together: a query is sent to a shelf once, whichever of its blocks it visits.

    ``order`` are the blocks by shelf, ``start`` where a shelf begins there, and
    ``of`` and ``place`` the shelf of a block and its place within. A block with
    very many rows, such as one of equal vectors, is a shelf of several pieces.
    """

    order: np.ndarray
    start: np.ndarray
    of: np.ndarray
    place: np.ndarray
    pieces: np.ndarray

    @staticmethod
    def of_blocks(blocks: Blocks) -> Shelves:
        most = max(1, min(PIECE_ROWS, PIECE_BYTES // (8 * max(1, blocks.centres.shape[1]))))
        # Near blocks stand together: in the order of their main direction.
        gap = blocks.centres - blocks.centres.mean(axis=0)
        order = np.argsort(gap @ np.linalg.eigh(gap.T @ gap)[1][:, -1], kind="stable")
        of, place = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        shelf, held, n = 0, 0, 0
        for b in order:
            if n and held + blocks.rows[b] > most:
                shelf, held, n = shelf + 1, 0, 0
            of[b], place[b] = shelf, n
            held, n = held + blocks.rows[b], n + 1
        rows = np.bincount(of, blocks.rows, shelf + 1)
        return Shelves(order, np.flatnonzero(np.r_[True, np.diff(of[order]) > 0]), of, place, np.maximum(1, -(-rows // most)).astype(np.int64))

    def visited(self, go: np.ndarray) -> np.ndarray:
        """(queries, shelves) out of (queries, blocks)."""
        return np.logical_or.reduceat(go[:, self.order], self.start, axis=1)


def _prepared(vectors: np.ndarray, metric: str) -> np.ndarray:
    return unit(vectors) if metric == "COSINE" else vectors


def _visit(dealt: DataFrame, asked: DataFrame, blocks: Blocks, k: int, later: bool, schema: T.StructType) -> tuple[DataFrame, int]:
    """Hits of the queries (id, vector, worst) in the blocks they visit first, or later on, and the pairs scored for it.

    Shelves and the queries sent to them meet by a shuffle, a query once per
    shelf. A task holds one piece, and the queries stream by; a shelf that very
    many queries ask has copies for groups of them.
    """
    query_col, id_col = schema.names[:2]
    sent = asked.sparkSession.sparkContext.broadcast(blocks)
    metric = blocks.metric
    shelves = Shelves.of_blocks(blocks)
    n_blocks, n_shelves = len(blocks.rows), len(shelves.pieces)
    arrow_schema = _arrow_schema(schema)
    id_kind, query_kind = schema[id_col].dataType, schema[query_col].dataType

    def routes(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        for at in range(0, batch.num_rows, _QUERY_STEP):
            part = batch.slice(at, _QUERY_STEP)
            vectors = _prepared(_matrix(part.column(1)), metric)
            known = sent.value
            go = known.rest(vectors, k, part.column(2).to_numpy()) if later else known.first(vectors, k)
            yield part, go

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_blocks + n_shelves, np.int64)
        for batch in batches:
            for _, go in routes(batch):
                total += np.r_[go.sum(axis=0), shelves.visited(go).sum(axis=0)]
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["at", "n"])

    counted = np.zeros(n_blocks + n_shelves, np.int64)
    for r in asked.mapInArrow(count, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect():
        counted[r["at"]] = r["n"]
    visits, calls = counted[:n_blocks], counted[n_blocks:]
    if not visits.any():
        return asked.sparkSession.createDataFrame([], schema), 0

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, go in routes(batch):
                query, shelf = np.nonzero(shelves.visited(go))
                ends = np.r_[shelves.start[1:], n_blocks]
                for at in range(0, len(query), _ROUTE_STEP):
                    q, s = query[at : at + _ROUTE_STEP], shelf[at : at + _ROUTE_STEP]
                    # The blocks of the shelf that the query visits, a bit each.
                    bits = [np.packbits(go[i, shelves.order[shelves.start[j] : ends[j]]]).tobytes() for i, j in zip(q, s)]
                    columns = [pa.array(s.astype(np.int32)), pa.array(bits, pa.binary()), *(c.take(pa.array(q)) for c in part.columns)]
                    yield pa.RecordBatch.from_arrays(columns, names=["shelf", "bits", "query", "vector", "worst"])

    # Vectors of single precision are moved as such.
    both = {dealt.schema["vector"].dataType.simpleString(), asked.schema["vector"].dataType.simpleString()}
    vector_kind = "array<float>" if both == {"array<float>"} else "array<double>"
    routed = asked.select(query_col, F.col("vector").cast(vector_kind), "worst").mapInArrow(
        route, f"shelf int, bits binary, query {query_kind.simpleString()}, vector {vector_kind}, worst double"
    )
    copies = [_copies(int(n), int(shelves.pieces.sum())) for n in calls]
    of_shelf = lambda values, at: F.lit([int(v) for v in values])[at]
    groups, pieces = of_shelf(copies, F.col("shelf")), of_shelf(shelves.pieces, F.col("shelf"))
    queries = routed.select(
        "shelf", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"),
        F.pmod(F.xxhash64("query"), groups).cast("int").alias("group"), F.lit(1).alias("kind"),
        F.lit(None).cast("int").alias("place"), F.lit(None).cast(id_kind).alias("id"), "bits", "query", "vector", "worst",
    )
    wanted = F.lit([bool(v) for v in visits])[F.col("block")]
    held = dealt.filter(wanted).withColumn("shelf", of_shelf(shelves.of, F.col("block"))).select(
        "shelf", F.pmod(F.xxhash64("id"), pieces).cast("int").alias("piece"),
        F.explode(F.sequence(F.lit(0), groups - 1)).alias("group"), F.lit(0).alias("kind"),
        of_shelf(shelves.place, F.col("block")).alias("place"), "id", F.lit(None).cast("binary").alias("bits"),
        F.lit(None).cast(query_kind).alias("query"), F.col("vector").cast(vector_kind), F.lit(None).cast("double").alias("worst"),
    )
    key = ["shelf", "piece", "group"]
    # A task per key, as far as that goes; the rows of a piece come first, so that they are held when its queries come by,
    # and queries of the same blocks follow each other, so that they are scored together.
    keys_before = np.cumsum(np.r_[0, shelves.pieces * copies])
    task = of_shelf(keys_before[:-1], F.col("shelf")) + F.col("piece") * of_shelf(copies, F.col("shelf")) + F.col("group")
    tasks = int(min(keys_before[-1], MAX_TASKS))
    dealt_out = held.unionByName(queries).withColumn("task", F.pmod(task, F.lit(tasks)).cast("int"))
    together = dealt_out.repartitionById(tasks, "task").drop("task").sortWithinPartitions(*key, "kind", "place", "bits")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, held = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            edges = np.r_[0, np.nonzero((keys[1:] != keys[:-1]).any(axis=1))[0] + 1, len(keys)]
            for start, stop in zip(edges[:-1], edges[1:]):
                part, at = batch.slice(start, stop - start), tuple(keys[start])
                if at[:3] != current:
                    current, parts, held = at[:3], [], None
                if at[3] == 0:
                    parts.append((_labels(part.column(5)), _matrix(part.column(8)), part.column(4).to_numpy()))
                    continue
                if not parts and held is None:
                    continue  # by chance no row of the shelf fell into this piece
                if held is None:
                    held, parts = list(_by_place(parts, metric)), []
                for first in range(0, part.num_rows, _QUERY_STEP):
                    some = part.slice(first, _QUERY_STEP)
                    asked = _matrix(some.column(8))
                    keeper = BestK(asked, k, metric)
                    keeper.worst = some.column(9).to_numpy().copy()
                    bits = np.frombuffer(b"".join(some.column(6).to_pylist()), np.uint8).reshape(some.num_rows, -1)
                    go = np.unpackbits(bits, axis=1).astype(bool)
                    # What is near to most of them comes first, so that less of the rest is as good.
                    bounds = sent.value.bounds(_prepared(asked[::_ORDER_STEP], metric)).mean(axis=0)[shelves.order[shelves.start[at[0]] :]]
                    for place, rows in sorted(held, key=lambda one: bounds[one[0]]):
                        asking = np.flatnonzero(go[:, place])
                        if len(asking):
                            keeper.add(rows, None if len(asking) == len(go) else asking)
                    query, ids, scores = keeper.result()
                    yield from _hit_batches([(_labels(some.column(7))[query], ids, scores)], arrow_schema)

    return together.mapInArrow(meet, schema), int((visits * blocks.rows).sum())


def _copies(queries: int, pieces: int) -> int:
    """Copies of the pieces of a shelf, each for a group of its queries: few, but enough for some tasks."""
    for_tasks = min(-(-TASKS // pieces), queries // _LEAST_QUERIES)
    return max(1, -(-queries // GROUP_QUERIES), for_tasks)


def _by_place(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], metric: str) -> Iterator[tuple[int, Part]]:
    """The rows of each block in steps; they come in the order of the blocks."""
    ids, vectors, place = map(np.concatenate, zip(*parts))
    edges = np.r_[0, np.flatnonzero(place[1:] != place[:-1]) + 1, len(place)]
    for start, stop in zip(edges[:-1], edges[1:]):
        for at in range(start, stop, _ROW_STEP):
            rows = slice(at, min(at + _ROW_STEP, stop))
            yield int(place[start]), Part(ids[rows], vectors[rows], metric)


def with_payload(found: Found, corpus: DataFrame, id_col: str = "id", broadcast_rows: int = 500_000) -> DataFrame:
    """Hits joined with the corpus columns of their ids.

    Hits are a few numbers each; when their count is known to be small they
    are sent to the corpus, which is then read without being shuffled. Else
    they are written out, and rows that very many queries found are joined
    apart from the others.
    """
    if found.max_rows is not None and found.max_rows <= broadcast_rows:
        return corpus.join(F.broadcast(found.hits), id_col)
    return skew_join(stage(found.hits, "hits"), corpus, [id_col], ["score"])
