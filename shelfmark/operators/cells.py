"""Coarse cells and product-quantised residuals of vectors.

A vector belongs to the cell of its nearest centre; what is left of it is cut
into parts, and each part is coded by its nearest of up to 256 codewords. Costs
of coded vectors are sums out of a small table per query. Everything here is of
bounded size: it is learned from a sample and goes to every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("COSINE", "DOT", "EUCLID")

# Sampled vectors that cells, codewords and the number of probes are learned from, at most.
MAX_SAMPLE = 65_536
MAX_CELLS = 16_384
# Sampled vectors per cell, so that a cell's centre is known well enough.
PER_CELL = 32
CODEWORDS = 256
# Dimensions that share a byte of the code.
PART = 4
# Of the sample, what the codewords are learned from, and the queries and neighbours that probes are measured with.
_CODED, _ASKED, _NEIGHBOURS = 16_384, 256, 10
_ROUNDS = 8
_STEP = 4_096


@dataclass(frozen=True)
class Quantizer:
    """``centres`` (cells, dim) and ``words`` (parts, codewords, dim of a part); ``probes`` is measured."""

    metric: str
    centres: np.ndarray
    words: np.ndarray
    probes: int

    @property
    def dim(self) -> int:
        return self.centres.shape[1]

    def prepare(self, vectors: np.ndarray) -> np.ndarray:
        if self.metric != "COSINE":
            return vectors
        lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.divide(vectors, lengths, out=np.zeros_like(vectors), where=lengths > 0)

    def _parts(self, vectors: np.ndarray) -> np.ndarray:
        parts, _, width = self.words.shape
        filled = np.zeros((len(vectors), parts * width))
        filled[:, : self.dim] = vectors
        return filled.reshape(len(vectors), parts, width)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """The cell of each prepared vector."""
        return np.concatenate([_nearest(vectors[i : i + _STEP], self.centres) for i in range(0, len(vectors), _STEP)] or [np.zeros(0, np.int64)])

    def probed(self, queries: np.ndarray, probes: int) -> np.ndarray:
        """The ``probes`` cells of each prepared query that come first, best first."""
        return np.argsort(_cell_costs(self.metric, queries, self.centres), axis=1, kind="stable")[:, :probes]

    def codes(self, vectors: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """A byte per part of the residuals of prepared vectors."""
        left = self._parts(vectors - self.centres[cells])
        return np.stack([_nearest(left[:, p], w) for p, w in enumerate(self.words)], axis=1).astype(np.uint8)

    def costs(self, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Costs (queries, coded vectors) in one cell, smaller is better: squared distances or negative products."""
        if self.metric == "EUCLID":
            gap = self._parts(queries - self.centres[cell])[:, :, None, :] - self.words[None]
            table = (gap * gap).sum(axis=3)
            start = np.zeros(len(queries))
        else:
            table = -np.einsum("qpw,pew->qpe", self._parts(queries), self.words)
            start = -(queries @ self.centres[cell])
        out = np.repeat(start[:, None], len(codes), axis=1)
        for p in range(len(self.words)):
            out += table[:, p][:, codes[:, p]]
        return out


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1)[None] - 2 * rows @ centres.T).argmin(axis=1)


def _cell_costs(metric: str, queries: np.ndarray, centres: np.ndarray) -> np.ndarray:
    products = queries @ centres.T
    return (centres * centres).sum(axis=1)[None] - 2 * products if metric == "EUCLID" else -products


def _codewords(rows: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Codewords of the rows of one part, by a few Lloyd rounds."""
    words = rows[rng.choice(len(rows), min(n, len(rows)), replace=False)].copy()
    for _ in range(_ROUNDS):
        of = _nearest(rows, words)
        count = np.bincount(of, minlength=len(words))
        total = np.stack([np.bincount(of, rows[:, d], minlength=len(words)) for d in range(rows.shape[1])], axis=1)
        words[count > 0] = total[count > 0] / count[count > 0][:, None]
    return words


def learn(vectors: DataFrame, metric: str, recall: float, cells: int | None = None, part: int = PART, seed: int = 11) -> Quantizer | None:
    """The quantizer of (id, vector) rows; None for an empty table.

    The sample is chosen by a hash of the id. Without ``cells``, there are about
    as many as the square root of the rows. ``probes`` is the number of cells in
    which sampled queries find the share ``recall`` of their nearest neighbours
    within the sample.
    """
    if metric not in METRICS:
        raise ValueError(f"no cells for metric {metric}")
    n = vectors.count()
    if n == 0:
        return None
    wanted = min(MAX_CELLS, cells or max(1, round(n**0.5)), n)
    most = min(MAX_SAMPLE, max(4_096, PER_CELL * wanted))
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = vectors.select("id", "vector").filter(share < most / n) if n > most else vectors.select("id", "vector")
    raw = np.array([r["vector"] for r in sample.orderBy("id").select("vector").toLocalIterator()], dtype=np.float64)
    if not len(raw):  # few rows, none of them in the sample
        raw = np.array([r["vector"] for r in vectors.orderBy("id").limit(most).select("vector").collect()], dtype=np.float64)
    rng = np.random.default_rng(seed)
    bare = Quantizer(metric, np.zeros((1, raw.shape[1])), np.zeros((1, 1, 1)), 1)
    rows = bare.prepare(raw)
    centres = _centres(vectors.sparkSession, rows, min(wanted, len(rows)), seed)
    parts = -(-raw.shape[1] // part)
    first = Quantizer(metric, centres, np.zeros((parts, 1, part)), 1)
    of = first.cells(rows)
    some = rng.permutation(len(rows))[:_CODED]
    left = first._parts(rows[some] - centres[of[some]])
    words = [_codewords(left[:, p], CODEWORDS, rng) for p in range(parts)]
    return Quantizer(metric, centres, np.stack(words), _probes(metric, rows, of, centres, recall, rng))


def _centres(spark, rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    if k == 1:
        return rows.mean(axis=0, keepdims=True)
    table = spark.createDataFrame([(r,) for r in rows.tolist()], "v array<double>").select(array_to_vector("v").alias("features"))
    model = KMeans(k=k, maxIter=_ROUNDS, seed=seed, initMode="random").fit(table)
    return np.array(model.clusterCenters())


def _probes(metric: str, rows: np.ndarray, of: np.ndarray, centres: np.ndarray, recall: float, rng: np.random.Generator) -> int:
    asked = rng.permutation(len(rows))[:_ASKED]
    cost = _cell_costs(metric, rows[asked], rows)
    cost[np.arange(len(asked)), asked] = np.inf
    near = np.argsort(cost, axis=1)[:, : min(_NEIGHBOURS, max(1, len(rows) - 1))]
    place = np.argsort(np.argsort(_cell_costs(metric, rows[asked], centres), axis=1, kind="stable"), axis=1)
    needed = np.sort(np.take_along_axis(place, of[near], axis=1).ravel()) + 1
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) )])


def steps(n: int) -> Iterator[slice]:
    """Slices of rows that are worked on together."""
    return (slice(at, at + _STEP) for at in range(0, n, _STEP))
