"""Blocks of vectors with bounds on what they can hold for a query.

A block is known by its centre, its radius and its largest norm. The triangle
inequality then says how good the best row of the block can be, so that blocks
which cannot reach a query's k-th best row stay unread. Centres are learned
from a sample; radius and norm come from every row, and so the bounds hold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# A bound is worked out in another order than a cost, and costs are rounded.
SLACK = 1e-5
_ROUNDS = 6
_STEP = 2_048


def unit(vectors: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, lengths, out=np.zeros_like(vectors), where=lengths > 0)


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row by Euclidean distance, the first of equal ones."""
    squares = (centres * centres).sum(axis=1)[None]
    parts = [(squares - 2 * rows[i : i + _STEP] @ centres.T).argmin(axis=1) for i in range(0, len(rows), _STEP)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def learn_centres(rows: np.ndarray, n: int, seed: int = 5) -> np.ndarray:
    """Up to ``n`` different centres of a sample, by a few Lloyd rounds."""
    rng = np.random.default_rng(seed)
    centres = np.unique(rows[rng.choice(len(rows), min(n, len(rows)), replace=False)], axis=0)
    for _ in range(_ROUNDS):
        of = nearest(rows, centres)
        count = np.bincount(of, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, of, rows)
        centres[count > 0] = total[count > 0] / count[count > 0][:, None]
    return centres


def distances(metric: str, rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances (rows, centres): taxicab for MANHATTAN, Euclidean for the other metrics."""
    if metric == "MANHATTAN":
        return np.stack([np.abs(centres - r).sum(axis=1) for r in rows]) if len(rows) else np.zeros((0, len(centres)))
    squares = (rows * rows).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None]
    return np.sqrt(np.maximum(squares - 2 * rows @ centres.T, 0.0))


def spread(metric: str, rows: np.ndarray, centres: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Distance of each row to the centre of its block."""
    gap = rows - centres[of]
    return np.abs(gap).sum(axis=1) if metric == "MANHATTAN" else np.linalg.norm(gap, axis=1)


@dataclass(frozen=True)
class Blocks:
    """Blocks of prepared vectors: of unit length for COSINE. Costs are smaller for better rows."""

    metric: str
    centres: np.ndarray
    rows: np.ndarray
    radius: np.ndarray
    norm: np.ndarray

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Costs (queries, blocks) that no row of the block goes below."""
        gap = distances(self.metric, queries, self.centres)
        least = np.maximum(gap - self.radius, 0.0)
        if self.metric in ("EUCLID", "MANHATTAN"):
            return least
        length = np.linalg.norm(queries, axis=1)[:, None]
        most = queries @ self.centres.T + length * self.radius
        most = np.minimum(most, length * self.norm)
        # q.x = (|q|^2 + |x|^2 - |q-x|^2) / 2
        return -np.minimum(most, (length**2 + self.norm**2 - least**2) / 2)

    def first(self, queries: np.ndarray, k: int) -> np.ndarray:
        """Which blocks a query looks at first: the best by their bounds that hold ``k`` rows together."""
        # Equal bounds (blocks around the query) go by the distance of the centre.
        order = np.lexsort((distances(self.metric, queries, self.centres), self.bounds(queries)), axis=1)
        held = np.cumsum(self.rows[order], axis=1)
        chosen = np.zeros(order.shape, dtype=bool)
        # Empty blocks add nothing, so that they are taken along and dropped below.
        np.put_along_axis(chosen, order, held - self.rows[order] < k, axis=1)
        return chosen & (self.rows > 0)

    def rest(self, queries: np.ndarray, k: int, worst: np.ndarray) -> np.ndarray:
        """Which other blocks may hold rows as good as a query's k-th so far, whose cost is ``worst``."""
        bounds = self.bounds(queries)
        scale = 1.0 + np.abs(worst)[:, None] + np.linalg.norm(queries, axis=1)[:, None] * (1.0 + self.norm)
        slack = SLACK + 1e-7 * np.where(np.isfinite(scale), scale, 0.0)
        return (bounds <= worst[:, None] + slack) & (self.rows > 0) & ~self.first(queries, k)
