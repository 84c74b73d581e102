"""Vector arithmetic on ``array<float>`` columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metric name -> whether a larger score is better.
METRICS = {"COSINE": True, "DOT": True, "EUCLID": False, "MANHATTAN": False}


def resolve_metric(name: str | None) -> str:
    """Case-insensitive metric name; anything unknown means cosine."""
    upper = (name or "").upper()
    return upper if upper in METRICS else "COSINE"


def _sum_pairs(a: Column, b: Column, f) -> Column:
    pairs = F.zip_with(a, b, lambda x, y: f(x.cast("double"), y.cast("double")))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum_pairs(a, b, lambda x, y: x * y)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either vector is zero."""
    scale = norm(a) * norm(b)
    return F.when(scale > 0, dot(a, b) / scale).otherwise(F.lit(0.0))


def euclid(a: Column, b: Column) -> Column:
    return F.sqrt(_sum_pairs(a, b, lambda x, y: (x - y) * (x - y)))


def manhattan(a: Column, b: Column) -> Column:
    return _sum_pairs(a, b, lambda x, y: F.abs(x - y))


def score(metric: str, a: Column, b: Column) -> Column:
    return {"COSINE": cosine, "DOT": dot, "EUCLID": euclid, "MANHATTAN": manhattan}[resolve_metric(metric)](a, b)


def normalize(a: Column) -> Column:
    """Unit-length vector; a zero vector stays as it is."""

    def scaled(length: Column) -> Column:
        return F.transform(a, lambda x: F.when(length > 0, x.cast("double") / length).otherwise(x).cast("float"))

    # Through a one-element array, so that the length is computed once and not per element.
    return F.transform(F.array(norm(a)), scaled)[0]
