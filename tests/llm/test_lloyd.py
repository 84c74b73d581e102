import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import lloyd as m

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Plain Lloyd rounds in Python integers; rows are usable and of one length."""
    length = len(rows[0][1])
    width = -(-length // parts)
    vectors = [[math.floor(scale * Fraction(float(x))) for x in v] + [0] * (parts * width - length) for _, v, _ in rows]
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in vectors]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, list(rows[i][1])))[:entries]
    books = [[cut[i][p] for i in order] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        new = []
        for p, book in enumerate(books):
            members = [[] for _ in book]
            for c in cut:
                members[near(c[p], book)[1]].append(c[p])
            new.append([tuple(sum(x) // len(ms) for x in zip(*ms, strict=True)) if ms else e for ms, e in zip(members, book, strict=True)])
        books = new
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    error = [sum(d for d, _ in f) for f in found]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    labels = {}
    for (_, _, label), e in zip(rows, error, strict=True):
        labels[label] = labels.get(label, 0) + e
    fits = lambda x: x if x < 1 << 63 else None
    return sorted(
        repr((i, "".join(f"{e:02x}" for _, e in f), fits(d), fits(labels[label]), sha))
        for (i, _, label), f, d in zip(rows, found, error, strict=True)
    )


def got(df):
    return sorted(repr(tuple(r)) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


def test_given_vectors(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert got(m.vector_codes(df)) == expected([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])


def test_owners_meet_many_members(spark, monkeypatch):
    monkeypatch.setattr(m, "GROUP", 16)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 12))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 5] + 0.3 * rng.normal(size=12)], i % 3 or None) for i in range(400)]
    rows += [(1000 + i, rows[7][1], 9) for i in range(200)]  # a third are copies
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(m.vector_codes(df, parts=5, entries=7, rounds=4)) == expected(rows, 5, 7, 4)


def test_only_movers_are_written_again(spark, sf_dir, monkeypatch):
    segments = []
    release = m.Steps.release

    def counted(self):
        segments.extend([spark.read.parquet(path) for _, path in self._staged])
        sizes.extend([(df.count(), df.agg(F.min("born"), F.max("born")).first()) for df in segments])
        release(self)

    sizes = []
    monkeypatch.setattr(m.Steps, "release", counted)
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    m.vector_codes(df)
    assert [tuple(born) for _, born in sizes] == [(r, r) for r in range(7)]
    moved = [n for n, _ in sizes]
    assert moved[0] == 8 * df.count() and all(0 < n < moved[0] / 2 for n in moved[1:]) and moved[-1] < moved[1]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_edge_cases(spark, kind):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [1.0, None, 0.0], 1), (3, [nan, 0.0, 0.0], 2), (4, [0.0, -inf, 1.0], 2), (9, [], 1), (8, [1.0], 1),
        (5, [0.5, -0.25, 1.0], None), (5, [0.5, -0.25, 1.0], None), (None, [-1.0, 2.0, 0.125], None), (None, None, None), (7, [3.0, 1e-3, -1e-3], 4),
    ]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").withColumn("row", F.lit("x")).withColumn("position", F.lit(1))
    good = [(i, v, c) for i, v, c in rows if v and len(v) == 3 and all(x is not None and math.isfinite(x) for x in v)]
    if kind == "float":
        good = [(i, [float(np.float32(x)) for x in v], c) for i, v, c in good]
    found = m.vector_codes(df)
    assert got(found) == expected(good)
    assert m.vector_codes(df.limit(0)).collect() == [] and m.vector_codes(df.filter("vec_id < 5")).collect() == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=16) * 10.0 ** rng.integers(0, 12, size=16)], i % 2) for i in range(60)]
    huge = [*rows, (60, [1e300] * 16, 1), (61, [-1e30] * 16, 0)]
    for given in (rows, huge):
        df = spark.createDataFrame(given, "vec_id long, embedding array<double>, label int").repartition(3)
        assert got(m.vector_codes(df, rounds=3)) == expected(given, rounds=3)
