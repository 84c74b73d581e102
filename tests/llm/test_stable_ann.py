import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import stable_ann as a

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, asked, k):
    good = sorted({(i, tuple(np.float64(np.float32(x)) for x in v)) for i, v in rows if i is not None and usable(v)})
    out = {}
    for i, v in good:
        if asked(i):
            ranked = sorted((-float(np.dot(v, w)), j) for j, w in good if j != i)
            out[i] = [(j, -s) for s, j in ranked[:k]]
    return out


def found(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return dict(out)


def recall(got, want):
    return sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in want) / sum(map(len, want.values()))


@pytest.mark.parametrize("cell_rows", [64, 2048])
def test_recall_on_the_given_vectors(spark, sf_dir, cell_rows):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, lambda i: i % 20 == 0, 20)
    got = found(a.nearest(df, F.col("vec_id") % 20 == 0, cell_rows=cell_rows, block_rows=40 if cell_rows == 64 else 4096))
    assert got.keys() == want.keys() and all(len(got[i]) == 20 for i in got)
    assert recall(got, want) >= 0.93
    scores = {i: dict(brute(rows, lambda j, i=i: j == i, 1000)[i]) for i in list(got)[:5]}
    for i, own in scores.items():
        assert all(abs(own[j] - s) < 1e-12 for j, s in got[i])
        assert [s for _, s in got[i]] == sorted((s for _, s in got[i]), reverse=True)


def test_clustered_vectors_of_any_length(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 10)) * 3
    rows = [(i, [float(x) for x in (centres[i % 12] + rng.standard_normal(10) * 0.3) * (1 + i % 3)]) for i in range(600)]
    want = brute(rows, lambda i: i % 30 == 0, 10)
    got = found(a.nearest(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(3), F.col("vec_id") % 30 == 0, k=10, cell_rows=32))
    assert recall(got, want) >= 0.93


def test_edge_cases(spark):
    same = [0.5, 0.25, -1.0]
    rows = [(i, same) for i in range(60)] + [(100 + i, [1.0, 0.5, -2.0]) for i in range(3)] + [(5, same), (5, same), (200, [-1.0, 0.0, 0.0])]
    bad = [(300, None), (301, [0.0, 0.0, 0.0]), (302, [1.0, None, 2.0]), (303, [float("nan"), 1.0, 1.0]), (304, [float("inf"), 0.0, 1.0])]
    bad += [(None, same), (305, []), (306, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 0) for r in rows + bad], SCHEMA).repartition(3)
    asked = lambda i: i in (0, 5, 59, 101, 200) or i >= 300
    got = found(a.nearest(df, F.col("vec_id").isin(0, 5, 59, 101, 200) | (F.col("vec_id") >= 300)))
    want = brute(rows, asked, 20)
    assert {i: [j for j, _ in v] for i, v in got.items()} == {i: [j for j, _ in v] for i, v in want.items()}
    few = spark.createDataFrame([(0, same, 1), (1, [1.0, 1.0, 1.0], 1)], SCHEMA)
    assert {i: [j for j, _ in v] for i, v in found(a.nearest(few, F.lit(True))).items()} == {0: [1], 1: [0]}
    assert a.nearest(few.limit(1), F.lit(True)).collect() == []
    assert a.nearest(df.limit(0), F.lit(True)).collect() == []


def test_chi_square():
    rng = np.random.default_rng(1)
    drawn = (rng.standard_normal((20_000, 8)) ** 2).sum(axis=1)
    limit = a.chi_square_limit(0.9, 8)
    assert abs((drawn <= limit).mean() - 0.9) < 0.01 and abs(a.chi_square(limit, 8) - 0.9) < 1e-9


def test_tree_cells_cover_their_points():
    points = np.random.default_rng(2).standard_normal((500, 4))
    points[:200] = points[0]
    tree = a.fit_tree(points, 16)
    gaps = tree.distances(points)
    assert (gaps[np.arange(500), tree.cells(points)] == 0).all()
