import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import cells, knn
from shelfmark.plans import vectorindex as v
from shelfmark.plans.collection import Collection
from shelfmark.plans.vectorindex import VectorIndex, measured_recall

POINTS = "id string, vector array<float>"


def clustered(n, groups, dim=12, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim)) * 4
    of = rng.integers(0, groups, n)
    of[: n // 3] = 0  # a third in one group
    return [(f"p{i:05d}", [float(x) for x in centres[g] + rng.normal(size=dim) * 0.5]) for i, g in enumerate(of)]


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(clustered(3000, 25), POINTS).repartition(6).persist()


@pytest.fixture(scope="module")
def asked(points):
    return points.filter("substring(id, 4, 3) % 20 = 0").select(F.concat(F.lit("q"), "id").alias("query_id"), "vector")


@pytest.fixture(scope="module")
def index(spark, points, tmp_path_factory):
    made = VectorIndex(spark, f"{tmp_path_factory.mktemp('index')}/a")
    made.build(points, "EUCLID", cells=25)
    return made


def test_recall_and_scores(index, points, asked):
    exact = knn.top_k(points, asked, 10, "EUCLID").hits.persist()
    found = index.search(asked, 10).persist()
    assert measured_recall(found, exact) >= 0.95
    assert found.count() == exact.count()
    common = exact.join(found.withColumnRenamed("score", "s"), ["query_id", "id"])
    assert common.filter("abs(score - s) > 1e-6").count() == 0
    ranks = found.groupBy("query_id").agg(F.sort_array(F.collect_list("rank")).alias("r")).select("r").distinct().collect()
    assert [r.r for r in ranks] == [list(range(1, 11))]


def files_read(df):
    """Files that the scan of ``df`` opens, by its own metric."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numFiles").value()


def test_only_probed_cells_are_read(index, asked):
    quantizer = index.quantizer()
    assert quantizer.probes <= 6 and len(quantizer.centres) == 25
    one = asked.limit(1)
    vector = np.array([r.vector for r in one.collect()], dtype=float)
    wanted = set(quantizer.probed(quantizer.prepare(vector), quantizer.probes)[0].tolist())
    read = []
    plain = VectorIndex.cells

    class Watched(VectorIndex):
        def cells(self, table, cells=None):
            out = plain(self, table, cells)
            files = out.inputFiles()
            probed = [f for f in files if int(re.search(r"cell=(\d+)", f)[1]) in wanted]
            read.append((files_read(out), probed, files))
            return out

    assert Watched(index.spark, index.root).search(one, 5).count() == 5
    assert len(read) == 2 and all(n == len(those) < len(everything) / 3 for n, those, everything in read)


def test_large_cells_are_cut(index, points):
    sizes = index.cells("codes").select(F.size("ids").alias("n"), (F.length("codes") / F.size("ids")).alias("bytes"))
    assert sizes.agg(F.sum("n")).first()[0] == points.count()
    assert sizes.agg(F.max("n")).first()[0] <= v.BLOCK and {r.bytes for r in sizes.select("bytes").distinct().collect()} == {3.0}
    assert index.cells("vectors").select("id").distinct().count() == points.count()


def test_added_and_left_out_points(spark, points, asked, tmp_path):
    index = VectorIndex(spark, f"{tmp_path}/b")
    index.build(points.filter("id < 'p02000'"), "EUCLID", cells=20)
    index.add(points.filter("id >= 'p02000'"))
    again = VectorIndex(spark, f"{tmp_path}/b")
    gone = points.filter("substring(id, 6, 1) < 5").select("id")
    exact = knn.top_k(points.join(gone, "id", "left_anti"), asked, 10, "EUCLID").hits
    found = again.search(asked, 10, without=gone)
    assert found.join(gone, "id", "left_semi").count() == 0 and measured_recall(found, exact) >= 0.95
    with pytest.raises(ValueError):
        again.build(points)


@pytest.mark.parametrize("metric", ["COSINE", "DOT"])
def test_all_cells_and_candidates_are_exact(spark, metric, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=7)]) for i in range(300)] + [(900, [0.0] * 7), (901, [1.0] * 7), (902, [1.0] * 7)]
    points = spark.createDataFrame(rows, "id long, vector array<float>")
    asked = points.filter("id % 30 = 0").select(F.col("id").alias("q"), "vector")
    index = VectorIndex(spark, f"{tmp_path}/c")
    index.build(points, metric, cells=9)
    found = index.search(asked, 12, probes=9, rerank=100, query_col="q")
    exact = knn.top_k(points, asked, 12, metric, query_col="q").hits
    key = lambda df: sorted((r.q, r["rank"], r.id, r.score) for r in df.collect())
    assert key(found) == key(exact)


def test_edges(spark, points, index, tmp_path):
    none = points.limit(0).select(F.col("id").alias("query_id"), "vector")
    assert index.search(none, 3).collect() == []
    with pytest.raises(ValueError):
        index.search(none, 0)
    with pytest.raises(ValueError):
        VectorIndex(spark, f"{tmp_path}/d").build(points.limit(0))
    with pytest.raises(ValueError):
        cells.learn(points, "MANHATTAN", 0.9)
    single = VectorIndex(spark, f"{tmp_path}/e")
    single.build(points.limit(1), "COSINE")
    assert single.search(points.limit(2).select(F.col("id").alias("query_id"), "vector"), 4).count() == 2


def test_collection_after_later_writes(spark, tmp_path):
    rows = clustered(900, 9, dim=6, seed=2)
    columns = "id string, qid string, component string, vector array<float>, page_content string, payload map<string,string>"
    stored = lambda rows: spark.createDataFrame([(i, None, None, x, "", {}) for i, x in rows], columns)
    target = Collection(spark, f"{tmp_path}/points", "c", "EUCLID")
    target.ensure(6)
    target.upsert(stored(rows))
    asked = spark.createDataFrame([(i, x) for i, x in rows[::30]], "query_id string, vector array<float>")
    key = lambda df: sorted((r.query_id, r["rank"], r.id, r.score) for r in df.collect())
    exact = lambda k: key(knn.top_k(target.points(), asked, k, "EUCLID").hits)
    assert key(target.search_vectors(asked, 3)) == exact(3)  # no index yet
    target.index_vectors(cells=9)
    everywhere = {"k": 4, "probes": 9}
    assert key(target.search_vectors(asked, **everywhere)) == exact(4)
    target.upsert(stored([(i, [-y for y in x]) for i, x in rows[::7]] + [("new", rows[3][1])]))
    assert key(target.search_vectors(asked, **everywhere)) == exact(4)
    target.compact()
    assert key(target.search_vectors(asked, 4)) == exact(4)
    target.index_vectors(cells=9)
    assert key(target.search_vectors(asked, **everywhere)) == exact(4)
