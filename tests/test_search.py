"""Embedding, nearest neighbours and retrieval."""

import pickle
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.functions.vectors import METRICS
from shelfmark.operators import ann, blocks, knn
from shelfmark.operators.embedding import HashedEmbedder, ModelEmbedder, embed_column, embed_column_safely, row_embedder
from shelfmark.operators.points import embedding_text, identify, merge_metadata, payload, split_payload, to_points
from shelfmark.plans.retrieve import retrieve, retrieve_prompts
from tests.conftest import column

VECTORS = "id string, vector array<float>"


def brute(corpus, queries, k, metric):
    result = []
    for query_id, q in queries:
        scored = []
        for id_, v in corpus:
            a, b = np.float32(v).astype(float), np.float32(q).astype(float)
            score = {
                "COSINE": lambda: a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) if a.any() and b.any() else 0.0,
                "DOT": lambda: a @ b,
                "EUCLID": lambda: np.linalg.norm(a - b),
                "MANHATTAN": lambda: np.abs(a - b).sum(),
            }[metric]()
            scored.append((round(float(score), 6), id_))
        scored.sort(key=lambda s: (-s[0] if METRICS[metric] else s[0], s[1]))
        result += [(query_id, r, id_, pytest.approx(s, abs=2e-6)) for r, (s, id_) in enumerate(scored[:k], 1)]
    return result


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    corpus = [(f"p{i:04d}", rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(300)]
    # A third of the corpus are copies of one vector: ties go to the smaller id.
    corpus += [(f"c{i:04d}", [1.0, 2.0, 0.0, -1.0]) for i in range(150)]
    queries = [(f"q{i}", rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(9)] + [("zero", [0.0] * 4), ("hot", [1.0, 2.0, 0.0, -1.0])]
    return corpus, queries


@pytest.mark.parametrize("metric", list(METRICS))
@pytest.mark.parametrize("way", ["shared", "blocked"])
def test_top_k(table, data, metric, way, monkeypatch):
    corpus, queries = data
    monkeypatch.setattr(knn, "BLOCK_ROWS", 30)
    monkeypatch.setattr(knn, "PIECE_ROWS", 64)
    monkeypatch.setattr(knn, "GROUP_QUERIES", 2)
    left = table(corpus, VECTORS).repartition(5)
    right = table(queries, "query_id string, vector array<float>")
    found = knn.top_k(left, right, 7, metric, max_shared_queries=100 if way == "shared" else 3)
    assert found.max_rows == (77 if way == "shared" else None)
    rows = found.hits.select("query_id", "rank", "id", "score").orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in rows] == sorted(brute(corpus, queries, 7, metric), key=lambda r: r[:2])


def test_top_k_edges(table, data):
    corpus, queries = data
    left, right = table(corpus[:3], VECTORS), table(queries[:2], "query_id string, vector array<float>")
    assert knn.top_k(left, right, 30).hits.count() == 6
    assert knn.top_k(left.limit(0), right, 3).hits.count() == 0
    assert knn.top_k(left, right.limit(0), 3).hits.count() == 0
    with pytest.raises(ValueError):
        knn.top_k(left, right, 0)


def test_top_k_never_pairs_rows(table, data):
    corpus, queries = data
    hits = knn.top_k(table(corpus, VECTORS), table(queries, "query_id string, vector array<float>"), 3).hits
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "WindowGroupLimit" in plan


@pytest.mark.parametrize("metric", list(METRICS))
def test_blocks_bound_their_rows(metric):
    rng = np.random.default_rng(8)
    groups = rng.standard_normal((40, 12)) * 4
    rows = np.concatenate([groups[rng.integers(0, 40, 4000)] + 0.1 * rng.standard_normal((4000, 12)), np.zeros((3, 12))])
    asked = np.concatenate([rows[::100], rng.standard_normal((20, 12)) * 9, np.zeros((1, 12))])
    rows, asked = (knn._prepared(v, metric) for v in (rows, asked))
    centres = blocks.learn_centres(rows, 60)
    of = blocks.nearest(rows, centres)
    away, norm = blocks.spread(metric, rows, centres, of), np.linalg.norm(rows, axis=1)
    at = [of == b for b in range(len(centres))]
    known = blocks.Blocks(
        metric, centres, np.array([m.sum() for m in at]),
        np.array([away[m].max(initial=0) for m in at]), np.array([norm[m].max(initial=0) for m in at]),
    )
    scorer = knn.Scorer(metric, asked)
    cost = np.stack([scorer.exact(rows, np.full(len(rows), q)) for q in range(len(asked))])
    bounds, first = known.bounds(asked), known.first(asked, 7)
    for b, mine in enumerate(at):
        if mine.any():
            assert (bounds[:, b] <= cost[:, mine].min(axis=1) + blocks.SLACK).all()
    assert (first @ known.rows >= 7).all()
    seen = np.where(first[:, of], cost, np.inf)
    worst = np.sort(seen, axis=1)[:, 6]
    rest = known.rest(asked, 7, worst)
    assert not (rest & first).any()
    seen = np.where((first | rest)[:, of], cost, np.inf)
    assert (np.sort(seen, axis=1)[:, :7] == np.sort(cost, axis=1)[:, :7]).all()
    assert (first | rest)[:40].mean() < 0.3


def test_blocked_search_skips_blocks(table, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 20)
    rng = np.random.default_rng(9)
    groups = rng.standard_normal((30, 8)) * 5
    corpus = [(i, (groups[i % 30] + 0.05 * rng.standard_normal(8)).tolist()) for i in range(1500)]
    queries = [(i, corpus[i][1]) for i in range(0, 1500, 50)]
    left, right = table(corpus, "id int, vector array<float>"), table(queries, "query_id int, vector array<float>")
    found = knn.top_k(left, right, 5, max_shared_queries=0)
    assert found.compared < 0.2 * len(corpus) * len(queries)
    assert sorted(found.hits.collect()) == sorted(knn.top_k(left, right, 5).hits.collect())
    for empty in (knn.top_k(left.limit(0), right, 5, max_shared_queries=0), knn.top_k(left, right, 2000, max_shared_queries=0)):
        assert empty.hits.count() in (0, len(corpus) * len(queries))


@pytest.mark.parametrize("block", [1000, 6])
def test_approximate_recall(table, block):
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((20, 16))
    corpus = [(i, (centers[i % 20] + 0.2 * rng.standard_normal(16)).tolist()) for i in range(600)]
    queries = [(i, (centers[i] + 0.2 * rng.standard_normal(16)).tolist()) for i in range(20)]
    left = table(corpus, "id int, vector array<float>")
    right = table(queries, "query_id int, vector array<float>")
    exact = {(r.query_id, r.id) for r in knn.top_k(left, right, 10).hits.collect()}
    rows = ann.approximate_top_k(left, right, 10, dim=16, bits=4, tables=8, block=block).collect()
    assert "Exchange" not in ann.approximate_top_k(left, right, 10, dim=16)._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[-1]
    assert len({(r.query_id, r.id) for r in rows} & exact) / len(exact) > 0.9
    assert len({(r.query_id, r.id) for r in rows}) == len(rows)
    truth = {(r.query_id, r.id): r.score for r in knn.top_k(left, right, 600).hits.collect()}
    assert all(r.score == truth[(r.query_id, r.id)] for r in rows)


def test_user_models(table):
    df = table([("hello",), (None,)], "t string")
    toy = row_embedder(lambda text: [float(len(text))], 1)
    assert column(df, embed_column(F.col("t"), toy)) == [[5.0], [0.0]]

    def picky():
        def run(texts):
            if any("bad" in t for t in texts):
                raise ValueError("no")
            return np.ones((len(texts), 2))

        return run

    words = table([("good",), ("bad",), ("fine",)], "t string").coalesce(1)
    found = column(words, embed_column_safely(F.col("t"), ModelEmbedder(picky, 2)))
    assert [(r.vector, r.error) for r in found] == [([1.0, 1.0], None), (None, "ValueError: no"), ([1.0, 1.0], None)]
    with pytest.raises(Exception, match="expected 3"):
        words.select(embed_column(F.col("t"), row_embedder(lambda t: [1.0], 3))).collect()


def test_model_is_built_once_per_worker(table, tmp_path):
    log = str(tmp_path / "built")

    def factory():
        with open(log, "a") as out:
            out.write("x")
        return lambda texts: np.ones((len(texts), 1))

    df = table([(str(i),) for i in range(100)], "t string").repartition(20)
    df.select(embed_column(F.col("t"), ModelEmbedder(factory, 1))).collect()
    assert 1 <= len(open(log).read()) <= 8


def test_hashed_embedding(table):
    df = table([("The cat, the hat",), ("",), ("!!",)], "t string")
    first, empty, none = column(df, embed_column(F.col("t"), HashedEmbedder(8)))
    assert np.linalg.norm(first) == pytest.approx(1.0, abs=1e-6)
    assert empty == none == [0.0] * 8


CHUNKS = "qid string, component string, page int, chunk_index int, start_index int, text string, source string, package string, version string, document_type string, title string"


def chunk(qid, component, index, text="hello", kind="CRAN_PACKAGE"):
    return (qid, component, 0, index, 0, text, "CRAN", "pkg", "1.0", kind, "T")


def test_points(table):
    chunks = table([chunk("Q1", "a", 0), chunk("Q1", "a", 1)], CHUNKS)
    toy = row_embedder(lambda text: [float(len(text))], 1)
    rows = to_points(chunks, toy).orderBy("page_content", "id").collect()
    first = next(r for r in rows if r.payload["chunk_index"] == "0")
    assert first.id == "cd323cb5-8784-58c5-85a9-4419450f4724"
    assert first.page_content == first.payload["page_content"] == "hello"
    # The package prefix is embedded but not stored.
    assert first.vector == [float(len("Package pkg. hello"))]
    assert {"qid", "source", "package", "version", "document_type", "page", "chunk_index", "start_index"} <= set(first.payload)


def test_later_file_of_an_item_wins(table):
    chunks = table([chunk("Q1", "a", 0, "A0"), chunk("Q1", "a", 1, "A1"), chunk("Q1", "b", 0, "B0")], CHUNKS)
    assert sorted(column(identify(chunks), "text")) == ["A1", "B0"]
    apart = identify(chunks, ("qid", "component"))
    assert sorted(column(apart, "text")) == ["A0", "A1", "B0"] and apart.select("id").distinct().count() == 3


def test_embedding_text(table):
    chunks = table([chunk("Q1", "a", 0), chunk("Q1", "a", 1, kind="OTHER")], CHUNKS)
    assert column(chunks, embedding_text(chunks)) == ["Package pkg. hello", "hello"]


def test_payload(table):
    df = table([("v", {"a": "file", "z": "kept"})], "a string, extra map<string,string>")
    made = payload({"a": F.col("a"), "none": F.lit(None).cast("string")}, F.lit("text"), F.col("extra"))
    assert column(df, made) == [{"z": "kept", "a": "v", "page_content": "text"}]
    content, rest = split_payload(made)
    assert tuple(df.select(content, rest).collect()[0]) == ("text", {"z": "kept", "a": "v"})
    content, rest = split_payload(F.col("extra"))
    assert tuple(df.select(content, rest).collect()[0]) == ("", {"a": "file", "z": "kept"})
    assert column(df, merge_metadata(F.col("extra"), F.create_map(F.lit("a"), F.lit("b")))) == [{"z": "kept", "a": "b"}]


def test_payload_of_many_hits(table, data):
    corpus, queries = data
    left = table(corpus, VECTORS)
    found = knn.top_k(left, table(queries, "query_id string, vector array<float>"), 3)
    texts = left.select("id", F.concat(F.lit("text "), "id").alias("text"))
    few, many = knn.with_payload(found, texts), knn.with_payload(found, texts, broadcast_rows=0)
    columns = ["query_id", "rank", "id", "text"]
    assert sorted(map(tuple, few.select(columns).collect())) == sorted(map(tuple, many.select(columns).collect()))
    assert few.count() == 33


def test_retrieval(table):
    texts = {"d1": "cats purr", "d2": "dogs bark", "d3": "cats and dogs", "d4": "rain falls"}
    embedder = HashedEmbedder(256)
    corpus = table([(k, {"page_content": v, "meta": "m"}) for k, v in texts.items()], "id string, payload map<string,string>")
    points = corpus.withColumn("vector", embed_column(F.col("payload")["page_content"], embedder))
    queries = table([(1, "cats purr"), (2, "rain")], "query_id int, text string")
    hits = retrieve(points, queries, embedder, 2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.id, r.page_content) for r in hits][:2] == [(1, 1, "d1", "cats purr"), (1, 2, "d3", "cats and dogs")]
    assert hits[0].metadata == {"meta": "m"} and "vector" not in hits[0]
    full = retrieve(points, queries, embedder, 5, with_vectors=True)
    row = full.filter("rank = 1 and query_id = 1").collect()[0]
    assert len(row.vector) == 256 and row.metadata == {"meta": "m", "page_content": "cats purr"}
    prompt = column(retrieve_prompts(points, queries.filter("query_id = 2"), embedder, n=1, template="{context}|{question}"), "prompt")
    assert prompt == ["rain falls|rain"]


def _many(n, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, rng.standard_normal(dim).astype(np.float32).tolist()) for i in range(n)]


def test_a_query_is_sent_to_a_shelf_once(table, monkeypatch):
    # Directions are random: all blocks are visited, yet what is moved and handed on does not grow with the blocks.
    monkeypatch.setattr(knn, "BLOCK_ROWS", 10)
    rows = _many(400)
    left, right = table(rows, "id int, vector array<float>"), table(rows, "query_id int, vector array<float>")
    handed, visit = [], knn._visit

    def counted(*given):
        hits, compared = visit(*given)
        handed.append(hits.count())
        return hits, compared

    monkeypatch.setattr(knn, "_visit", counted)
    found = knn.top_k(left, right, 5, "DOT", max_shared_queries=0)
    assert sorted(found.hits.collect()) == sorted(knn.top_k(left, right, 5, "DOT").hits.collect())
    assert all(n <= 400 * 5 for n in handed)


@pytest.mark.parametrize("metric", list(METRICS))
@pytest.mark.parametrize("scale", [1.0, 1e-4, 1e9])
def test_single_precision_only_sorts_out(metric, scale):
    rng = np.random.default_rng(12)
    rows, asked = scale * rng.standard_normal((900, 24)), scale * rng.standard_normal((7, 24))
    rows[100:110] = rows[0]
    keeper = knn.BestK(asked, 9, metric)
    for at in range(0, 900, 100):
        keeper.add(knn.Part(np.arange(at, at + 100), rows[at : at + 100], metric))
    query, ids, _ = keeper.result()
    scorer = knn.Scorer(metric, asked)
    corpus = knn._prepared(rows, metric)
    for q in range(7):
        cost = scorer.exact(corpus, np.full(900, q))
        assert ids[query == q].tolist() == np.lexsort((np.arange(900), cost))[:9].tolist()


def test_queries_and_rows_meet_by_code(table, monkeypatch):
    monkeypatch.setattr(knn, "PIECE_ROWS", 20)
    monkeypatch.setattr(knn, "GROUP_QUERIES", 15)
    rows = [*_many(300, 16), (1000, [0.0] * 16), (1001, [0.0] * 16)]
    left, right = table(rows, "id int, vector array<float>"), table(rows, "query_id int, vector array<float>")
    shared = ann.approximate_top_k(left, right, 6, dim=16, bits=3, tables=4)
    by_code = ann.approximate_top_k(left, right, 6, dim=16, bits=3, tables=4, block=10)
    assert sorted(by_code.collect()) == sorted(shared.collect())
    # One pass, not one per block of queries.
    assert by_code._jdf.queryExecution().analyzed().toString().count("RepartitionByExpression") == 1


def test_queries_of_the_same_blocks_follow_each_other(table, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 20)
    rows = _many(200)
    left, right = table(rows, "id int, vector array<float>"), table(rows, "query_id int, vector array<float>")
    plans, visit = [], knn._visit

    def seen(*given):
        hits, compared = visit(*given)
        plans.append(hits._jdf.queryExecution().optimizedPlan().toString())
        return hits, compared

    monkeypatch.setattr(knn, "_visit", seen)
    found = knn.top_k(left, right, 5, max_shared_queries=0)
    assert len(plans) == 2 and all(re.search(r"Sort \[shelf.*place#\d+ ASC NULLS FIRST, bits", p) for p in plans)
    assert sorted(found.hits.collect()) == sorted(knn.top_k(left, right, 5).hits.collect())


@pytest.mark.parametrize("share", [0.0, 0.003, 0.4, 1.0])
@pytest.mark.parametrize("shape", [(7, 901), (16, 64), (1, 5), (3, 0)])
def test_places_of_true_values(shape, share):
    near = np.random.default_rng(4).random(shape) < share
    assert knn._places(near).tolist() == np.flatnonzero(near).tolist()


def test_buckets_of_words_are_worked_out_once(monkeypatch):
    embedder = HashedEmbedder(16)
    before = embedder.counts(["one two one", "", "two three"])
    monkeypatch.setattr("shelfmark.operators.embedding.hashlib.md5", None)
    assert embedder.counts(["one two one", "", "two three"]).tolist() == before.tolist()
    assert before.sum(axis=1).tolist() == [3, 0, 2]
    left = pickle.loads(pickle.dumps(embedder))
    assert left.dim == 16 and not left._buckets


@pytest.mark.parametrize(
    "rows, coded",
    [
        (np.random.default_rng(5).standard_normal((1500, 24)), True),
        (np.random.default_rng(5).standard_normal((1500, 24)) * 1e9 + 1e12, True),
        (np.random.default_rng(5).standard_normal((1500, 5)) * 1e-5, True),
        (np.random.default_rng(5).integers(-2, 3, (1500, 4)).astype(float), True),
        (np.random.default_rng(5).standard_normal((1500, 9)) * [1.0] * 9 + np.eye(9)[0] * 1e3, True),
        (np.random.default_rng(5).standard_cauchy((1500, 16)), False),
        (np.ones((300, 3)), False),
        (np.random.default_rng(5).standard_normal((100, 600)), False),
        (np.random.default_rng(5).standard_normal((300, 4)) + 1e16, False),
    ],
)
@pytest.mark.parametrize("k", [1, 9, 400])
def test_taxicab_codes_lose_no_row(rows, coded, k):
    rng = np.random.default_rng(6)
    asked = np.concatenate([rows[:20], rows[:20] + rng.standard_normal((20, rows.shape[1])) * rows.std(), np.full((1, rows.shape[1]), 1e10)])
    ids = rng.permutation(len(rows))
    assert (knn.Part(ids, rows, "MANHATTAN").codes is not None) == coded
    keeper = knn.BestK(asked, k, "MANHATTAN")
    for at in range(0, len(rows), 700):
        keeper.add(knn.Part(ids[at : at + 700], rows[at : at + 700], "MANHATTAN"), None if at else np.arange(len(asked)))
    query, found, scores = keeper.result()
    for q, vector in enumerate(asked):
        cost = np.round(np.abs(rows - vector).sum(axis=1), 6)
        best = np.lexsort((ids, cost))[:k]
        assert found[query == q].tolist() == ids[best].tolist() and scores[query == q].tolist() == cost[best].tolist()


def test_taxicab_codes_leave_few_rows():
    rows = np.random.default_rng(7).standard_normal((6000, 64))
    part, scorer = knn.Part(np.arange(6000), rows, "MANHATTAN"), knn.Scorer("MANHATTAN", rows[:50])
    cost = np.stack([np.abs(rows - r).sum(axis=1) for r in rows[:50]])
    worst = np.sort(cost, axis=1)[:, 29]
    near = scorer.near(part, np.arange(50), worst, 30)
    assert near[cost <= worst[:, None]].all() and near.mean() < 0.04
    # Where no bound is known, the best rows of the part give one.
    near = scorer.near(part, np.arange(50), np.full(50, np.inf), 30)
    assert near[cost <= worst[:, None]].all() and near.mean() < 0.04
    missing = knn.Scorer("MANHATTAN", np.full((1, 64), np.nan)).near(part, np.arange(1), np.array([np.inf]), 30)
    assert not missing.any()
