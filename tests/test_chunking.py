"""Chunking against plain Python."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import chunking
from shelfmark.operators.arrays import unnest
from shelfmark.operators.embedding import HashedEmbedder, ModelEmbedder, windows
from shelfmark.schemas import ChunkParams
from tests.conftest import column

PAGES = "qid string, component string, page int, text string"


def windows_of(text, size, overlap):
    """Fixed windows, spelled out."""
    if len(text) <= size:
        return [text]
    pieces, at = [], 0
    while True:
        pieces.append(text[at : at + size])
        if at + size >= len(text):
            return pieces
        at += size - overlap


def semantic(text, params, embed):
    """Sentence windows, distances, percentile, merge: (text, start index) per chunk."""
    parts = re.split(r"(?<=[.?!])\s+", text)
    if len(parts) == 1:
        return [(text, 0)]
    around = [" ".join(parts[max(0, i - params.buffer_size) : i + params.buffer_size + 1]) for i in range(len(parts))]
    vectors = np.asarray([embed(w) for w in around])
    distances = []
    for a, b in zip(vectors, vectors[1:]):
        scale = np.linalg.norm(a) * np.linalg.norm(b)
        distances.append(round(1 - (a @ b / scale if scale else 0), 9))
    cut = round(float(np.percentile(distances, params.breakpoint_percentile)), 9)
    chunks, first = [], 0
    for i, distance in enumerate(distances):
        joined = " ".join(parts[first : i + 1])
        if distance > cut and len(joined) >= params.min_chunk_size:
            chunks.append(joined)
            first = i + 1
    chunks.append(" ".join(parts[first:]))
    starts = np.cumsum([0] + [len(c) for c in chunks]).tolist()
    return list(zip(chunks, starts))


def embed_one(text):
    return HashedEmbedder(32).embed([" ".join(re.findall(r"[^\W_]+", text.lower()))])[0]


def random_text(rng, sentences):
    vocabulary = ["alpha", "beta", "gamma", "delta", "éta", "zeta", "theta", "x1", "😀"]
    parts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 12))) + rng.choice([".", "?", "!", ""]) for _ in range(sentences)]
    return rng.choice([" ", "  ", "\n"]).join(parts)


@pytest.mark.parametrize("size,overlap", [(10, 3), (7, 0), (5, 4)])
def test_fixed_windows(table, size, overlap):
    rng = random.Random(size)
    texts = ["".join(rng.choices("abc é\n😀", k=n)) for n in list(range(0, 40)) + [100, 997]]
    df = table([(t,) for t in texts], "t string")
    assert column(df, chunking.fixed_windows(F.col("t"), size, overlap)) == [windows_of(t, size, overlap) for t in texts]
    counted = column(df, chunking.window_count(F.length("t"), size, overlap))
    assert counted == [len(windows_of(t, size, overlap)) for t in texts]


def test_fixed_windows_needs_progress():
    with pytest.raises(ValueError):
        chunking.fixed_windows(F.lit("x"), 5, 5)
    with pytest.raises(ValueError):
        ChunkParams(target_max_chunk_size=50, max_overlap=100)


def test_default_overlap():
    assert ChunkParams().overlap == 100
    assert ChunkParams().override(min_chunk_size=200).overlap == 50


@pytest.mark.parametrize("buffer_size", [0, 1, 3])
def test_semantic_pieces(table, buffer_size):
    rng = random.Random(buffer_size)
    params = ChunkParams(min_chunk_size=60, target_max_chunk_size=10_000, buffer_size=buffer_size)
    texts = [random_text(rng, n) for n in [1, 2, 3, 5, 8] * 8 + [60]] + ["", ". . .", "no end"]
    df = table(list(enumerate(texts)), "i int, text string").repartition(3)
    found = chunking.semantic_pieces(df, params, HashedEmbedder(32)).orderBy("i").collect()
    for row, text in zip(found, texts):
        assert [(p.text, p.start_index) for p in row.pieces] == semantic(text, params, embed_one)


def test_user_model_breaks_equal_hashed_ones(table):
    rng = random.Random(9)
    params = ChunkParams(min_chunk_size=40, target_max_chunk_size=10_000, buffer_size=1)
    df = table([(i, random_text(rng, 12)) for i in range(5)], "i int, text string")

    def factory():
        embedder = HashedEmbedder(32)
        return lambda texts: embedder.embed([" ".join(re.findall(r"[^\W_]+", t.lower())) for t in texts])

    model = ModelEmbedder(factory, 32, batch_size=5)
    left = chunking.semantic_pieces(df, params, model).select("i", "pieces").orderBy("i").collect()
    right = chunking.semantic_pieces(df, params, HashedEmbedder(32)).select("i", "pieces").orderBy("i").collect()
    assert left == right


def test_windows_of_sentences():
    assert list(windows(["a", "b", "c"], 1)) == ["a b", "a b c", "b c"]
    assert list(windows(["a", "b"], 5)) == ["a b", "a b"]


def test_page_within_buffer_is_one_piece(table):
    text = "One.  Two.\nThree."
    df = table([(text,), ("Alone.",)], "text string")
    pieces = column(chunking.semantic_pieces(df), "pieces")
    assert [[(p.text, p.start_index) for p in ps] for ps in pieces] == [[("One. Two. Three.", 0)], [("Alone.", 0)]]


def test_chunks_run_over_pages(table):
    params = ChunkParams(min_chunk_size=8, target_max_chunk_size=10, buffer_size=200)
    data = [("Q1", "a", 1, "y" * 5), ("Q1", "a", 0, "x" * 25), ("Q1", "b", 0, "z"), ("Q1", "a", 2, None), ("Q1", "a", 3, "w" * 11)]
    found = chunking.chunk_pages(table(data, PAGES), params).orderBy("component", "chunk_index").collect()
    expected = [("a", 0, p) for p in windows_of("x" * 25, 10, 2)] + [("a", 1, "y" * 5)]
    expected += [("a", 3, p) for p in windows_of("w" * 11, 10, 2)]
    assert [(r.component, r.page, r.text) for r in found if r.component == "a"] == expected
    assert [r.chunk_index for r in found] == list(range(len(expected))) + [0]
    plain = chunking.fixed_chunks(table(data, PAGES), params).orderBy("component", "chunk_index").collect()
    assert [(r.component, r.page, r.text) for r in plain if r.component == "a"] == expected


def test_oversize_pieces_keep_start_index(table):
    params = ChunkParams(min_chunk_size=20, target_max_chunk_size=30, buffer_size=0, breakpoint_percentile=0.0)
    text = "alpha beta gamma delta epsilon. " * 3 + "zeta eta theta iota kappa lambda mu."
    pieces = semantic(text, params, embed_one)
    expected = [(start, w) for piece, start in pieces for w in windows_of(piece, 30, params.overlap)]
    chunks = chunking.chunk_pages(table([("Q1", "a", 0, text)], PAGES), params, HashedEmbedder(32)).orderBy("chunk_index").collect()
    assert [(r.start_index, r.text) for r in chunks] == expected


def test_short_chunks_are_kept_and_flagged(table):
    params = ChunkParams(min_chunk_size=250, target_max_chunk_size=400)
    chunks = table([("x" * 5,), ("x" * 300,), ("x" * 500,)], "text string")
    assert column(chunks, chunking.is_outlier(F.col("text"), params)) == [True, False, True]
    assert column(chunks, chunking.is_outlier(F.col("text"), params, 0)) == [True, False, True]
    assert column(chunks, chunking.is_outlier(F.col("text"), params, 5)) == [False, False, True]
    assert tuple(chunking.outlier_summary(chunks, params).collect()[0]) == (2, 3, 5, 500)
    assert tuple(chunking.outlier_summary(chunks.limit(0), params).collect()[0]) == (0, 0, None, None)


def test_time_limit(table):
    def slow():
        import time

        return lambda texts: (time.sleep(0.3), np.ones((len(texts), 2)))[1]

    params = ChunkParams(buffer_size=0)
    df = table([("Short.",), ("One. Two. Three.",)], "text string").coalesce(1)
    found = chunking.semantic_pieces(df, params, ModelEmbedder(slow, 2), timeout_seconds=0.1)
    assert column(found, "timed_out") == [False, True]


def test_chunks_are_computed_once(table):
    pages = table([("Q1", "a", 0, "x. y.")], PAGES)
    pieces = chunking.semantic_pieces(pages, ChunkParams(buffer_size=0), HashedEmbedder(8))
    rows = unnest(pieces, F.col("pieces"), "piece", "at").select("piece")
    # Once for the rows, not again for an inferred filter.
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    numbered = chunking.chunk_pages(pages, ChunkParams(buffer_size=0))
    assert "ArrowEvalPython" not in numbered._jdf.queryExecution().optimizedPlan().toString()
