import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfmark.plans.collection import Collection
from shelfmark.plans.rankedindex import RankedIndex, fused

CORPUS = "id long, page_content string"
QUERIES = "query_id string, text string"


def tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute(rows, queries, k):
    """{(query_id, rank, id, score)} with every text scored."""
    counted = {i: Counter(tokens(t)) for i, t in rows}
    average = sum(c.total() for c in counted.values()) / len(rows)
    df = Counter(w for c in counted.values() for w in c)
    out = set()
    for q, text in queries:
        found = []
        for i, c in counted.items():
            hits = [w for w in set(tokens(text)) if c[w]]
            if hits:
                rare = {w: math.log(1 + (len(rows) - df[w] + 0.5) / (df[w] + 0.5)) for w in hits}
                found.append((-round(sum(rare[w] * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * c.total() / average)) for w in hits), 6), i))
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)}
    return out


def got(hits):
    return {(r.query_id, r["rank"], r.id, r.score) for r in hits.collect()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    common, rare = ["the", "of", "und", "été"], [f"w{i}" for i in range(200)]
    made = [(i, " ".join(rng.choices(common, k=rng.randint(0, 30)) + rng.choices(rare, k=rng.randint(0, 6)))) for i in range(400)]
    return [*made, (1000, None), (1001, ""), (1002, "the " * 500), (1003, "W7, w7; w7!"), (1004, made[5][1]), (1005, made[5][1])]


@pytest.fixture(scope="module")
def index(spark, rows, tmp_path_factory):
    made = RankedIndex(spark, f"{tmp_path_factory.mktemp('ranked')}/a")
    made.build(spark.createDataFrame(rows, CORPUS).repartition(5), window=16)
    return made


@pytest.mark.parametrize("rounds", [(), (1, 3), (1000,)])
def test_against_every_text_scored(spark, index, rows, rounds):
    queries = [("a", "the w7"), ("b", "W3 w3 été"), ("c", "nowhere"), ("d", "of"), ("e", ""), ("f", rows[5][1]), ("g", "nowhere w100")]
    found = index.search(spark.createDataFrame([*queries, ("h", None)], QUERIES), 10, rounds=rounds)
    assert got(found.hits) == brute(rows, queries, 10)


def test_windows_below_the_kth_score_stay_unread(spark, tmp_path):
    rng = random.Random(6)
    # A few texts are all about the words that are asked for; thousands have one of them once.
    texts = [(i, " ".join(["topic"] * 20 + ["subject"] * 20 if i < 12 else ["filler"] * 30 + rng.sample(["topic", "subject", "other"], 1))) for i in range(3000)]
    index = RankedIndex(spark, f"{tmp_path}/b")
    index.build(spark.createDataFrame(texts, CORPUS).repartition(4), window=32)
    asked = [("q", "topic subject")]
    found = index.search(spark.createDataFrame(asked, QUERIES), 5)
    assert got(found.hits) == brute(texts, asked, 5)
    count = found.read.first()
    assert count.n_all == sum(len({"topic", "subject"} & set(t.split())) for _, t in texts) and count.n_read < count.n_all / 4


def test_edges(spark, index, tmp_path):
    none = spark.createDataFrame([], QUERIES)
    assert index.search(none).hits.collect() == []
    with pytest.raises(ValueError):
        index.search(none, 0)
    bare = RankedIndex(spark, f"{tmp_path}/c")
    bare.build(spark.createDataFrame([(1, None), (2, "...")], CORPUS))
    assert bare.search(spark.createDataFrame([("q", "a")], QUERIES)).hits.collect() == []
    bare = RankedIndex(spark, f"{tmp_path}/d")
    bare.build(spark.createDataFrame([], CORPUS))
    assert bare.search(spark.createDataFrame([("q", "a")], QUERIES)).hits.collect() == []


def test_fused(spark):
    lists = [[("q", 1, 1), ("q", 2, 2), ("r", 5, 1)], [("q", 2, 1), ("q", 3, 2)]]
    given = [spark.createDataFrame(x, "query_id string, id long, rank int") for x in lists]
    found = [(r.query_id, r.id, r["rank"], r.score) for r in fused(given, 2).orderBy("query_id", "rank").collect()]
    assert found == [("q", 2, 1, round(1 / 61 + 1 / 62, 9)), ("q", 1, 2, round(1 / 61, 9)), ("r", 5, 1, round(1 / 61, 9))]
    with pytest.raises(ValueError):
        fused([])


def test_collection(spark, rows, tmp_path):
    target = Collection(spark, f"{tmp_path}/points", "c", "DOT")
    target.ensure(2)
    columns = "id string, qid string, component string, vector array<float>, page_content string, payload map<string,string>"
    stored = lambda texts: spark.createDataFrame([(str(i), None, None, [float(i % 5), 1.0], t, {}) for i, t in texts], columns)
    target.upsert(stored(rows))
    asked = [("q", "the w7")]
    as_text = lambda texts: [(str(i), t) for i, t in texts]
    assert got(target.search_ranked(spark.createDataFrame(asked, QUERIES), 7)) == brute(as_text(rows), asked, 7)
    target.upsert(stored([(1003, "gone"), (2000, "the w7 w7")]))
    now = [*[r for r in rows if r[0] != 1003], (1003, "gone"), (2000, "the w7 w7")]
    assert got(target.search_ranked(spark.createDataFrame(asked, QUERIES), 7)) == brute(as_text(now), asked, 7)
    both = spark.createDataFrame(asked, QUERIES).withColumn("vector", F.array(F.lit(1.0).cast("float"), F.lit(0.0).cast("float")))
    found = target.search_hybrid(both, 5, depth=20).collect()
    assert sorted(r["rank"] for r in found) == [1, 2, 3, 4, 5]
    assert target.search_hybrid(both, 5, depth=20).collect() == found


def test_texts_are_scored_where_their_window_is(spark, tmp_path, monkeypatch):
    # What leaves the scoring is the best of each window, not every text that has a word of the query.
    texts = [(i, " ".join(["common"] * (1 + i % 7) + [f"w{i % 3}"])) for i in range(300)]
    index = RankedIndex(spark, f"{tmp_path}/e")
    index.build(spark.createDataFrame(texts, CORPUS).repartition(3), window=300)
    asked = [(f"q{i}", f"common w{i % 3}") for i in range(6)]
    scored, handed = RankedIndex._scored, []

    def counted(*given):
        found = scored(*given)
        handed.append(found.count())
        return found

    monkeypatch.setattr(RankedIndex, "_scored", staticmethod(counted))
    found = index.search(spark.createDataFrame(asked, QUERIES), 20, rounds=())
    assert got(found.hits) == brute(texts, asked, 20)
    assert handed[0] < 6 * 300 / 2


def test_windows_cut_in_parts(spark, rows, tmp_path, monkeypatch):
    from shelfmark.plans import rankedindex

    queries = [("a", "the w7"), ("d", "of"), ("f", rows[5][1])]
    monkeypatch.setattr(rankedindex, "_CHUNK_WORDS", 40)
    index = RankedIndex(spark, f"{tmp_path}/f")
    index.build(spark.createDataFrame(rows, CORPUS).repartition(2), window=16)
    assert got(index.search(spark.createDataFrame(queries, QUERIES), 10).hits) == brute(rows, queries, 10)


def test_parts_end_where_windows_do():
    import pyarrow as pa

    from shelfmark.plans.rankedindex import _whole_windows

    def batch(window, sizes):
        return pa.RecordBatch.from_arrays([pa.array(window, pa.int64()), pa.array([["w"] * n if n is not None else None for n in sizes], pa.list_(pa.string()))], names=["window", "words"])

    given = [batch([1, 1, 2], [3, 3, 1]), batch([2, 3], [2, None]), batch([], []), batch([3, 4, 4], [4, 9, 9]), batch([4], [30])]
    parts = [t.column("window").to_pylist() for t in _whole_windows(iter(given), 5)]
    assert [w for p in parts for w in p] == [1, 1, 2, 2, 3, 3, 4, 4, 4]
    assert parts[0] == [1, 1] and parts[1] == [2, 2, 3, 3]
