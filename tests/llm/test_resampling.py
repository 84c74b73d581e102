import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import resampling as m

DOCS = "doc_id long, text string"
TARGET = "item_id long, text string"


def runs(text, buckets=10_000, longest=3):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))
    found = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(f.encode()) % buckets for f in found]


def expected(docs, target, percent=5, least=20, buckets=10_000):
    """{(doc_id, n_features, weight, score, rank)} in plain Python; equal ids take their ranks in any order."""
    found = [(i, *runs(t, buckets)) for i, t in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for _, x in target for b in runs(x, buckets)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, n, f in found:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    order = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    drawn = order[: percent * len(order) // 100]
    ranks = {id(x): r for r, x in enumerate(drawn, 1)}
    return sorted(repr((x[0], *x[2:], ranks.get(id(x)))) for x in out)


def got(df):
    return sorted(repr(tuple(r)) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


@pytest.mark.parametrize(("span", "words"), [(1 << 22, 1 << 19), (7, 3), (100, 5), (64, 1)])
def test_runs(monkeypatch, span, words):
    monkeypatch.setattr(m, "_WORDS", words)
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcXYZ019 é日本-.,\n\t_\0") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += [None, "", "x" * 5000 + " b " + "Q" * 70 + " " + "é" * 65 + " z" * 9, "  a", "ÀB"]
    found = [[] for _ in texts]
    for _, bucket, text in m.runs(pa.array([*["before"], *texts]).slice(1), span=span):
        for b, t in zip(bucket.tolist(), text.tolist(), strict=True):
            found[t].append(b)
    assert [sorted(f) for f in found] == [sorted(runs(t)[1]) for t in texts]


def test_given_documents(spark, sf_dir):
    docs, target = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(m.resampled(docs, target)) == expected(rows, [(r.item_id, r.text) for r in target.collect()])


def test_cutoff(spark):
    rng = random.Random(2)
    keys = [(rng.choice([-5, 0, 7, rng.randint(-99, 99)]), rng.randint(0, 1), rng.randint(0, 30), i) for i in range(3000)]
    keys += [(1 << 62, 0, -(1 << 62), 3000), (-(1 << 62), 1, 0, 3001)]
    df = spark.createDataFrame(keys, "k0 long, k1 long, k2 long, k3 long").repartition(7).persist()
    order = sorted(keys)
    for take, last in ((1, 0), (40, 0), (1501, 0), (3002, 0), (2999, 100), (17, 5000)):
        assert m.cutoff(df, take, last=last, rewrite=200) == order[take - 1]
    assert m.cutoff(df, 0) is None and m.cutoff(df, 3003) is None
    assert m.cutoff(df.filter("k3 = 5"), 1, last=0) == keys[5]


def test_pivots_discard_a_quarter(monkeypatch, spark):
    rng = random.Random(3)
    # Uneven partitions with keys in order: medians alone, without weights, would discard little.
    keys = [(i, 0, 0, i) for i in range(4000)]
    df = spark.createDataFrame(keys, "k0 long, k1 long, k2 long, k3 long").repartitionByRange(9, F.col("k0") * F.col("k0")).persist()
    weights = []
    pivot = m._weighted_median
    monkeypatch.setattr(m, "_weighted_median", lambda found: weights.append(sum(n for n, _ in found)) or pivot(found))
    take = rng.randint(1, 4000)
    assert m.cutoff(df, take, last=8)[0] == take - 1
    assert all(b <= 0.75 * a + 9 for a, b in zip(weights, weights[1:], strict=False)) and len(weights) > 3


@pytest.mark.parametrize("last", [0, m.LAST])
def test_edge_cases(spark, last):
    words = " ".join(f"w{i}" for i in range(25))
    rows = [(1, None), (2, ""), (None, words), (None, words), (3, "One TWO. three"), (4, "- " * 9), (5, "long " * 300_000), (6, words), (6, words)]
    rows += [(i, f"{words} {i % 7}") for i in range(100, 160)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"rank": F.lit("x"), "score": F.lit(1), "k0": F.lit(2)}).repartition(4)
    target = spark.createDataFrame([(1, "w1 w2 w3"), (None, None), (2, "three")], TARGET)
    assert got(m.resampled(docs, target, last=last)) == expected(rows, [(1, "w1 w2 w3"), (2, "three")])
    assert got(m.resampled(docs, target.limit(0), percent=100, last=last)) == expected(rows, [], percent=100)
    assert m.resampled(docs.limit(0), target, last=last).collect() == []
    assert {r.rank for r in m.resampled(docs.filter("doc_id < 5"), target).collect()} == {None}
