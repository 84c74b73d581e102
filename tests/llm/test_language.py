import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import language as m

DOCS = "doc_id long, text string, lang string, source string"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def slots(text, longest=4, bits=18):
    """Presence of hashed runs, by plain Python."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    if not words:
        return set()
    codes, mask, out = [ord(c) for c in f" {' '.join(words)} "], (1 << 64) - 1, set()
    for k in range(1, longest + 1):
        for i in range(len(codes) - k + 1):
            run = 0
            for c in codes[i : i + k]:
                run = (run * 0x100000001B3 + c + 1) & mask
            out.add((((run ^ (run >> 29)) * 0x9E3779B97F4A7C15) & mask) >> (64 - bits))
    return out


def kernel(a, b):
    return np.array([[len(x & y) / np.sqrt(len(x) * len(y)) for y in b] for x in a])


def brute(rows, landmarks, ridge):
    """Kernel ridge regression over Nyström features, with every matrix written out; {id: (language, value)}."""
    known = [(i, slots(t), c) for i, t, c, _ in rows if i is not None and not held(i) and c is not None and t is not None]
    known = [x for x in {i: x for x in known for i in [x[0]]}.values() if x[1]]
    names = sorted({c for _, _, c in known})
    k = kernel(landmarks, landmarks)
    value, vector = np.linalg.eigh(k)
    safe = value > 1e-9 * value[-1]
    root = vector[:, safe] / np.sqrt(value[safe])
    phi = kernel([s for _, s, _ in known], landmarks) @ root
    y = np.array([[1.0 if c == n else -1.0 for n in names] for _, _, c in known])
    weight = np.array([1 / sum(d == c for _, _, d in known) / len(names) for _, _, c in known])[:, None]
    solved = np.linalg.solve(phi.T @ (weight * phi) + ridge * np.eye(phi.shape[1]), phi.T @ (weight * y))
    out = {}
    for i, t, _, _ in rows:
        s = slots(t)
        if s:
            v = (kernel([s], landmarks) @ root @ solved)[0]
            out[i] = (names[int(v.argmax())], min(1.0, max(0.0, (v.max() + 1) / 2)))
        else:
            out[i] = ("und", 0.0)
    return out


def texts(rng, lang, words):
    stems = {"a": ["sol", "mar", "luz", "pan"], "b": ["berg", "wald", "haus"], "c": ["ñu", "éter", "œuf", "日本"]}[lang]
    return " ".join(rng.choice(stems) + rng.choice(["", "en", "os", "x"]) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    made = [(i, texts(rng, c := rng.choice("aab" if i % 3 else "abc"), rng.randint(1, 30)), c, "s") for i in range(240)]
    return [*made, (900, "1234 !?", "a", "s"), (901, None, "b", "s"), (902, "", None, "s"), (903, made[0][1], None, "s")]


@pytest.mark.parametrize("cut", [1 << 20, 5])
def test_presence(monkeypatch, cut, rows):
    monkeypatch.setattr(m, "_CUT", cut)
    found = m.Presence()
    for t in [t for _, t, _, _ in rows[:40]] + ["A--b  C", " é1é", "x", "日 本", "...", "", None, "a" * 50, "ab 12 cd 34 ef"]:
        assert set(found.of(t).tolist()) == slots(t)


def test_against_plain_matrices(spark, rows):
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    # All learned rows are landmarks, so the choice of landmarks does not matter.
    got = {r.doc_id: (r.lang_pred, r.score, r.held_out) for r in m.language_id(df, landmarks=10_000).collect()}
    marks = {frozenset(slots(t)) for i, t, c, _ in rows if not held(i) and c and t} - {frozenset()}
    wanted = brute(rows, sorted(marks, key=sorted), m.RIDGE)
    assert got.keys() == wanted.keys()
    for i, (lang, value) in wanted.items():
        assert got[i][0] == lang and abs(got[i][1] - value) < 1e-4 and got[i][2] == held(i)


def test_few_landmarks_tell_languages_apart(spark, rows):
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = m.language_id(df, landmarks=12, most=90).join(df.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null").collect()
    judged = [r.lang_pred == r.lang for r in got if r.lang_pred != "und"]
    assert len(judged) > 40 and np.mean(judged) > 0.95


def test_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet").repartition(4)
    got = m.language_id(docs).collect()
    true = {r.doc_id: r.lang for r in docs.collect()}
    assert sorted(r.doc_id for r in got) == sorted(true) and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == true[r.doc_id] for r in got if r.held_out]) > 0.98


def test_held_out_languages_change_nothing(spark, rows):
    changed = [(i, t, "zz" if held(i) else c, "other") for i, t, c, _ in rows]
    a, b = (
        {r.doc_id: (r.lang_pred, r.score) for r in m.language_id(spark.createDataFrame(x, DOCS).coalesce(1)).collect()} for x in (rows, changed)
    )
    assert a == b


def test_edge_cases(spark):
    rows = [(1, None, None, None), (1, "", "en", "s"), (None, "uno dos", "es", "s"), (3, "one " * 700_000, "en", "s"), (3, "one " * 700_000, "en", "s"), (4, "日本", "ja", "s"), (5, "12", "en", "s")]
    df = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", score int").withColumn("lang_pred", F.lit("x"))
    got = sorted((r.doc_id or 0, r.lang_pred, r.held_out) for r in m.language_id(df).collect())
    learned = {"en"} | ({"ja"} if not held(4) else set())
    assert [g for g in got if g[0] in (1, 5)] == [(1, "und", False), (1, "und", False), (5, "und", held(5))]
    assert all(g[1] in learned for g in got if g[0] in (0, 3, 4))
    assert m.language_id(df.limit(0)).collect() == []
    nothing = m.language_id(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)} and len(nothing) == len(rows)
    # A third of all rows are one repeated row.
    hot = spark.createDataFrame([(7, "uno dos tres", "es", "s")] * 400 + [(i, "one two three", "en", "s") for i in range(800)], DOCS)
    assert {(r.lang_pred, r.n) for r in m.language_id(hot, most=20).groupBy("lang_pred").agg(F.count("*").alias("n")).collect()} <= {("en", 800), ("es", 400), ("en", 1200)}
