"""Vectors by text."""

import os

import numpy as np
from pyspark.sql import functions as F

from shelfmark.operators.embedding import HashedEmbedder, ModelEmbedder, embed_column, embed_column_safely
from shelfmark.operators.points import to_points
from shelfmark.plans.textvectors import TextVectors

TEXTS = ["one", "two", "one", None, "", "three three", "one"] + [f"number {i}" for i in range(40)]


def vectors_of(df):
    return sorted((r.n, r.t, r._e.vector, r._e.error) for r in df.collect() if r.t is not None) + [(r.n, r._e.vector) for r in df.collect() if r.t is None]


def test_a_text_is_given_once(spark, table, tmp_path):
    log = str(tmp_path / "given")

    def factory():
        def run(texts):
            with open(log, "a") as out:
                out.writelines(f"{t}\n" for t in texts)
            if any("bad" in t for t in texts):
                raise ValueError("no")
            return np.array([[len(t), 1.0] for t in texts])

        return run

    rows = table(list(enumerate(TEXTS)), "n int, t string").repartition(5)
    known = TextVectors(spark, str(tmp_path / "store"), ModelEmbedder(factory, 2))
    first = vectors_of(known.embed(rows, F.col("t")))
    assert [r[:3] for r in first[:-1]] == [(n, t, [float(len(t)), 1.0]) for n, t in enumerate(TEXTS) if t is not None]
    assert first[-1] == (3, [0.0, 1.0])
    given = open(log).read().split("\n")[:-1]
    assert sorted(given) == sorted({t or "" for t in TEXTS})
    # The same texts again, under other ids: the model is not asked.
    os.remove(log)
    assert known.learn(rows.withColumn("n", F.col("n") + 100), F.col("t"))[0] == 0 and not os.path.exists(log)
    # What the model rejects is told, and asked about again.
    more = table([(1, "bad"), (2, "new"), (3, "one")], "n int, t string")
    for asked in ({"bad", "new"}, {"bad"}):
        found = vectors_of(known.embed(more, F.col("t")))
        assert found == [(1, "bad", None, "ValueError: no"), (2, "new", [3.0, 1.0], None), (3, "one", [3.0, 1.0], None)]
        assert set(open(log).read().split()) == asked
        os.remove(log)
    known.compact()
    assert os.listdir(known.root) and known.stored().count() == known.stored().select("hash").distinct().count() == len(set(given)) + 1
    assert known.learn(rows, F.col("t"))[0] == 0
    # A write that did not finish does not count.
    os.remove(f"{known._folders()[-1][1]}/_SUCCESS")
    assert known.stored().count() == 0
    assert known.learn(rows.limit(0), F.col("t"))[0] == 0


def test_equal_to_the_plain_result(spark, table, tmp_path):
    rows = table([(i, f"word{i % 7} word{i % 3} x") for i in range(200)], "n int, t string")
    model = HashedEmbedder(16)
    known = TextVectors(spark, str(tmp_path), model)
    plain = sorted((r.n, r.v) for r in rows.withColumn("v", embed_column(F.col("t"), model)).collect())
    assert sorted((r.n, r._e.vector) for r in known.embed(rows, F.col("t")).collect()) == plain
    assert known.stored().count() == 21


def test_points_from_known_vectors(spark, table, tmp_path):
    chunks = table([("Q1", "a.txt", i, "same text") for i in range(3)] + [("Q2", "b.txt", 0, "other")], "qid string, component string, chunk_index int, text string")
    chunks = chunks.withColumn("document_type", F.lit("none"))
    model = HashedEmbedder(8)
    known = TextVectors(spark, str(tmp_path), model)
    assert sorted(map(repr, to_points(chunks, model, known=known).collect())) == sorted(map(repr, to_points(chunks, model).collect()))
    again = to_points(chunks, model, isolate=True, known=known)
    assert again.filter("error is null").count() == 4 and known.stored().count() == 2


def test_few_texts_are_held_at_a_time(spark):
    class Bounded(HashedEmbedder):
        """Fails if it is given all the texts of a batch at once."""

        def embed(self, texts):
            if len(texts) > 400:
                raise ValueError(f"{len(texts)} texts")
            return super().embed(texts)

    rows = spark.range(0, 1500, 1, 1).selectExpr("id", "if(id % 7 = 0, null, concat('word', id % 11)) as text")
    plain, safe = embed_column(F.col("text"), Bounded(8)).alias("v"), embed_column_safely(F.col("text"), Bounded(8)).alias("e")
    wanted = HashedEmbedder(8).embed([f"word{i % 11}" if i % 7 else "" for i in range(1500)]).tolist()
    made = rows.select("id", plain, safe).orderBy("id").collect()
    assert [[round(x, 5) for x in r.v] for r in made] == [[round(x, 5) for x in w] for w in wanted]
    assert all(r.e.vector == r.v and r.e.error is None for r in made)
