import zlib

import numpy as np
import pytest

from shelfmark.llm import toxicity as t
from tests.llm.test_quality import auc

DOCS = "doc_id long, text string, lang string, source string"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_documents(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    known = {r.doc_id: r.toxic for r in labels.collect()}
    rows = t.toxicity(docs.repartition(8), labels, trees=10).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    judged = [(r.score, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    assert auc(judged) > 0.97
    wrong = [s >= 0.3 for s, y in judged if not y]
    assert sum(wrong) <= 0.03 * len(wrong)
    # Calibration: the mean score is near the rate of label 1.
    assert abs(np.mean([s for s, _ in judged]) - np.mean([y for _, y in judged])) < 0.03


def test_held_out_labels_change_nothing(spark):
    rng = np.random.default_rng(0)
    words = [f"word{i}" for i in range(60)]
    rows = [
        (i, " ".join(rng.choice(words, 30)) + (" you nastyword" if i % 5 == 0 else ""), "en", "s") for i in range(400)
    ]
    docs = spark.createDataFrame(rows, DOCS).coalesce(2)
    true = [(i, int(i % 5 == 0)) for i in range(400)]
    flipped = [(i, 1 - y if held(i) else y) for i, y in true]
    scores = [
        {r.doc_id: r.score for r in t.toxicity(docs, spark.createDataFrame(y, "doc_id long, toxic int").coalesce(1), trees=3).collect()}
        for y in (true, flipped)
    ]
    assert scores[0] == scores[1]
    assert min(scores[0][i] for i, y in true if y) > max(scores[0][i] for i, y in true if not y)


@pytest.mark.parametrize("labels", [[], [(1, 1), (3, 1)], [(None, 1), (1, None), (77, 0)]])
def test_edge_cases(spark, labels):
    rows = [(1, None, None, None), (1, "", "en", "s"), (None, "you idiot", "en", "s"), (3, "x " * 200_000, "en", "s"), (3, "x", "en", "s")]
    docs = spark.createDataFrame([(*r, 0.1) for r in rows], DOCS + ", score double")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = t.toxicity(docs, known).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.held_out == held(r.doc_id) for r in got)
    assert t.toxicity(docs.limit(0), known).collect() == []


def test_disguised_words_are_found():
    lexicon = {"idiot ": 5.0, "idiot": 4.0, "lowei": 3.0}
    at = t.FEATURES.index("disguised")
    assert all(t.text_features(f"such an {w} here", lexicon, {})[at] > 0 for w in ("id10t", "i.d.i.o.t", "idiiiiot", "1diot!"))
    assert t.text_features("such an order here 2024", lexicon, {})[at] == 0
    hit = t.text_features("you idiot and loweixyz", lexicon, {})
    assert hit[0] == 0.5 and hit[3] == 5.0 and hit[t.FEATURES.index("addressed")] == 2.0
