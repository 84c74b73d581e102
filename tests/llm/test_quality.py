import numpy as np
import pytest

from shelfmark.llm import quality as q

DOCS = "doc_id long, text string, lang string, source string"


def auc(pairs):
    good = np.array([s for s, y in pairs if y])
    bad = np.array([s for s, y in pairs if not y])
    return ((good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean()).item()


def test_given_documents(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    known = {r.doc_id: r.quality for r in labels.collect()}
    # Learned without every third label, judged on those.
    learned = q.quality(docs, labels.filter("doc_id % 3 <> 0"))
    rows = learned.collect()
    held = [(r.quality, known[r.doc_id]) for r in rows if r.doc_id in known and r.doc_id % 3 == 0]
    assert len(rows) == docs.count() and len(held) > 100
    assert auc(held) > 0.98
    clean = [s >= q.THRESHOLD for s, y in held if y]
    assert sum(clean) >= 0.97 * len(clean)
    assert all(0 <= r.quality <= 1 and r.kept == (r.quality >= q.THRESHOLD) for r in rows)


def test_sites_shrink_towards_the_level_above(spark):
    rows = [("big", "a", 1.0)] * 300 + [("big", "a", 0.0)] * 100 + [("bad", "b", 0.0)] * 200 + [("bad", "b", 1.0)] * 10
    rows += [("one", "c", 0.0), ("big", "tiny", 0.0), (None, None, 1.0)]
    got = {(r.host, r.path): r for r in q.site_posteriors(spark.createDataFrame(rows, "host string, path string, good double")).collect()}
    overall = (sum(g for *_, g in rows) + 1) / (len(rows) + 2)
    assert abs(got["big", "a"].host_posterior - 0.75) < 0.03 and got["bad", "b"].host_posterior < 0.12
    # One bad document says little: its site stays nearer to the level above than to its own rate.
    assert got["one", "c"].host_posterior > overall / 3
    assert got["big", "tiny"].path_posterior > got["one", "c"].path_posterior
    assert overall < got[None, None].host_posterior < 1


def test_edge_cases(spark):
    text = "Plain words in a row that tell a story of some kind, and then end. "
    rows = [(i, text * (1 + i % 4), "en", "a") for i in range(30)] + [(100 + i, "BUY!! NOW!! " * 30, "en", "b") for i in range(30)]
    rows += [(1000, None, None, None), (1001, "", "en", None), (None, text, None, "a"), (5, text, "en", "a"), (1002, text * 20_000, "en", "c")]
    labels = [(i, 1) for i in range(20)] + [(100 + i, 0) for i in range(20)] + [(None, 1), (3, None), (4, 1), (9999, 0)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], DOCS + ", quality double").repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    got = q.quality(docs, known).collect()
    assert len(got) == len(rows) and all(np.isfinite(r.quality) for r in got)
    assert all(r.kept for r in got if r.doc_id is not None and r.doc_id < 30)
    assert not any(r.kept for r in got if r.doc_id is not None and 100 <= r.doc_id < 130)
    kept = q.good_documents(docs, known)
    assert kept.columns == docs.columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(r.doc_id) for r in got if r.kept)


@pytest.mark.parametrize("labels", [[], [(1, 1)]])
def test_without_labels_or_documents(spark, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    some = spark.createDataFrame([(1, "a b", "en", "s"), (2, None, "en", "s")], DOCS)
    assert {r.evidence for r in q.quality(some, known).collect()} == {0.0}
    none = spark.createDataFrame([], DOCS)
    assert q.quality(none, known).collect() == [] and q.good_documents(none, known).collect() == []
