from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as c
from shelfmark.llm.mixing import mix
from shelfmark.llm.quality import quality
from tests.llm.test_packing import check
from tests.llm.test_simhash import expected as simhash_expected

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage keeps of the given documents, and of what it was given."""
    folder = tmp_path_factory.mktemp("stages")
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(c.STAGES):
        stage(spark, out[-1], sf_dir).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_keep_columns_and_whole_rows(kept):
    docs = Counter(map(tuple, kept[0].collect()))
    for df in kept[1:5]:
        assert df.columns == kept[0].columns
        assert not Counter(map(tuple, df.collect())) - docs


def test_quality_stage(spark, kept):
    verdict = quality(kept[0], spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    assert {r.doc_id for r in kept[1].collect()} == {r.doc_id for r in verdict.filter("kept").collect()}
    assert 0.7 < kept[1].count() / kept[0].count() < 1


def test_exact_stage(kept):
    groups = defaultdict(list)
    for i, t in rows(kept[1]):
        groups[t.encode().lower()].append(i)
    assert sorted(i for i, _ in rows(kept[2])) == sorted(map(max, groups.values()))


def test_simhash_stage(kept):
    assert sorted(i for i, _ in rows(kept[3])) == sorted({g for _, _, g in simhash_expected(rows(kept[2]))})


def test_mixing_stage(kept):
    assert Counter(map(tuple, kept[4].collect())) == Counter(map(tuple, kept[3].collect()))
    order = [r.doc_id for r in mix(kept[3]).orderBy("position").collect()]
    assert [i for i, _ in rows(kept[4].coalesce(1))] == order


def test_packing_stage(kept):
    check(rows(kept[4]), kept[5])


def test_run_passes_every_stage_what_the_one_before_kept(spark, monkeypatch):
    seen = []

    def stage(name, last=False):
        def run(spark, docs, sf_dir):
            seen.append((name, docs.count(), sf_dir))
            return docs.limit(1) if last else docs.filter(F.col("doc_id") % (len(seen) + 1) == 0)

        return name, run

    monkeypatch.setattr(c, "STAGES", [stage("a b"), stage("c"), stage("d", True)])
    assert c.run(spark, "/root/testdata/sf0.001").count() == 1
    assert seen == [("a b", 200, "/root/testdata/sf0.001"), ("c", 100, "/root/testdata/sf0.001"), ("d", 34, "/root/testdata/sf0.001")]


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "some text", "en", "a", 9), (3, "Some text", "en", "a", 9)] * 2, DOCS
    )
    for df in (docs, docs.limit(0)):
        for _, stage in c.STAGES[1:]:
            out = stage(spark, df, "")
            assert out.count() <= 8 and (df.isEmpty() or out.count() >= 2)
