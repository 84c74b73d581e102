"""Membership filters of segments."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from shelfmark.plans import membership as m
from shelfmark.plans.collection import Collection
from shelfmark.schemas import POINTS


def rows_of(spark, start, stop, step=1):
    ids = spark.range(start, stop, step)
    text = F.concat(F.lit("k"), F.col("id"))
    return ids.select(text.alias("id"), F.when(F.col("id") % 10 > 0, F.concat(F.lit("Q"), F.floor(F.col("id") / 4))).alias("qid"))


def test_filter_size():
    assert [m.filter_size(n) for n in (0, 1, 2048, 2049, 4096, 4097, 10**9)] == [1, 1, 1, 2, 2, 4, 524288]


def test_members_are_never_ruled_out(spark):
    held = rows_of(spark, 0, 20_000).cache()
    made = m.build_filter(held.unionByName(held), ["id", "qid"], 20_000).withColumn("segment", F.lit(3))
    assert made.filter("length(bits) <> 4096").count() == 0 and made.count() <= 32
    found = m.may_hold(made, held.select("id"), "id")
    assert found.distinct().count() == 20_000 and found.first().segment == 3
    strangers = m.may_hold(made, rows_of(spark, 50_000, 70_000).select("id"), "id").count()
    assert strangers < 60  # one in 2,000 or fewer
    assert m.may_hold(made, held.select("qid"), "qid").count() == held.select("qid").distinct().count() - 1
    assert m.may_hold(made, held.select("qid").filter("qid is null"), "qid").count() == 0
    assert m.may_hold(made.limit(0), held.select("id"), "id").count() == 0
    empty = m.build_filter(held.limit(0), ["id"], 0).withColumn("segment", F.lit(1))
    assert m.may_hold(empty, held.select("id"), "id").count() == 0


def test_folded_filters_hold_both(spark):
    one = m.build_filter(rows_of(spark, 0, 9_000), ["id"], 9_000)
    two = m.build_filter(rows_of(spark, 9_000, 10_000), ["id"], 1_000)
    both = m.fold(one.unionByName(two), 1).withColumn("segment", F.lit(0))
    assert both.count() == 1
    assert m.may_hold(both, rows_of(spark, 0, 10_000).select("id"), "id").count() == 10_000


def points_of(spark, start, stop, text="t", step=1):
    made = rows_of(spark, start, stop, step).withColumn("component", F.lit("c")).withColumn("vector", F.array(F.lit(1.0)))
    made = made.withColumn("page_content", F.lit(text)).withColumn("payload", F.create_map(F.lit("k"), F.lit("v")))
    return made.select(POINTS.fieldNames())


@pytest.fixture
def filled(spark, tmp_path):
    target = Collection(spark, str(tmp_path))
    target.ensure(1)
    for start in (0, 1_000, 2_000):
        target.upsert(points_of(spark, start, start + 1_000))
    return target


def test_small_write_opens_the_segments_that_may_hold_its_ids(spark, filled):
    small = points_of(spark, 1_200, 1_205, "new")
    assert filled.may_replace(small) == [1]
    assert filled.may_replace(points_of(spark, 9_000, 9_003)) == []
    assert filled.may_replace(small, ["qid", "component"]) == [1]
    assert filled.may_replace(small, ["component"]) is None
    # Files of segments that cannot hold them are spoilt: the writes do not notice.
    spoilt = {}
    for segment in (0, 2):
        for path in glob.glob(f"{filled.root}/data/segment={segment}/*.parquet"):
            spoilt[path] = open(path, "rb").read()
            with open(path, "wb") as out:
                out.write(b"x" * len(spoilt[path]))
            crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
            spoilt[crc] = open(crc, "rb").read()
            os.remove(crc)
    filled.upsert(small)
    filled.upsert(points_of(spark, 9_000, 9_003))
    filled.upsert(points_of(spark, 1_203, 1_204, "newest"))
    for path, content in spoilt.items():
        with open(path, "wb") as out:
            out.write(content)
    assert filled.size() == filled.points().count() == filled.points().select("id").distinct().count() == 3_003
    assert sorted(r.page_content for r in filled.points().filter("page_content <> 't'").collect()) == ["new"] * 4 + ["newest"]


def test_documents_are_replaced_through_the_filter(spark, filled):
    doc = points_of(spark, 1_201, 1_202, "short").withColumn("id", F.lit("other"))
    filled.upsert(doc, replace_by=["qid", "component"])
    # k1200 has no item; k1201, k1202 and k1203 are of Q300.
    left = {r.id for r in filled.points().filter(F.col("id").isin("k1200", "k1201", "k1202", "k1203", "k1204", "other")).collect()}
    assert left == {"k1200", "k1204", "other"} and filled.size() == 2_998
    filled.compact()
    assert filled.may_replace(points_of(spark, 5, 6)) == [4] and filled.may_replace(points_of(spark, 1_201, 1_202)) == []


def test_segments_without_a_filter_count_as_holding_everything(spark, filled):
    old = filled.commits().withColumn("filtered", F.when(F.col("segment") != 2, F.col("filtered"))).collect()
    spark.createDataFrame(old, filled.commits().schema).write.mode("overwrite").parquet(f"{filled.root}/commits")
    assert filled.may_replace(points_of(spark, 5, 6)) == [0, 2]
