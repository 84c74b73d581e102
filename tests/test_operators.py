"""Operators on small inputs, against plain Python."""

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import context, counts, guard, items, joins, ordinals, packages, runlog, textindex
from shelfmark.operators.backlog import backlog, item_overlap, known_items, status_kind, without_status
from shelfmark.operators.joins import narrow_join, salted_join, skew_join
from shelfmark.operators.upsert import latest_by_key, upsert
from shelfmark.session import stage
from tests.conftest import column

NOW = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
STATUS = "qid string, component string, updated_at timestamp, status string"


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


@pytest.fixture
def state(table):
    files = table([("Q1", "c1"), ("Q1", "c2"), ("Q1", "c3"), ("Q2", "c4"), ("Q3", "c5"), ("Q1", "c6")], "qid string, component string")
    known = table([("Q1",), ("Q2",), ("Q9",)], "qid string")
    old = datetime(2023, 1, 1, tzinfo=timezone.utc)
    status = table(
        [("Q1", "c1", old, "ok"), ("Q1", "c2", old, "planned"), ("Q1", "c3", old, "failed - TimeoutError"), ("Q1", "c6", old, None)],
        STATUS,
    )
    return files, known, status


def test_backlog_rules(state):
    files, known, status = state
    assert rows(backlog(files, known, status, "new")) == [("Q2", "c4")]
    assert rows(backlog(files, known, status, "retry")) == [("Q1", "c3"), ("Q1", "c6"), ("Q2", "c4")]
    expired = backlog(files, known, status, "retry", planned_ttl=timedelta(days=1), now=NOW)
    assert rows(expired) == [("Q1", "c2"), ("Q1", "c3"), ("Q1", "c6"), ("Q2", "c4")]
    kept = backlog(files, known, status, "retry", planned_ttl=timedelta(days=1000), now=NOW)
    assert rows(kept) == [("Q1", "c3"), ("Q1", "c6"), ("Q2", "c4")]
    assert rows(without_status(files, status, ["ok"])) == [("Q1", "c2"), ("Q1", "c3"), ("Q1", "c6"), ("Q2", "c4"), ("Q3", "c5")]
    assert rows(item_overlap(files, known)) == [("Q1",), ("Q2",)]
    with pytest.raises(ValueError):
        backlog(files, known, status, "other")


def test_two_pending_files(table):
    files = table([("Q1", "c1"), ("Q2", "c2")], "qid string, component string")
    known = table([("Q1",), ("Q2",)], "qid string")
    assert backlog(files, known, table([], STATUS)).count() == 2


def test_backlog_uses_anti_join(state):
    plan = backlog(*state, "new")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti", "left"])
@pytest.mark.parametrize("small", [True, False])
def test_skew_join_equals_plain_join(table, monkeypatch, how, small):
    monkeypatch.setattr(joins, "is_small", lambda df: small)
    rng = random.Random(1)
    # A third of the left rows share one key.
    keys = [None if x < 0.2 else "hot" if x < 0.5 else f"k{rng.randint(0, 9)}" for x in (rng.random() for _ in range(300))]
    left = table([(k, i) for i, k in enumerate(keys)], "k string, i int")
    right = table([("hot", 1), ("k1", 2), ("k2", 3), ("zz", 4), (None, 5)], "k string, v int")
    right = right if how in ("inner", "left") else right.select("k")
    expected = rows(left.join(right, "k", how).na.fill(-1).na.fill("-"))
    for join in (skew_join, narrow_join, salted_join):
        assert rows(join(left, right, ["k"], ["i"], how).na.fill(-1).na.fill("-")) == expected
    with pytest.raises(ValueError):
        skew_join(left, right, ["k"], ["i"], "cross")


def test_is_small(table):
    three = table([(1, "abc"), (2, "é"), (3, None)], "x int, s string")
    assert joins.is_small(three, 53) and not joins.is_small(three, 52) and joins.is_small(three.limit(0), 0)


def test_rows_without_a_key_are_spread(table):
    left = table([(None, i) for i in range(50)], "k string, i int")
    right = table([("a",)], "k string")
    spread = joins.skew_join(left, right, ["k"], ["i"], "left_anti")
    assert spread.count() == 50 and spread.columns == ["k", "i"]
    assert "_spread" in spread._jdf.queryExecution().optimizedPlan().toString()


def test_latest_by_key(table):
    df = table([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("a", 2, "w"), ("b", None, "q")], "k string, t int, v string")
    assert rows(latest_by_key(df, ["k"], ["t"])) == [("a", 2, "y"), ("b", 1, "z")]
    mapped = df.withColumn("m", F.create_map(F.lit("v"), F.col("v")))
    assert rows(latest_by_key(mapped, ["k"], ["t"]), "k", "v") == [("a", "y"), ("b", "z")]


def test_upsert(table):
    base = table([("Q1", "c1", NOW, "ok"), ("Q2", "c2", NOW, "planned")], STATUS)
    delta = table([("Q2", "c2", NOW, "ok"), ("Q3", "c3", NOW, None)], STATUS)
    assert rows(upsert(base, delta, ["qid", "component"]).na.fill("-"), "qid", "status") == [("Q1", "ok"), ("Q2", "ok"), ("Q3", "-")]
    twice = table([("Q2", "c2", NOW, "a", 1), ("Q2", "c2", NOW, "b", 2)], STATUS + ", seq int")
    assert rows(upsert(base, twice, ["qid", "component"], ["seq"]), "qid", "status") == [("Q1", "ok"), ("Q2", "b")]
    with pytest.raises(Exception, match="must not be null"):
        upsert(base, table([(None, "c", NOW, "ok")], STATUS), ["qid", "component"]).collect()


def test_running_offset_over_blocks(table):
    rng = random.Random(2)
    data = [("hot", i, rng.randint(0, 3)) for i in range(200)] + [("cold", i * 50, 1) for i in range(5)]
    rng.shuffle(data)
    df = table(data, "g string, o int, v int")
    found = ordinals.running_offset(df, ["g"], "o", F.col("v"), "off", block=16)
    expected, seen = [], defaultdict(int)
    for g, o, v in sorted(data):
        expected.append((g, o, v, seen[g]))
        seen[g] += v
    assert rows(found, "g", "o", "v", "off") == expected


def test_with_ordinal(table):
    data = [(f"k{i % 7}", i) for i in range(500)]
    found = ordinals.with_ordinal(table(data, "k string, i int").repartition(5), ["k", "i"])
    assert rows(found, "ordinal", "k", "i") == [(n, k, i) for n, (k, i) in enumerate(sorted(data))]


def test_item_pages(table, monkeypatch):
    source = table([(f"Q{i}",) for i in (4, 2, 1, 3)], "qid string")
    ordered = ["Q1", "Q2", "Q3", "Q4"]
    assert column(items.new_items(source, table([], "qid string"), 3), "qid") == ordered[:3]
    known = table([("Q1",), ("Q3",)], "qid string")
    assert sorted(column(items.new_items(source, known), "qid")) == ["Q2", "Q4"]
    assert column(items.new_items(source, known, 1), "qid") == ["Q2"]
    assert column(items.new_items(source, known, 1, "offset"), "qid") == ["Q3"]
    monkeypatch.setattr(items, "IN_TASK_ROWS", 0)
    assert column(items.page(source, "qid", 1, 2), "qid") == ["Q2", "Q3"]
    assert column(items.page(source, "qid", 2), "qid") == ["Q3", "Q4"]
    with pytest.raises(ValueError):
        items.page(source, "qid", -1)


@pytest.mark.parametrize("in_task", [0, 1_000_000])
def test_packages(table, monkeypatch, in_task):
    monkeypatch.setattr(packages, "IN_TASK_ROWS", in_task)
    pending = table([(f"Q{i:02d}", f"c{i}") for i in range(25)], "qid string, component string")
    whole = packages.cut_packages(pending, 10)
    assert rows(whole.groupBy("package").count()) == [(0, 10), (1, 10), (2, 5)]
    two = packages.cut_packages(pending, 10, 2)
    assert rows(two, "package", "position", "qid")[-1] == (1, 9, "Q19")
    made = packages.package_documents(two, F.lit("sum"), F.lit("now"))
    body = packages.package_json(made).orderBy("package_id").collect()[0]
    assert body.package_id == "plan_localworker_01"
    assert body.body.startswith('{"planner_version":"1.0","created_at":"now","state_db_checksum":"sum"')
    assert '{"qid":"Q00","component":"c0","document_type":"CRAN_PACKAGE"}' in body.body
    assert column(packages.reservations(two, NOW).select("status").distinct(), "status") == ["planned"]
    for size, n in ((0, 1), (1, 0), (-1, None)):
        with pytest.raises(ValueError):
            packages.cut_packages(pending, size, n)


def test_counts_and_message(table):
    two = {"a": table([(1,), (2,)], "x int"), "b": table([], "x int")}
    current = counts.table_counts(two)
    baseline = table([("a", 5)], "table string, n bigint")
    deltas = counts.count_deltas(current, baseline)
    assert rows(deltas, "table", "n", "delta") == [("a", 2, -3), ("b", 0, 0)]
    assert column(counts.count_message(deltas), "message") == ["Updated state tables [a:2 (-3); b:0 (+0)]"]
    plain = counts.count_message(counts.count_deltas(current, None), "Saved")
    assert column(plain, "message") == ["Saved [a:2; b:0]"]


def test_freshness(table):
    def fresh(*ages):
        data = [(NOW - timedelta(minutes=m),) for m in ages]
        return counts.freshness(table(data, "updated_at timestamp"), NOW).collect()[0].is_fresh

    assert fresh(59, 500) and not fresh(60) and not fresh()


def test_page_guard(table, monkeypatch):
    pages = table([("Q1", "a", i, "x" * i) for i in range(4)] + [("Q2", "b", 0, "yy")], "qid string, component string, page int, text string")
    assert rows(guard.page_stats(pages)) == [("Q1", "a", 4, 6), ("Q2", "b", 1, 2)]
    too_large = guard.oversized(pages, 3)
    assert rows(too_large, "qid", "status") == [("Q1", "failed - PDF too large (4 pages)")]
    assert rows(guard.within_limit(pages, too_large), "qid") == [("Q2",)]
    monkeypatch.setattr(joins, "is_small", lambda df: False)
    assert rows(guard.within_limit(pages, too_large), "qid") == [("Q2",)]
    assert guard.oversized(pages, None).count() == 0
    assert guard.oversized(pages, 4).count() == 0


def test_lexical_match(spark, table, tmp_path, monkeypatch):
    docs = table([("d1", "The cat sat. The mat."), ("d2", "A dog sat"), ("d3", None), ("d4", "...")], "id string, page_content string")
    index = textindex.postings(docs)
    assert rows(index.filter("token = 'the'")) == [("the", "d1")]
    assert rows(textindex.document_frequency(index).filter("n_docs > 1")) == [("sat", 2)]
    queries = table([(1, "SAT cat"), (2, "sat"), (3, "bird")], "query_id int, text string")
    assert rows(textindex.lexical_match(index, queries, "and")) == [(1, "d1", 2), (2, "d1", 1), (2, "d2", 1)]
    with monkeypatch.context() as m:
        m.setattr(joins, "is_small", lambda df: False)
        assert rows(textindex.lexical_match(index, queries, "and")) == [(1, "d1", 2), (2, "d1", 1), (2, "d2", 1)]
    assert rows(textindex.lexical_match(index, queries, "or")) == [(1, "d1", 2), (1, "d2", 1), (2, "d1", 1), (2, "d2", 1)]
    path = str(tmp_path / "index")
    textindex.write_index(index, path)
    stored = spark.read.parquet(path)
    assert rows(textindex.lookup(stored, ["sat", "cat"]), "token", "id") == [("cat", "d1"), ("sat", "d1"), ("sat", "d2")]
    assert rows(textindex.lexical_match(stored, queries, "and")) == [(1, "d1", 2), (2, "d1", 1), (2, "d2", 1)]
    plan = textindex.lookup(stored, ["sat"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_contexts_and_prompts(table):
    ranked = table([(1, r, f"t{r}") for r in (3, 1, 2, 4)] + [(2, 1, "only {question}")], "query_id int, rank int, page_content string")
    made = context.contexts(ranked)
    assert rows(made) == [(1, "t1\n\nt2\n\nt3"), (2, "only {question}")]
    asked = table([(1, "why?"), (2, "how?"), (3, "who?")], "query_id int, question string")
    found = context.prompts(asked, made, "Q:{question} C:{context}!")
    assert rows(found) == [(1, "Q:why? C:t1\n\nt2\n\nt3!"), (2, "Q:how? C:only {question}!"), (3, "Q:who? C:!")]


def test_run_log(table):
    status = table([("ok",), ("ok",), ("failed - PDF too large (9 pages)",)], "status string")
    assert rows(runlog.run_summary(status)) == [("failed", 1), ("ok", 2)]
    assert column(status.limit(1), status_kind(F.lit("failed - TimeoutError"))) == ["failed"]
    times = [datetime(2024, 1, 1, h, m, tzinfo=timezone.utc) for h, m in ((0, 1), (0, 59), (1, 30), (3, 0))]
    steps = runlog.progress(table([("r", t) for t in times], "run string, ts timestamp"), ["run"], "ts", F.count("*"))
    assert rows(steps, "completed", "remaining", "eta") == [(2, 2, "1h 0m"), (3, 1, "40m 0s"), (4, 0, "unknown")]


def test_known_items_spreads_hot_item(table, monkeypatch):
    files = table([("hot", f"c{i}") for i in range(100)] + [("cold", "x"), ("none", "y")], "qid string, component string")
    known = table([("hot",), ("cold",)], "qid string")
    assert known_items(files, known).count() == 101
    monkeypatch.setattr(joins, "is_small", lambda df: False)
    assert known_items(files, known).count() == 101


def test_postings_are_stored_where_their_texts_are(spark, tmp_path):
    rows = spark.range(40).selectExpr("id", "concat('all of w', id % 3) as page_content").repartition(4)
    made = stage(rows, "texts").withColumn("part", F.spark_partition_id())
    home = {r.id: r.part for r in made.select("id", "part").collect()}
    textindex.write_index(textindex.postings(made), str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index")).withColumn("file", F.input_file_name())
    parts = {}
    for r in stored.collect():
        parts.setdefault(r.file, set()).add(home[r.id])
    # No posting is moved: a file holds what one task read.
    assert stored.count() == 120 and all(len(p) == 1 for p in parts.values())
    textindex.write_index(textindex.postings(made), str(tmp_path / "few"), writers=1)
    files = {r[0] for r in spark.read.parquet(str(tmp_path / "few")).select(F.input_file_name()).collect()}
    assert len(files) == stored.select("bucket").distinct().count()


def test_lists_hold_the_postings(spark, table, tmp_path):
    made = [(f"d{i}", " ".join(f"w{j}" for j in range(i % 7))) for i in range(60)] + [("none", None), ("dots", "..."), ("twice", "w1"), ("twice", "w1")]
    docs = table(made, "id string, page_content string").repartition(3)
    path = str(tmp_path / "lists")
    textindex.write_lists(docs, path, most=20)
    stored = spark.read.schema(f"{textindex.LISTS}, bucket int").parquet(path)
    plain = rows(textindex.postings(docs), "token", "id")
    assert rows(textindex.open_lists(stored), "token", "id") == plain
    some = table([("w1",), ("w5",), ("elsewhere",)], "token string")
    assert rows(textindex.open_lists(stored, wanted=some), "token", "id") == [p for p in plain if p[0] in ("w1", "w5")]
    # A part is bounded, an id is stored once per part, and a word once per part.
    assert stored.groupBy("part").agg(F.sum(F.greatest(F.size("texts"), F.lit(0))).alias("n")).agg(F.max("n")).first()[0] <= 20
    assert stored.filter("token is not null").groupBy("part", "token").count().filter("count > 1").count() == 0
    assert stored.filter("ids is not null").selectExpr("explode(ids)").count() == sum(1 for _, t in made if t and t.strip("."))
    textindex.write_lists(docs.filter("id = 'none'"), str(tmp_path / "empty"))
    assert textindex.open_lists(spark.read.schema(f"{textindex.LISTS}, bucket int").parquet(str(tmp_path / "empty"))).count() == 0


def test_a_text_of_many_words_stands_alone(table, spark, tmp_path):
    docs = table([("a", "x y"), ("b", "p q r s t u"), ("c", "x")], "id string, page_content string").coalesce(1)
    textindex.write_lists(docs, str(tmp_path / "lists"), most=3)
    stored = spark.read.schema(f"{textindex.LISTS}, bucket int").parquet(str(tmp_path / "lists"))
    assert [sorted(r.ids) for r in stored.filter("ids is not null").orderBy("part").collect()] == [["a"], ["b"], ["c"]]
    assert rows(textindex.open_lists(stored), "token", "id") == rows(textindex.postings(docs), "token", "id")
