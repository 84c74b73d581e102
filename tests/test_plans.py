"""Snapshots, collections and whole runs."""

import os
import time
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.operators.embedding import HashedEmbedder, ModelEmbedder, row_embedder
from shelfmark.operators.limits import LimitedCalls, OverTime
from shelfmark.operators.textindex import lookup, postings, write_index
from shelfmark.plans.collection import Collection, added_points
from shelfmark.plans.embed import embed_backlog
from shelfmark.plans.planning import plan_packages
from shelfmark.plans.refresh import refresh_files, refresh_items
from shelfmark.plans.run import incremental_run, run_package
from shelfmark.plans.state import StateStore, Tree, state_name
from shelfmark.schemas import FILES, ITEMS, STATUS, ChunkParams
from shelfmark.session import empty, list_names
from shelfmark.sources.objects import file_reader

NOW = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
POINT = "id string, qid string, component string, vector array<float>, page_content string, payload map<string,string>"


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


@pytest.fixture
def store(spark, tmp_path):
    return StateStore(spark, str(tmp_path / "state"))


@pytest.fixture
def collection(spark, tmp_path):
    return Collection(spark, str(tmp_path / "points"))


def test_state_tables_exist_after_init(store):
    assert not store.exists() and store.latest() is None
    assert store.init() and not store.init()
    assert list(store.read()) == ["software_index", "component_index", "embeddings_index"]
    assert all(df.count() == 0 for df in store.read().values())


def test_publish_only_changes_and_keep_former(spark, store):
    tables = store.read()
    first = store.publish(tables, now=NOW)
    assert first.changed and first.snapshot_id == "20240101T120000Z-000001"
    again = store.publish(store.read(), now=NOW + timedelta(hours=1))
    assert not again.changed and again.snapshot_id == first.snapshot_id
    tables["software_index"] = spark.createDataFrame([("Q1", NOW)], ITEMS)
    second = store.publish(tables, store.counts(), now=NOW + timedelta(hours=2))
    assert second.changed
    assert second.message == "Updated state tables [software_index:1 (+1); component_index:0 (+0); embeddings_index:0 (+0)]"
    assert store.read(first.snapshot_id)["software_index"].count() == 0
    assert store.read()["software_index"].count() == 1
    assert store.manifest().count() == 2
    assert rows(store.counts(), "table", "n")[2] == ("software_index", 1)


def test_null_keys_are_rejected(spark, store):
    tables = store.read()
    tables["software_index"] = spark.sql("select cast(null as string) qid, current_timestamp() updated_at")
    with pytest.raises(Exception, match="must not be null"):
        store.publish(tables)
    assert not store.exists()


def test_state_name():
    assert state_name("state", "docs") == "state__docs"


def points(spark, data):
    return spark.createDataFrame([(i, q, c, v, t, {"qid": q}) for i, q, c, v, t in data], POINT)


def test_collection_upserts(spark, collection):
    assert not collection.exists()
    with pytest.raises(ValueError):
        collection.upsert(points(spark, [("a", "Q1", "c", [1.0], "x")]))
    collection.ensure(1)
    collection.ensure(1)
    assert collection.size() == 0 and collection.points().count() == 0
    assert collection.upsert(points(spark, [("a", "Q1", "c", [1.0], "old"), ("b", "Q1", "c", [1.0], "kept")])) == 2
    collection.upsert(points(spark, [("a", "Q1", "c", [2.0], "new"), ("z", "Q2", "d", [3.0], "more")]))
    assert rows(collection.points(), "id", "page_content") == [("a", "new"), ("b", "kept"), ("z", "more")]
    assert collection.size() == 3
    collection.upsert(points(spark, [("a", "Q1", "c", [4.0], "newest")]), replace_by=["qid"])
    assert rows(collection.points(), "id", "page_content") == [("a", "newest"), ("z", "more")]
    collection.compact()
    assert rows(collection.points(), "id", "page_content") == [("a", "newest"), ("z", "more")] and collection.size() == 2
    collection.upsert(points(spark, [("z", "Q2", "d", [4.0], "again")]))
    assert rows(collection.points(), "id", "page_content") == [("a", "newest"), ("z", "again")] and collection.size() == 2
    with pytest.raises(Exception, match="vector size must be 1"):
        collection.upsert(points(spark, [("y", "Q2", "d", [1.0, 2.0], "x")]))
    # The failed write left nothing that counts.
    assert collection.size() == 2 and collection.points().count() == 2
    with pytest.raises(ValueError):
        collection.ensure(2)
    collection.recreate(2)
    assert collection.size() == 0 and collection.describe().vector_size == 2
    assert added_points(2, 5) == 3 and added_points(None, 5) is None


def test_text_index_follows_the_points(spark, collection):
    collection.ensure(1)
    assert collection.text_index().count() == 0
    collection.upsert(points(spark, [("a", "Q1", "c", [1.0], "red fox"), ("b", "Q1", "c", [1.0], "red hen")]))
    assert rows(collection.text_index(), "token", "id") == [("fox", "a"), ("hen", "b"), ("red", "a"), ("red", "b")]
    collection.upsert(points(spark, [("a", "Q1", "c", [1.0], "blue fox")]))
    assert rows(lookup(collection.text_index(), ["red", "blue"]), "token", "id") == [("blue", "a"), ("red", "b")]
    collection.compact()
    assert collection.text_index().count() == 4
    asked = spark.createDataFrame([(1, "fox blue"), (2, "red")], "query_id int, text string")
    assert rows(collection.search_text(asked), "query_id", "id") == [(1, "a"), (2, "b")]
    assert rows(collection.search_text(asked, "or", 1), "query_id", "id", "rank") == [(1, "a", 1), (2, "b", 1)]


def test_text_index_is_stored_as_lists(spark, collection):
    collection.ensure(1)
    collection.upsert(points(spark, [(f"p{i}", "Q1", "c", [1.0], "red fox") for i in range(50)]))
    assert spark.read.parquet(f"{collection.root}/words").count() < collection.text_index().count() == 100


def test_text_index_of_former_segments(spark, collection):
    """A segment from before there were lists has a row per posting."""
    collection.ensure(1)
    collection.upsert(points(spark, [("a", "Q1", "c", [1.0], "red fox"), ("b", "Q1", "c", [1.0], "red hen")]))
    os.rename(f"{collection.root}/words", f"{collection.root}/words-gone")
    write_index(postings(collection.points()), f"{collection.root}/text/segment=0")
    assert rows(collection.text_index(), "token", "id") == [("fox", "a"), ("hen", "b"), ("red", "a"), ("red", "b")]
    collection.upsert(points(spark, [("a", "Q1", "c", [1.0], "blue fox")]))
    asked = spark.createDataFrame([(1, "red"), (2, "fox")], "query_id int, text string")
    assert rows(collection.search_text(asked), "query_id", "id") == [(1, "b"), (2, "a")]
    assert rows(collection.text_index(), "token", "id") == [("blue", "a"), ("fox", "a"), ("hen", "b"), ("red", "b")]
    collection.compact()
    assert rows(collection.text_index(), "token", "id") == [("blue", "a"), ("fox", "a"), ("hen", "b"), ("red", "b")]


def test_collection_distance(spark, tmp_path):
    made = Collection(spark, str(tmp_path), "c", "manhattan")
    made.ensure(3)
    reopened = Collection(spark, str(tmp_path), "c")
    reopened.ensure(3)
    assert reopened.distance == "MANHATTAN"


def test_unfinished_segment_is_ignored(spark, collection):
    collection.ensure(1)
    collection.upsert(points(spark, [("a", "Q1", "c", [1.0], "x")]))
    stray = points(spark, [("b", "Q1", "c", [1.0], "stray")])
    stray.write.parquet(f"{collection.root}/data/segment=1")
    assert rows(collection.points(), "id") == [("a",)]
    collection.upsert(points(spark, [("c", "Q1", "c", [1.0], "y")]))
    assert rows(collection.points(), "id") == [("a",), ("c",)]


def test_refresh_items(spark):
    state = spark.createDataFrame([("Q1", NOW)], ITEMS)
    source = spark.createDataFrame([(f"Q{i}",) for i in range(1, 6)], "qid string")
    later = NOW + timedelta(days=1)
    assert rows(refresh_items(state, source, 2, now=later), "qid", "updated_at") == [
        ("Q1", NOW.replace(tzinfo=None)), ("Q2", later.replace(tzinfo=None)), ("Q3", later.replace(tzinfo=None))
    ]
    assert refresh_items(state, source).count() == 5


def test_refresh_files_waits_an_hour(spark):
    state = spark.createDataFrame([("Q1", "main/Q1/a.pdf", NOW)], FILES)
    listing = spark.createDataFrame([("main/Q1/a.pdf",), ("main/Q2/b.PDF",), ("main/c.pdf",), ("main/Q3/d.csv",)], "key string")
    assert refresh_files(state, listing, NOW + timedelta(minutes=30)).count() == 1
    refreshed = refresh_files(state, listing, NOW + timedelta(hours=2))
    assert rows(refreshed, "qid", "component") == [("Q1", "main/Q1/a.pdf"), ("Q2", "main/Q2/b.PDF")]
    assert refreshed.select("updated_at").distinct().count() == 1


CONTENTS = "key string, content binary"


def embed(spark, collection, files, status=None, embedder=None, **options):
    contents = spark.createDataFrame(files, CONTENTS)
    todo = contents.select(F.lit("Q1").alias("qid"), F.col("key").alias("component"))
    status = empty(spark, STATUS) if status is None else status
    return embed_backlog(todo, contents, status, collection, embedder or HashedEmbedder(8), now=NOW, **options)


def test_one_pending_file(spark, collection):
    run = embed(spark, collection, [("attic/moss.txt", b"Moss grows on the north side.")])
    assert rows(run.status, "qid", "component", "status") == [("Q1", "attic/moss.txt", "ok")]
    assert rows(run.summary) == [("ok", 1)] and run.points_added == 1
    payload = collection.points().collect()[0].payload
    assert payload["qid"] == "Q1" and payload["chunk_index"] == "0" and payload["package"] == "unknown"


def test_outcomes(spark, collection):
    files = [
        ("d/pkg_1.0.pdf", b"one\ntwo"), ("d/long.pdf", b"1\n2\n3\n4"), ("d/bad.doc", b"?"), ("d/none.pdf", b""), ("d/done.txt", b"x"),
    ]
    status = spark.createDataFrame([("Q1", "d/done.txt", NOW, "failed - TimeoutError")], STATUS)
    extract = {"pdf": lambda content: content.decode().split("\n") if content else []}
    run = embed(spark, collection, files, status, extractors=extract, max_pages=3)
    assert rows(run.status, "component", "status") == [
        ("d/done.txt", "failed - TimeoutError"), ("d/long.pdf", "failed - PDF too large (4 pages)"), ("d/pkg_1.0.pdf", "ok"),
    ]
    assert rows(run.quarantine, "component") == [("d/bad.doc",)]
    assert rows(run.summary) == [("failed", 1), ("ok", 1)]
    assert rows(collection.points(), "page_content") == [("one",), ("two",)]
    assert collection.points().collect()[0].payload["package"] == "pkg"
    again = embed(spark, collection, files[:1], run.status, extractors=extract)
    assert again.points_added == 0 and again.summary.count() == 0
    retried = embed(spark, collection, files[4:], run.status, skip_statuses=["ok", "planned"])
    assert ("d/done.txt", "ok") in rows(retried.status, "component", "status")


def test_documents_the_model_rejects(spark, collection):
    def factory():
        def model(texts):
            if any("bad" in t for t in texts):
                raise ValueError("rejected")
            return np.ones((len(texts), 2))

        return model

    files = [("a.txt", b"good one\x0cbad page"), ("b.txt", b"good two"), ("c.txt", b"Some bad. Some good. More.")]
    params = ChunkParams(buffer_size=1)
    run = embed(spark, collection, files, embedder=ModelEmbedder(factory, 2), params=params, id_cols=("qid", "component"))
    assert rows(run.status, "component", "status") == [("b.txt", "ok")]
    assert rows(run.quarantine, "component", "error") == [("a.txt", "ValueError: rejected"), ("c.txt", "ValueError: rejected")]
    assert rows(collection.points(), "page_content") == [("good two",)]
    run.release()
    assert collection.points().count() == 1


def test_points_are_written_once(spark, collection):
    run = embed(spark, collection, [("a.txt", b"one\x0ctwo"), ("b.txt", b"three")], id_cols=("qid", "component"))
    assert collection.size() == 3 and list_names(spark, f"{collection.root}/data") == ["segment=0"]
    # No step holds vectors: they are in the collection alone.
    assert not any("vector" in spark.read.parquet(path).columns for _, path in run.steps._staged)


def test_documents_the_model_rejects_leave_nothing(spark, collection):
    """The others are copied to a segment of their own, and the next write goes on from there."""
    model = row_embedder(lambda text: [1.0, 1 / ("bad" not in text)], 2)
    embed(spark, collection, [("a.txt", b"bad"), ("b.txt", b"good")], embedder=model, id_cols=("qid", "component"))
    assert list_names(spark, f"{collection.root}/data") == ["segment=1"] and collection.size() == 1
    run = embed(spark, collection, [("a.txt", b"better"), ("b.txt", b"good again")], embedder=model, id_cols=("qid", "component"))
    assert rows(collection.points(), "page_content") == [("better",), ("good again",)] and run.points_added == 1
    assert rows(collection.text_index(), "token") == [("again",), ("better",), ("good",)]


def test_files_fetched_by_key(spark, collection, tmp_path):
    (tmp_path / "a.txt").write_text("Hello.")
    todo = spark.createDataFrame([("Q1", "a.txt"), ("Q1", "gone.txt")], "qid string, component string")
    run = embed_backlog(todo, file_reader(str(tmp_path)), empty(spark, STATUS), collection, HashedEmbedder(8), now=NOW)
    assert rows(run.status, "component", "status") == [("a.txt", "ok")]
    assert rows(run.quarantine, "component") == [("gone.txt",)]


def test_rerun_after_lost_status(spark, collection):
    """Points stored, status lost: the next run ends with the same points."""
    for _ in range(2):
        run = embed(spark, collection, [("a.txt", b"one\x0ctwo")])
    assert run.points_added == 0 and collection.size() == 2 == collection.points().count()


def test_replace_document(spark, collection):
    options = {"id_cols": ("qid", "component"), "replace_document": True}
    embed(spark, collection, [("a.txt", b"one\x0ctwo"), ("b.txt", b"other")], **options)
    embed(spark, collection, [("a.txt", b"short")], **options)
    assert rows(collection.points(), "page_content") == [("other",), ("short",)]


def test_metadata_of_extractors(spark, collection):
    def extract(content):
        pages = content.decode().split("|")
        extra = {"author": "Ada", "page": "not this one", "empty": None}
        return pages, "pkg: title", [{**extra, "sheet": i} for i in range(len(pages))] if len(pages) > 1 else extra

    run = embed(spark, collection, [("a.pdf", b"one|two"), ("b.pdf", b"three")], extractors={"pdf": extract}, id_cols=("qid", "component"))
    assert rows(run.summary) == [("ok", 2)]
    found = {r.page_content: r.payload for r in collection.points().collect()}
    assert found["two"]["author"] == "Ada" and found["two"]["page"] == "1" and found["two"]["sheet"] == "1"
    assert "sheet" not in found["three"] and "empty" not in found["three"] and found["three"]["page_content"] == "three"


def test_text_is_stored_once(spark, collection):
    embed(spark, collection, [("a.txt", b"one")])
    stored = spark.read.parquet(f"{collection.root}/data").collect()[0]
    assert stored.page_content == "one" and "page_content" not in stored.payload


def test_a_slow_model_is_stopped_near_the_limit(spark, collection):
    import time

    def slow():
        return lambda texts: (time.sleep(0.2), np.ones((len(texts), 2)))[1]

    model = ModelEmbedder(slow, 2, batch_size=1)
    began = time.monotonic()
    run = embed(spark, collection, [("slow.txt", b"So slow. " * 150)], embedder=model, params=ChunkParams(buffer_size=0), timeout_seconds=0.5)
    assert rows(run.status, "component", "status") == [("slow.txt", "failed - TimeoutError")]
    # All sentences would take thirty seconds.
    assert time.monotonic() - began < 25


def test_a_call_that_never_returns_is_ended(spark, collection):
    def stuck(texts):
        while any("hang" in t for t in texts):
            time.sleep(3600)
        return [[float(len(t)), 1.0] for t in texts]

    files = [("good.txt", b"All is well. " * 60), ("bad.txt", b"This will hang. " * 60), ("fine.txt", b"It goes on. " * 60)]
    began = time.monotonic()
    run = embed(spark, collection, files, embedder=ModelEmbedder(lambda: stuck, 2), params=ChunkParams(buffer_size=1), timeout_seconds=1.0)
    statuses = {r.component: r.status for r in run.status.collect()}
    assert time.monotonic() - began < 60
    assert statuses == {"good.txt": "ok", "bad.txt": "failed - TimeoutError", "fine.txt": "ok"}


def test_limited_calls():
    calls = LimitedCalls(lambda how: {"wait": lambda: time.sleep(99), "fail": lambda: 1 / 0, "die": lambda: os._exit(3)}.get(how, lambda: how)())
    assert calls(5.0, "a") == "a"
    with pytest.raises(ZeroDivisionError):
        calls(5.0, "fail")
    began = time.monotonic()
    with pytest.raises(OverTime):
        calls(0.3, "wait")
    assert time.monotonic() - began < 2.3 and calls(5.0, "b") == "b"
    with pytest.raises(RuntimeError):
        calls(5.0, "die")
    assert calls(5.0, "c") == "c"
    calls.close()
    unloadable = LimitedCalls(lambda: 1, lambda: {}["missing"])
    with pytest.raises(KeyError):
        unloadable(1.0)


def test_timeout_status(spark, collection):
    def slow():
        import time

        return lambda texts: (time.sleep(0.3 * ("Slow" in texts[0])), np.ones((len(texts), 2)))[1]

    files = [("slow.txt", b"Slow one. Two. Three."), ("fast.txt", b"One. Two. Three.")]
    params = ChunkParams(buffer_size=0)
    run = embed(spark, collection, files, embedder=ModelEmbedder(slow, 2), params=params, timeout_seconds=0.2)
    assert rows(run.status, "component", "status") == [("fast.txt", "ok"), ("slow.txt", "failed - TimeoutError")]


def test_two_files_with_a_function_as_model(spark, collection):
    files = [("attic/fern.txt", b"Ferns unroll. " * 9), ("attic/ivy.txt", b"Ivy")]
    model = row_embedder(lambda t: [float("Ivy" in t), 0.25])
    run = embed(spark, collection, files, embedder=model, id_cols=("qid", "component"))
    assert rows(run.summary) == [("ok", 2)] and collection.describe().vector_size == 2
    assert rows(collection.points(), "component", "vector") == [("attic/fern.txt", [0.0, 0.25]), ("attic/ivy.txt", [1.0, 0.25])]


@pytest.fixture
def world(spark):
    source = spark.createDataFrame([("Q1",), ("Q2",), ("Q3",)], "qid string")
    files = [(f"main/Q{i % 4}/components/p_{i}.txt", f"Text {i}.".encode()) for i in range(8)]
    contents = spark.createDataFrame(files, CONTENTS)
    return source, contents.select("key"), contents


def test_incremental_run_twice(store, collection, world):
    source, listing, contents = world
    first = incremental_run(store, collection, source, listing, contents, HashedEmbedder(8), id_cols=("qid", "component"), now=NOW)
    assert first.published.changed and first.embedded.points_added == 6
    assert first.published.message.endswith("[software_index:3 (+3); component_index:8 (+8); embeddings_index:6 (+6)]")
    second = incremental_run(store, collection, source, listing, contents, HashedEmbedder(8), id_cols=("qid", "component"), now=NOW)
    assert not second.published.changed and second.embedded.points_added == 0
    assert store.manifest().count() == 2


def test_staged_steps_can_be_dropped(spark, monkeypatch):
    from shelfmark import session

    monkeypatch.setattr(session, "_STAGED", [])
    session.stage(spark.range(3), "some")
    (_, path), = session._STAGED
    assert session.path_exists(spark, path)
    session.release_staged()
    assert not session.path_exists(spark, path) and session._STAGED == []


def test_former_snapshots_go(spark, store):
    tables = store.read()
    made = []
    for n in range(1, 4):
        tables["software_index"] = spark.createDataFrame([(f"Q{n}", NOW)], "qid string, updated_at timestamp")
        made.append(store.publish(tables, now=NOW).snapshot_id)
    assert store.prune(2) == 1 and store.prune(2) == 0 and store.manifest().count() == 3
    assert rows(store.read()["software_index"], "qid") == [("Q3",)] and rows(store.read(made[1])["software_index"], "qid") == [("Q2",)]
    with pytest.raises(ValueError):
        store.prune(0)


def written(store, table, version):
    """Buckets that a snapshot wrote."""
    return {n for n in list_names(store.spark, store._part(table, version)) if n.startswith("bucket=")}


def test_only_changed_buckets_are_written(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"), bucket_rows=10)
    table = lambda xs: spark.createDataFrame([(f"Q{i}", NOW if t else None) for i, t in xs], ITEMS)
    first = {i: False for i in range(300)}
    tables = {**store.read(), "software_index": table(first.items())}
    one = store.publish(tables, now=NOW)
    tree = Tree.of(store.latest(), "software_index")
    assert tree.buckets == 32 and tree.n == 300 and len(written(store, "software_index", 1)) == len(tree.written) == 32
    # One row in a hundred changes.
    second = first | {7: True, 70: True, 170: True}
    two = store.publish({**tables, "software_index": table(second.items())}, now=NOW)
    assert 1 <= len(written(store, "software_index", 2)) <= 3
    third = {i: t for i, t in second.items() if i != 9} | {8: True, 1000: False}
    assert not store.update({"software_index": table([(7, True)])}, now=NOW).changed
    three = store.update({"software_index": table([(8, True), (1000, False)])}, now=NOW)
    four = store.publish({**store.read(), "software_index": table(third.items())}, now=NOW)
    assert len(written(store, "software_index", 3)) <= 2 and len(written(store, "software_index", 4)) == 1
    assert rows(store.read()["software_index"]) == rows(table(third.items()))
    assert rows(store.read(two.snapshot_id)["software_index"]) == rows(table(second.items()))
    assert rows(store.diff("software_index", one.snapshot_id, two.snapshot_id)) == [("Q170", "changed"), ("Q7", "changed"), ("Q70", "changed")]
    assert rows(store.diff("software_index", two.snapshot_id)) == [("Q1000", "added"), ("Q8", "changed"), ("Q9", "removed")]
    assert rows(store.diff("software_index", four.snapshot_id)) == [] and three.changed
    # More rows need more buckets, and all of them are dealt anew.
    store.update({"software_index": table([(i, False) for i in range(2000, 2200)])}, now=NOW)
    assert Tree.of(store.latest(), "software_index").buckets == 64 and store.read()["software_index"].count() == 500
    assert rows(store.diff("software_index", four.snapshot_id), "change") == [("added",)] * 200
    assert store.prune(1) == 4 and store.read()["software_index"].count() == 500
    with pytest.raises(ValueError):
        store.read("nothing")


def test_bounded_runs(store, collection, world):
    source, listing, contents = world
    for n in (2, 4):
        incremental_run(store, collection, source, listing, contents, HashedEmbedder(8), per_run=2, id_cols=("qid", "component"), now=NOW)
        assert store.read()["embeddings_index"].count() == n


def test_plan_and_work_package(spark, store, collection, world, tmp_path):
    source, listing, contents = world
    root = str(tmp_path / "plans")
    with pytest.raises(FileNotFoundError):
        plan_packages(store, root)
    tables = store.read()
    tables["software_index"] = refresh_items(tables["software_index"], source, now=NOW)
    tables["component_index"] = refresh_files(tables["component_index"], listing, NOW)
    store.publish(tables, now=NOW)
    checksum = store.checksum()
    packaged, published = plan_packages(store, root, size=2, packages=2, now=NOW)
    assert packaged.count() == 4 and published.changed
    assert rows(store.read()["embeddings_index"].select("status").distinct()) == [("planned",)]
    body = spark.read.json(f"{root}/planned").filter("package_id = 'plan_localworker_02'").collect()[0]
    assert body.state_db_checksum == checksum and len(body.entries) == 2
    done = run_package(spark, store, collection, root, "plan_localworker_01", contents, HashedEmbedder(8), now=NOW)
    assert rows(done.embedded.summary) == [("ok", 2)]
    assert rows(store.read()["embeddings_index"].groupBy("status").count()) == [("ok", 2), ("planned", 2)]
    with pytest.raises(FileNotFoundError):
        run_package(spark, store, collection, root, "plan_localworker_09", contents, HashedEmbedder(8))
    # The rest can still be planned; what is planned or done is not planned again.
    rest, _ = plan_packages(store, root, size=10, packages=1, now=NOW)
    assert rest.count() == 2
    none, published = plan_packages(store, root, size=10, packages=1, now=NOW)
    assert none.count() == 0 and published is None
