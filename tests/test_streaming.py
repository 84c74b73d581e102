"""Streams, run to the end and then again."""

from datetime import datetime, timezone

import pytest

from shelfmark.operators.embedding import HashedEmbedder
from shelfmark.plans.collection import Collection
from shelfmark.plans.state import StateStore
from shelfmark.schemas import ITEMS, STATUS
from shelfmark.streaming import jobs

NOW = datetime(2024, 1, 1, tzinfo=timezone.utc)


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def put(root, name, body="Text."):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(body)


def test_index_stream_takes_new_files_once(spark, tmp_path):
    files, log = tmp_path / "files", jobs.file_log(spark, str(tmp_path / "log"))
    assert log.current().count() == 0

    def run():
        stream = jobs.stream_files(spark, str(files), max_files=1)
        query = jobs.index_stream(stream, log, str(tmp_path / "checkpoint"))
        query.awaitTermination()
        return sum(1 for p in query.recentProgress if p.numInputRows)

    for name in ("main/Q1/a.pdf", "main/Q2/b.TXT", "main/other/c.pdf", "main/Q3/d.csv"):
        put(files, name)
    assert run() == 4
    assert rows(log.current(), "qid", "component") == [("Q1", "main/Q1/a.pdf"), ("Q2", "main/Q2/b.TXT")]
    assert run() == 0
    put(files, "main/Q1/new.html")
    assert run() == 1
    assert log.current().count() == 3


def test_log_is_idempotent_and_keeps_the_latest(spark, table, tmp_path):
    log = jobs.status_log(spark, str(tmp_path / "log"))
    early, late = NOW, NOW.replace(hour=5)
    log.append(table([("Q1", "c", late, "ok"), ("Q1", "c", early, "planned"), ("Q2", "c", early, "planned")], STATUS), 0)
    log.append(table([("Q1", "c", early, "failed")], STATUS), 1)
    log.append(table([("Q1", "c", early, "failed")], STATUS), 1)
    assert rows(log.current(), "qid", "status") == [("Q1", "ok"), ("Q2", "planned")]
    assert log.rows().count() == 3


def test_compaction_of_a_log(spark, table, tmp_path):
    log = jobs.status_log(spark, str(tmp_path / "log"))
    for batch in range(4):
        log.append(table([("Q1", "c", NOW.replace(hour=batch), f"s{batch}"), (f"Q{batch + 5}", "c", NOW, "ok")], STATUS), batch)
        if batch in (1, 2):
            before = rows(log.current(), "qid", "status")
            log.compact()
            assert rows(log.current(), "qid", "status") == before
    assert rows(log.current(), "qid", "status") == [("Q1", "s3"), ("Q5", "ok"), ("Q6", "ok"), ("Q7", "ok"), ("Q8", "ok")]
    assert log.rows().count() == 6 and not (tmp_path / "log" / "batch=0").exists()
    log.compact()
    log.compact()
    assert log.rows().count() == 5


def test_status_stream(spark, table, tmp_path):
    source = str(tmp_path / "events")
    log = jobs.status_log(spark, str(tmp_path / "log"))

    def run():
        stream = spark.readStream.schema(STATUS).parquet(source)
        jobs.status_stream(stream, log, str(tmp_path / "checkpoint")).awaitTermination()

    table([("Q1", "c", NOW, "planned")], STATUS).write.mode("append").parquet(source)
    run()
    table([("Q1", "c", NOW.replace(hour=1), "ok")], STATUS).write.mode("append").parquet(source)
    run()
    assert rows(log.current(), "qid", "status") == [("Q1", "ok")]


def test_embed_stream(spark, tmp_path):
    files = tmp_path / "files"
    store, target = StateStore(spark, str(tmp_path / "state")), Collection(spark, str(tmp_path / "points"))
    quarantined: list[str] = []
    tables = store.read()
    tables["software_index"] = spark.createDataFrame([("Q1", NOW), ("Q2", NOW)], ITEMS)
    store.publish(tables)

    def run():
        stream = jobs.stream_files(spark, str(files), with_content=True)
        query = jobs.embed_stream(
            stream, store, target, HashedEmbedder(8), str(tmp_path / "checkpoint"), id_cols=("qid", "component"),
            on_quarantine=lambda bad, _: quarantined.extend(r.component for r in bad.collect()),
        )
        query.awaitTermination()

    put(files, "main/Q1/a.txt", "One.\fTwo.")
    put(files, "main/Q2/no_reader.pdf", "?")
    put(files, "main/Q9/unknown.txt")
    run()
    assert rows(store.read()["embeddings_index"], "component", "status") == [("main/Q1/a.txt", "ok")]
    assert quarantined == ["main/Q2/no_reader.pdf"]
    assert store.read()["component_index"].count() == 3 and target.size() == 2
    snapshots = store.manifest().count()
    run()
    assert store.manifest().count() == snapshots and target.size() == 2
    put(files, "main/Q2/b.html", "<p>Three</p>")
    run()
    assert target.size() == 3 and store.manifest().count() == snapshots + 1
    # The item of a file that came long ago is known now, and the unreadable file was tried again.
    assert quarantined == ["main/Q2/no_reader.pdf"] * 2
    tables = store.read()
    tables["software_index"] = spark.createDataFrame([("Q1", NOW), ("Q2", NOW), ("Q9", NOW)], ITEMS)
    store.publish(tables)
    put(files, "main/Q1/c.txt", "Four")
    run()
    assert ("main/Q9/unknown.txt", "ok") in rows(store.read()["embeddings_index"], "component", "status")
    assert target.size() == 5


def test_rate_limit_must_be_positive(spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.stream_files(spark, str(tmp_path), max_files=0)
