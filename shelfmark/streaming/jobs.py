"""Streams: file index, status table, embedding."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators.backlog import known_items
from shelfmark.operators.embedding import Embedder
from shelfmark.operators.joins import narrow_join
from shelfmark.plans.collection import Collection
from shelfmark.plans.embed import embed_backlog
from shelfmark.plans.state import StateStore
from shelfmark.schemas import ALLOWED_EXTENSIONS, DOC_KEYS, FILES, STATUS
from shelfmark.session import Steps, drop_path, path_exists
from shelfmark.sources.objects import _relative, index_files, indexed
from shelfmark.streaming.log import KeyedLog

_BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(
    spark: SparkSession, root: str, max_files: int | None = None, with_content: bool = False
) -> DataFrame:
    """New files below ``root`` as they appear: ``key`` (and ``content``), at most ``max_files`` per batch."""
    reader = spark.readStream.format("binaryFile").schema(_BINARY_FILE).option("recursiveFileLookup", "true")
    if max_files is not None:
        if max_files <= 0:
            raise ValueError("max_files must be positive")
        reader = reader.option("maxFilesPerTrigger", max_files)
    key = _relative(F.col("path"), root).alias("key")
    files = reader.load(root)
    return files.select(key, "content") if with_content else files.select(key)


def file_log(spark: SparkSession, path: str) -> KeyedLog:
    return KeyedLog(spark, path, FILES, DOC_KEYS, ["updated_at"])


def status_log(spark: SparkSession, path: str) -> KeyedLog:
    return KeyedLog(spark, path, STATUS, DOC_KEYS, ["updated_at"])


def _start(stream: DataFrame, handle, checkpoint: str, once: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def index_stream(
    objects: DataFrame,
    log: KeyedLog,
    checkpoint: str,
    extensions: Iterable[str] = ALLOWED_EXTENSIONS,
    once: bool = True,
) -> StreamingQuery:
    """Index new objects (``key``) into the file log."""
    extensions = tuple(extensions)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # The log keeps one row per key, so the listing need not be made distinct first.
        files = indexed(index_files(batch, extensions, distinct=False))
        log.append(files.withColumn("updated_at", F.lit(datetime.now(timezone.utc))), batch_id)

    return _start(objects, handle, checkpoint, once)


def status_stream(events: DataFrame, log: KeyedLog, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Keep the latest status per file out of a stream of status rows."""
    return _start(events, log.append, checkpoint, once)


def embed_stream(
    files: DataFrame,
    store: StateStore,
    collection: Collection,
    embedder: Embedder,
    checkpoint: str,
    once: bool = True,
    known_only: bool = True,
    on_quarantine: Callable[[DataFrame, int], None] | None = None,
    **options: object,
) -> StreamingQuery:
    """Embed new files (``key, content``) and publish the state after every batch.

    A file with a status row is not embedded again, also after a restart; a
    batch that is delivered twice writes the same point ids twice. Files that
    get no status row, because their item is not in the item list
    (``known_only``) or because they are in quarantine, wait beside the
    checkpoint with their contents and are tried again with every later batch.
    ``on_quarantine`` gets the unreadable files (``qid, component, error``) and
    the batch number.
    """
    spark = files.sparkSession
    waiting = f"{checkpoint.rstrip('/')}-waiting"

    def folder(batch_id: int) -> str:
        return f"{waiting}/batch={batch_id}"

    def with_waiting(batch: DataFrame, batch_id: int) -> DataFrame:
        left = folder(batch_id - 1)
        if not path_exists(spark, f"{left}/_SUCCESS"):
            return batch
        former = spark.read.schema(batch.schema).parquet(left)
        # A file that came again replaces what waited.
        return batch.unionByName(narrow_join(former, batch.select("key"), ["key"], ["key"], "left_anti"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        store.init()
        tables, baseline = store.read(), store.counts()
        steps = Steps()
        contents = steps.stage(with_waiting(batch.select("key", "content"), batch_id), "batch")
        now = datetime.now(timezone.utc)
        files = indexed(index_files(contents)).withColumn("updated_at", F.lit(now))
        todo = known_items(files, tables["software_index"]) if known_only else files
        run = embed_backlog(
            todo, contents, tables["embeddings_index"], collection, embedder, now=now, **options
        )
        store.update({"component_index": files, "embeddings_index": run.results}, baseline, now=now)
        open_files = narrow_join(files.select(*DOC_KEYS), run.status.select(*DOC_KEYS), DOC_KEYS, DOC_KEYS, "left_anti")
        keys = open_files.select(F.col("component").alias("key")).distinct()
        narrow_join(contents, keys, ["key"], ["key"], "left_semi").write.mode("overwrite").parquet(folder(batch_id))
        # The last batch may be delivered again, so what it started from stays.
        drop_path(spark, folder(batch_id - 2))
        if on_quarantine is not None:
            on_quarantine(run.quarantine, batch_id)
        run.release()
        steps.release()

    return _start(files, handle, checkpoint, once)
