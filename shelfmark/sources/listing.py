"""Listing and writing of stored files inside tasks.

``objects.list_objects`` lets the driver list the files, which is quick for
some thousand of them. Here every folder is listed by a task: level by level,
so that a level's folders are spread evenly however the tree is shaped. The
driver sees the number of folders of a level, and no names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import Steps, stage

# Folders that one task lists, about, and rows it passes on at a time.
LIST_FOLDERS = 64
_STEP = 8_192
_ENTRY = "key string, size bigint, modified timestamp, folder boolean"
_ARROW = pa.schema([("key", pa.string()), ("size", pa.int64()), ("modified", pa.timestamp("us", "UTC")), ("folder", pa.bool_())])


def _open(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root.rstrip("/"))


def _hidden(name: str) -> bool:
    """Names that Spark's own readers pass over too."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = _open(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                lead = f"{folder}/" if folder else ""
                found = store.get_file_info(fs.FileSelector(f"{base}/{folder}".rstrip("/")))
                kept = [f for f in found if not _hidden(f.base_name) and f.type in (fs.FileType.File, fs.FileType.Directory)]
                for at in range(0, len(kept), _STEP):
                    some = kept[at : at + _STEP]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lead + f.base_name for f in some], pa.string()),
                            pa.array([f.size for f in some], pa.int64()),
                            pa.array([f.mtime_ns // 1000 if f.mtime_ns is not None else None for f in some], pa.int64()).cast(_ARROW.field(2).type),
                            pa.array([f.type == fs.FileType.Directory for f in some], pa.bool_()),
                        ],
                        schema=_ARROW,
                    )

    return run


def list_in_tasks(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root``: ``key, size, modified``, listed by the tasks.

    The same as ``list_objects``, and empty files too, which Spark's readers pass over.

    One job per level of the tree. What was listed is written to the shared
    folder, so that all later steps see the same files. A task holds the names
    of one folder at a time. A root that is not there is an error; links are followed.
    """
    listed: list[DataFrame] = []
    steps = Steps()
    level, n = spark.createDataFrame([("",)], "key string"), 1
    while n:
        tasks = max(1, -(-n // LIST_FOLDERS))
        found = steps.stage(level.repartition(tasks, "key").mapInArrow(_entries(root), _ENTRY), "level")
        listed.append(found.filter(~F.col("folder")).drop("folder"))
        level = found.filter("folder").select("key")
        n = level.count()
    files = stage(reduce(DataFrame.unionByName, listed), "listing")
    steps.release()
    return files


def store_contents(contents: DataFrame, root: str) -> int:
    """Write ``(key, content)`` rows as files below ``root``, in tasks; returns how many rows were written.

    Keys are distinct. A file appears whole or not at all: a task that runs
    again replaces what it wrote. A null content is an empty file; rows without key are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(root)
        made: set[str] = set()
        for batch in batches:
            for key, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                folder, _, name = f"{base}/{key}".rpartition("/")
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                part = f"{folder}/.{name}.{uuid.uuid4().hex}._COPYING_"
                with store.open_output_stream(part) as out:
                    out.write(content.as_buffer() if content.is_valid else b"")
                store.move(part, f"{folder}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    rows = contents.filter(F.col("key").isNotNull()).select("key", F.col("content").cast("binary"))
    return rows.mapInArrow(run, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
