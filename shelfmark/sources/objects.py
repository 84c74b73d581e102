"""Object listings and file contents."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import keys
from shelfmark.operators.joins import narrow_join
from shelfmark.schemas import ALLOWED_EXTENSIONS


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root``: ``key, size, modified``. File contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )
    return files.select(
        _relative(F.col("path"), root).alias("key"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def read_contents(spark: SparkSession, root: str, suffix: str | None = None) -> DataFrame:
    """Files below ``root`` with their bytes: ``key, content``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffix is not None:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.load(root).select(_relative(F.col("path"), root).alias("key"), "content")


def read_folder(spark: SparkSession, folder: str, suffix: str = ".pdf") -> DataFrame:
    """Files directly in ``folder`` whose name ends with ``suffix``: ``key, content``."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}")
    return reader.load(folder).select(_relative(F.col("path"), folder).alias("key"), "content")


def _relative(path: Column, root: str) -> Column:
    # Listed paths carry the scheme of the file system; the key starts after the root.
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    return F.substring_index(path, f"/{base}/", -1)


# Bytes of fetched files a task holds before it passes them on.
FETCH_BYTES = 32 << 20
# Files that one task fetches, about: what is fetched again if the task is lost.
FETCH_FILES = 256


def select_contents(contents: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of a ``(key, content)`` table that are wanted: ``qid, component, content``.

    File bytes are the bulk of the data. As long as the list of wanted files
    is short, which is counted, it goes to the contents, and they stay where
    they are.
    """
    stored = contents.select(F.col("key").alias("component"), "content")
    found = narrow_join(stored, wanted.select("qid", "component"), ["component"], ["component"])
    return found.select("qid", "component", "content")


def file_reader(root: str) -> Callable[[str], bytes]:
    """Reads an object by key from a folder or store that every executor reaches."""

    def read(key: str) -> bytes:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(f"{root.rstrip('/')}/{key}")
        with store.open_input_stream(path) as stream:
            return stream.read()

    return read


def fetch_contents(wanted: DataFrame, read: Callable[[str], bytes]) -> DataFrame:
    """Bytes of each wanted file, and of no other: ``qid, component, content, error``.

    Fetching runs in the tasks, one file at a time; keys are spread evenly over
    as many tasks as there are files for. A file that cannot be fetched has an error and no content.
    """

    def fetch(key: str) -> tuple:
        try:
            return read(key), None
        except Exception as exc:  # one missing file must not stop the batch
            return None, f"{type(exc).__name__}: {exc}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Keys come in by the thousand, so results leave by their bytes, not batch by batch.
        rows, held = [], 0
        for batch in batches:
            for qid, key in zip(batch["qid"], batch["component"]):
                content, error = fetch(key)
                rows.append((qid, key, content, error))
                held += len(content or b"")
                if held > FETCH_BYTES:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    columns = ["qid", "component", "content", "error"]
    least = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(least, -(-wanted.count() // FETCH_FILES))
    spread = wanted.select("qid", "component").repartition(partitions, "component")
    return spread.mapInPandas(run, "qid string, component string, content binary, error string")


def index_files(
    objects: DataFrame, extensions: Iterable[str] = ALLOWED_EXTENSIONS, *, distinct: bool = True
) -> DataFrame:
    """Objects with an allowed extension and the item they belong to: ``qid, component``.

    ``qid`` is null for objects outside any item. Pass ``distinct=False`` when
    the listing is known to hold every key once; that saves its only shuffle.
    """
    listed = objects.select("key").filter(keys.has_extension(F.col("key"), extensions))
    if distinct:
        listed = listed.distinct()
    return listed.select(keys.item_id(F.col("key")).alias("qid"), F.col("key").alias("component"))


def indexed(files: DataFrame) -> DataFrame:
    return files.filter(F.col("qid").isNotNull())


def index_summary(files: DataFrame) -> DataFrame:
    """One row: how many files were indexed and how many had no item id."""
    return files.agg(
        F.count_if(F.col("qid").isNotNull()).alias("n_indexed"),
        F.count_if(F.col("qid").isNull()).alias("n_skipped"),
    )


def list_components(objects: DataFrame, items: DataFrame, branch: str | None = None) -> DataFrame:
    """File names stored under each item's sharded folder: ``qid, component_name``.

    The folder is cut out of the key, so listing many items is one equi-join
    instead of a prefix scan per item.
    """
    folder = F.col("key").substr(F.lit(1), F.instr("key", "/components/") - 1)
    lead = f"{branch.rstrip('/')}/" if branch else ""
    listed = objects.filter(F.instr("key", "/components/") > 0).select(
        folder.alias("folder"), keys.file_name(F.col("key")).alias("component_name")
    )
    wanted = items.select(
        "qid", F.concat(F.lit(lead), keys.shard_path(F.col("qid"))).alias("folder")
    )
    found = narrow_join(listed, wanted, ["folder"], ["component_name"])
    return found.select("qid", "component_name")
