"""Session helpers: the shared work folder and materialised steps."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession, *packages: str) -> None:
    """Make this package, and others by name, importable in the Python workers.

    Not needed where ``--py-files`` or an installation already does it.
    """
    context = spark.sparkContext
    names = sorted({__package__, *packages})
    archive_name = "-".join(names) + ".zip"
    if any(str(f).endswith(archive_name) for f in context.listFiles):
        return
    archive = Path(_own_folder()) / archive_name
    with zipfile.ZipFile(archive, "w") as out:
        for name in names:
            folder = Path(__import__(name).__file__).parent
            for source in sorted(folder.rglob("*.py")):
                out.write(source, source.relative_to(folder.parent))
    context.addPyFile(str(archive))


def _own_folder() -> str:
    """A folder on this machine that goes when the process ends."""
    folder = tempfile.mkdtemp(prefix="shelfmark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def work_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and checkpoints.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = _own_folder()
    context.setCheckpointDir(folder)
    return folder


def new_work_path(spark: SparkSession, label: str) -> str:
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


_STAGED: list[tuple[SparkSession, str]] = []


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a step to the shared folder and read it back.

    Cuts the lineage like a checkpoint, survives the loss of executors, and,
    being columnar, lets later steps read only the columns they need. It stays
    as long as results may read it: until ``release_staged``.
    """
    path = new_work_path(df.sparkSession, label)
    _STAGED.append((df.sparkSession, path))
    return _write_and_read(df, path)


def release_staged() -> None:
    """Delete what ``stage`` has written so far; results that were not stored elsewhere cannot be read any more."""
    while _STAGED:
        drop_path(*_STAGED.pop())


class Steps:
    """The staged steps of one job, so that they can be dropped when it is over."""

    def __init__(self) -> None:
        self._staged: list[tuple[SparkSession, str]] = []

    def new_path(self, spark: SparkSession, label: str) -> str:
        """A folder in the shared one that goes with these steps."""
        path = new_work_path(spark, label)
        self._staged.append((spark, path))
        return path

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        return _write_and_read(df, self.new_path(df.sparkSession, label))

    def release(self) -> None:
        """Delete the staged tables; DataFrames that read them cannot be used any more."""
        while self._staged:
            drop_path(*self._staged.pop())


def _write_and_read(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _hadoop_path(spark, path)
    return fs.exists(hadoop_path)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    hadoop_path, fs = _hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _hadoop_path(spark, path)
    fs.delete(hadoop_path, True)


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)
