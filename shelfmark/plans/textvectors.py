"""Vectors by text: a model sees a text once, however often it comes.

Vectors are stored under a hash of their text, in appended segments below one
root per model. A folder counts when its write has finished:

    segment=<n>/   hash, vector
    all=<n>/       the segments up to n in one, which no longer count themselves
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.embedding import Embedder, embed_column_safely
from shelfmark.operators.joins import narrow_join
from shelfmark.session import Steps, drop_path, empty, list_names, path_exists, stage

_STORED = "hash binary, vector array<float>"


class TextVectors:
    """The vectors of one model. There is one writer at a time."""

    def __init__(self, spark: SparkSession, root: str, embedder: Embedder) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.embedder = embedder

    def _folders(self) -> list[tuple[int, str]]:
        """Number and path of the folders that count, in order."""
        named = [(int(n.split("=")[1]), n.split("=")[0], f"{self.root}/{n}") for n in list_names(self.spark, self.root)]
        done = [f for f in named if path_exists(self.spark, f"{f[2]}/_SUCCESS")]
        whole = max([f for f in done if f[1] == "all"], default=None)
        later = [f for f in done if f[1] == "segment" and (whole is None or f[0] > whole[0])]
        return [(n, path) for n, _, path in sorted(([whole] if whole else []) + later)]

    def stored(self) -> DataFrame:
        """``hash, vector`` of the texts known so far."""
        paths = [path for _, path in self._folders()]
        return self.spark.read.schema(_STORED).parquet(*paths) if paths else empty(self.spark, _STORED)

    def _hash(self, text: Column) -> Column:
        # 128 bits of a SHA-256: different texts do not meet.
        return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)

    def learn(self, rows: DataFrame, text: Column) -> tuple[int, DataFrame]:
        """Embed the texts of ``rows`` that are not known; how many the model was given, and ``hash, error`` of those it rejected.

        Hashes are compared first, so that only unknown texts are moved, each
        to one task. There they go to the model by length, and so its batches
        hold texts of about one length. Rejected texts stay unknown.
        """
        steps = Steps()
        folders = self._folders()
        asked = rows.select(self._hash(text).alias("hash")).distinct()
        missing = steps.stage(asked.join(self.stored().select("hash"), "hash", "left_anti"), "missing")
        given = missing.count()
        if given == 0:
            steps.release()
            return 0, empty(self.spark, "hash binary, error string")
        texts = rows.select(self._hash(text).alias("hash"), F.coalesce(text, F.lit("")).alias("text"))
        unknown = narrow_join(texts, missing, ["hash"], ["text"], "left_semi").dropDuplicates(["hash"])
        by_length = unknown.repartition("hash").sortWithinPartitions(F.length("text"), "hash")
        embedded = steps.stage(by_length.select("hash", embed_column_safely(F.col("text"), self.embedder).alias("e")), "embedded")
        target = f"{self.root}/segment={folders[-1][0] + 1 if folders else 0}"
        good = embedded.filter(F.col("e.error").isNull()).select("hash", F.col("e.vector").alias("vector"))
        good.write.mode("overwrite").parquet(target)
        rejected = stage(embedded.filter(F.col("e.error").isNotNull()).select("hash", "e.error"), "rejected")
        steps.release()
        return given, rejected

    def embed(self, rows: DataFrame, text: Column, into: str = "_e") -> DataFrame:
        """``rows`` with ``into``: a struct of ``vector`` and ``error``, one of them null.

        A null text counts as empty. Vectors reach the rows by a join on the
        hash; a text that very many rows share is a hot key there, which the
        join takes care of. ``rows`` is read twice: stage it if it is costly.
        """
        rejected = self.learn(rows, text)[1]
        none = F.lit(None)
        known = self.stored().select("hash", F.struct("vector", none.cast("string").alias("error")).alias(into))
        failed = rejected.select("hash", F.struct(none.cast("array<float>").alias("vector"), "error").alias(into))
        keyed = rows.withColumn("_hash", self._hash(text))
        found = known.unionByName(failed).withColumnRenamed("hash", "_hash")
        # Only vectors of texts that are asked for take part in the join, or in the measure of its size.
        asked = keyed.select("_hash").distinct()
        return narrow_join(keyed, found.join(asked, "_hash", "left_semi"), ["_hash"], ["_hash"]).drop("_hash")

    def compact(self) -> None:
        """Put all segments into one; readers of the former ones must have finished."""
        folders = self._folders()
        if len(folders) > 1:
            self.stored().write.mode("overwrite").parquet(f"{self.root}/all={folders[-1][0]}")
            for _, path in folders:
                drop_path(self.spark, path)
