"""A keyed table fed by a stream: one folder per micro-batch, newest row per key on read."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.upsert import latest_by_key, require_keys
from shelfmark.session import drop_path, empty, list_names, path_exists


class KeyedLog:
    """Upserts that cost as much as the batch, not as the table.

    A batch that is delivered again overwrites its own folder, which makes
    ``foreachBatch`` exactly-once.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str]
    ) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.order = list(keys), list(order)

    def append(self, batch: DataFrame, batch_id: int) -> None:
        typed = batch.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        newest = latest_by_key(require_keys(typed, self.keys), self.keys, self.order)
        newest.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def rows(self) -> DataFrame:
        """Everything written since the last compaction, and its result, with batch numbers."""
        schema = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        if not path_exists(self.spark, self.path):
            return empty(self.spark, schema)
        base = self._base()
        found = [self.spark.read.schema(schema).parquet(self.path).filter(F.col("batch") > base)]
        if base >= 0:
            stored = self.spark.read.schema(self.schema).parquet(self._base_path(base))
            found.append(stored.withColumn("batch", F.lit(base).cast("bigint")))
        return reduce(DataFrame.unionByName, found)

    def current(self) -> DataFrame:
        """The newest row of every key; on equal order values the later batch wins."""
        newest = latest_by_key(self.rows(), self.keys, [*self.order, "batch"])
        return newest.select(*self.schema.fieldNames())

    def compact(self) -> None:
        """Write the current rows as one table, so that readers need not go through the batches up to now.

        To be called between batches. Former batches are deleted with the next
        compaction, so that readers that are under way can finish.
        """
        before = self._base()
        last = self.rows().agg(F.max("batch")).first()[0]
        if last is None or last == before:
            return
        self.current().write.mode("overwrite").parquet(self._base_path(last))
        if before >= 0:
            drop_path(self.spark, self._base_path(before))
            for batch in range(before + 1):
                drop_path(self.spark, f"{self.path}/batch={batch}")

    def _base_path(self, batch: int) -> str:
        return f"{self.path}-base/{batch}"

    def _base(self) -> int:
        """The newest finished compaction; -1 if there is none."""
        done = [int(n) for n in list_names(self.spark, f"{self.path}-base") if path_exists(self.spark, f"{self._base_path(int(n))}/_SUCCESS")]
        return max(done, default=-1)
