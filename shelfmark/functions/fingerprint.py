"""Content fingerprints of files and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def content_md5(content: Column) -> Column:
    return F.md5(content)


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row. Null flags keep ``(a, null)`` and ``(null, a)`` apart."""
    parts: list[Column] = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.MapType):
            value = F.array_sort(F.map_entries(value))
        parts += [value, value.isNull()]
    return F.xxhash64(*parts)


def table_fingerprint(df: DataFrame) -> DataFrame:
    """One row ``(n, fingerprint)``: equal for equal bags of rows, however they are partitioned."""
    hashed = df.select(row_hash(df).alias("h"))
    return hashed.agg(
        F.count("*").alias("n"),
        F.md5(
            F.concat_ws(
                ":",
                F.count("*").cast("string"),
                F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("string"),
                F.coalesce(F.bit_xor("h"), F.lit(0)).cast("string"),
            )
        ).alias("fingerprint"),
    )
