"""Which segments of a collection may hold given keys: a Bloom filter per segment, in blocks.

A filter is a table of bitmaps of 32,768 bits. A key belongs to one bitmap, by
its hash, and sets ``HASHES`` bits of it. The number of bitmaps is a power of
two that grows with the keys, so a filter takes some two bytes per key whatever
the size, and is built, stored and asked in parallel. Filters of equal size are
united by OR, block by block; a larger one is folded into a smaller one
likewise, because its block number ends in that of the smaller one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.joins import narrow_join

BITS = 32_768
HASHES = 8
# Bits per key, at least; about one key in 2,000 is taken for a member wrongly.
BITS_PER_KEY = 16

FILTER = "field string, size bigint, block bigint, bits binary"


def filter_size(n: int) -> int:
    """Bitmaps of a filter of ``n`` keys: a power of two."""
    return 1 << max(0, -(-n * BITS_PER_KEY // BITS) - 1).bit_length()


def _block(size: Column, hashed: Column) -> Column:
    return hashed.bitwiseAND(size - 1)


def _position(j: int, hashed: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(j), hashed), F.lit(BITS))


def build_filter(rows: DataFrame, fields: Sequence[str], n: int) -> DataFrame:
    """``field, size, block, bits`` for each of the string columns ``fields`` of ``n`` rows; nulls are no members.

    Only hashes of keys are moved, repeated ones once, and then bitmaps are made where all their keys are.
    """
    size = F.lit(filter_size(n)).cast("bigint")
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("key")) for f in fields])
    keys = rows.select(F.explode(pairs).alias("k")).select("k.*").filter("key is not null")
    hashed = keys.select("field", F.xxhash64("key").alias("hash")).distinct()
    dealt = hashed.withColumn("block", _block(size, F.col("hash"))).repartition("field", "block")
    bits = F.explode(F.array(*[_position(j, F.col("hash")) for j in range(HASHES)]))
    bitmaps = dealt.select("field", "block", bits.alias("bit")).groupBy("field", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    return bitmaps.select("field", size.alias("size"), "block", "bits")


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(position, F.lit(8)).cast("int")) == 1


def may_hold(filters: DataFrame, keys: DataFrame, field: str) -> DataFrame:
    """``segment, key`` where the segment's filter of ``field`` does not rule out the key.

    ``filters`` are stored ones of several segments (``segment`` and the columns
    of ``build_filter``), ``keys`` has one string column. The bitmaps stay where
    they are while the keys are few.
    """
    mine = filters.filter(F.col("field") == field)
    sizes = [r["size"] for r in mine.select("size").distinct().collect()]  # powers of two: a few dozen at most
    some_sizes = F.array(*[F.lit(s).cast("bigint") for s in sizes]) if sizes else F.lit(None).cast("array<bigint>")
    wanted = keys.toDF("key").filter("key is not null").distinct()
    asked = wanted.select("key", F.xxhash64("key").alias("hash"), F.explode(some_sizes).alias("size"))
    asked = asked.withColumn("block", _block(F.col("size"), F.col("hash")))
    met = narrow_join(mine.select("segment", "size", "block", "bits"), asked, ["size", "block"], ["segment"])
    for j in range(HASHES):
        met = met.filter(_is_set(F.col("bits"), _position(j, F.col("hash"))))
    return met.select("segment", "key")


def fold(filters: DataFrame, size: int) -> DataFrame:
    """The filters united into one of ``size`` bitmaps per field, which must not be larger than any of them."""
    smaller = filters.withColumn("block", F.col("block").bitwiseAND(F.lit(size - 1)))
    united = smaller.groupBy("field", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.select("field", F.lit(size).cast("bigint").alias("size"), "block", "bits")
