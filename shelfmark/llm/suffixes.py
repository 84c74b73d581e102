"""Removal of repeated byte strings by a sparse suffix array, sorted in range-partitioned buckets.

A string of 200 bytes holds 169 tokens of 32 bytes; the one with the smallest
hash, the first of equals, is its anchor. Equal strings have equal anchors at
the same place, so only suffixes at anchors have to be sorted, together with
the bytes before and behind that strings with this anchor cover: a window.

1. Anchors are range-partitioned by their leading token with sampled splitters
   and sorted in each bucket. An anchor alone with its token is dropped; runs
   at the edges of a bucket may go on across the boundary and are kept.
2. The windows of the remaining anchors are range-partitioned by their leading
   bytes, so that a bucket holds all windows with a token, equal ones once with
   their count. Its suffixes are sorted by multikey quicksort, eight bytes as
   one key; those that agree on 200 bytes are repeats.
3. A token with very many different windows would fill a bucket. Its strings
   are counted by 128-bit hashes instead, combined in each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import read, rows_of, values
from shelfmark.session import Steps, stage

LENGTH = 200
TOKEN = 32
# Windows of one token beyond which its strings are counted by hash.
CROWDED = 20_000
# Windows that a bucket sorts at a time, at least, if it has as many.
SORTED_TOGETHER = 4_000

_PLACE = 20  # bits of the place within a stretch, below the hash
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_TABLE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {"n": 0, "up": np.zeros(0, np.uint64), "down": np.zeros(0, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if _powers["n"] < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
        _powers["n"] = size
    return _powers["up"][:n], _powers["down"][:n]


def anchors(raw: bytes, length: int = LENGTH, token: int = TOKEN) -> tuple[np.ndarray, ...]:
    """(anchor, first, count, hash): strings starting at first .. first + count - 1 have the same anchor."""
    n = len(raw)
    strings, span = n - length + 1, length - token + 1
    if strings < 1:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    x = np.frombuffer(raw, dtype=np.uint8)
    up, down = _power_tables(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_TABLE[x] * up[:n], out=sums[1:])
    h = (sums[token:] - sums[:-token]) * down[: n - token + 1]
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    low = np.uint64((1 << _PLACE) - 1)
    reach = (1 << _PLACE) - span
    found = []
    for at in range(0, strings, reach):
        part = h[at : min(at + reach, strings) + span - 1]
        least = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        found.append((least & low).astype(np.int64) + at)
    place = np.concatenate(found)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    count = np.diff(np.r_[first, strings])
    return place[first], first, count, h[place[first]].view(np.int64)


def repeated_strings(
    flat: np.ndarray, start: np.ndarray, group: np.ndarray, length: int = LENGTH
) -> np.ndarray:
    """Which of the strings flat[start : start + length] equal another one of their group.

    Multikey quicksort with eight bytes as one key: strings are put in order
    by the next key within those that agreed so far, and those alone drop out.
    ``flat`` needs eight bytes behind the last string.
    """
    words = np.ndarray((len(flat) - 7,), dtype=">u8", buffer=flat, strides=(1,))
    out = np.zeros(len(start), dtype=bool)
    live, group = np.arange(len(start)), group.copy()
    done = 0
    while done < length and len(live):
        at = min(done, length - 8) if length >= 8 else 0
        key = words[start[live] + at].astype(np.uint64)
        if length < 8:
            key >>= np.uint64(8 * (8 - length))
        order = np.lexsort((key, group))
        live, key, group = live[order], key[order], group[order]
        new = np.r_[True, (group[1:] != group[:-1]) | (key[1:] != key[:-1])]
        alone = new & np.r_[new[1:], True]
        group = np.cumsum(new)[~alone]
        live = live[~alone]
        done = at + 8
    out[live] = True
    return out


def _runs(flags: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """Byte ranges covered by strings that start where ``flags`` is set, as starts and ends."""
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1 + length).tolist()


def _text_bytes(value: str | None) -> bytes:
    return (value or "").encode()


def _scan(length: int, token: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, kinds, parts = [], [], []
            for key, kind, text in zip(*map(values, batch.columns), strict=True):
                raw = _text_bytes(text)
                place, first, count, hash_ = anchors(raw, length, token)
                if len(place):
                    parts.append((first, count, place - first, hash_))
                    ids.append(np.full(len(place), key, dtype=np.int64))
                    kinds.append(np.full(len(place), kind, dtype=np.int8))
            if not parts:
                continue
            first, count, left, hash_ = (np.concatenate(c) for c in zip(*parts, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(ids)), pa.array(np.concatenate(kinds)), pa.array(first.astype(np.int32)),
                 pa.array(count.astype(np.int16)), pa.array(left.astype(np.int16)), pa.array(hash_)],
                names=["key", "kind", "first", "count", "left", "token"],
            )

    return scan


_ANCHORS = "key long, kind tinyint, first int, count smallint, left smallint, token long"


def _shared_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sorted by token, whose token has another row in the bucket or may have one across its boundary."""
    before: int | None = None  # the token before the batch; at the start of the bucket any token may go on
    waiting: pa.RecordBatch | None = None  # the last row, as long as it is alone with its token
    start = True
    for batch in batches:
        if not len(batch):
            continue
        token = batch.column("token").to_numpy()
        if waiting is not None and token[0] == before:
            yield waiting
        waiting = None
        same = token[1:] == token[:-1]
        first = start or token[0] == before
        # At the start of the bucket the first token may go on from the bucket before.
        keep = np.r_[first, same] | np.r_[same, False]
        if not keep[-1]:
            waiting = batch.slice(len(batch) - 1)
        yield batch.filter(pa.array(keep))
        before, start = token[-1], False
    if waiting is not None:
        yield waiting


def shared_anchors(docs: DataFrame, length: int = LENGTH, token: int = TOKEN) -> DataFrame:
    """Anchors of (key, kind, text) rows that share their token with another one, as (key, kind, first, count, left, token)."""
    found = docs.select("key", "kind", "text").mapInArrow(_scan(length, token), _ANCHORS)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.repartitionByRange(parts, "token", "first").sortWithinPartitions("token")
    return dealt.mapInArrow(_shared_tokens, _ANCHORS)


# Rows of windows and instances that a task holds.
_TOGETHER = 40_000

_WINDOWS = (
    "key long, kind tinyint, first int, lead long, token long, c1 long, c2 long, left smallint, count smallint, copies long,"
    " bytes binary"
)


def _signed(raw: bytes) -> int:
    return int.from_bytes(raw, "big", signed=True)


def _cut_windows(length: int):
    """Instances (key, kind, first, c1, c2) and, once for some of them, the different windows with their bytes."""
    kinds = (pa.int64(), pa.int8(), pa.int32(), *[pa.int64()] * 4, pa.int16(), pa.int16(), pa.int64(), pa.binary())
    names = [f.strip().split()[0] for f in _WINDOWS.split(",")]

    def columns(out: list[tuple], windows: dict[tuple[int, int], list]) -> pa.RecordBatch:
        by_column = zip(*out, *map(tuple, windows.values()), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(by_column, kinds, strict=True)], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            windows: dict[tuple[int, int], list] = {}
            for row in rows_of(batch):
                if len(out) + len(windows) >= _TOGETHER:
                    yield columns(out, windows)
                    out, windows = [], {}
                raw = _text_bytes(row["text"])
                for spot in row["spots"]:
                    first, count, left = spot["first"], spot["count"], spot["left"]
                    part = raw[first : first + count + length - 1]
                    digest = xxhash.xxh3_128_digest(part + left.to_bytes(2, "little"))
                    key = _signed(digest[:8]), _signed(digest[8:])
                    out.append((row["key"], row["kind"], first, None, None, *key, None, None, None, None))
                    if key in windows:
                        windows[key][-2] += 1
                    else:
                        lead = int.from_bytes(part[left : left + 8], "big") >> 1
                        windows[key] = [None, None, None, lead, spot["token"], *key, left, count, 1, part]
            if out:
                yield columns(out, windows)

    return cut


_RANGES = "c1 long, c2 long, starts array<int>, ends array<int>"


def _sort_windows(rows: list[dict], length: int) -> pa.RecordBatch | None:
    """Repeats among the windows of whole tokens: byte ranges from the start of each window."""
    merged: dict[tuple[int, int], dict] = {}
    for r in rows:
        key = r["c1"], r["c2"]
        if key in merged:
            merged[key]["copies"] += r["copies"]
        else:
            merged[key] = r
    rows = list(merged.values())
    token = np.array([r["token"] for r in rows])
    count = np.array([r["count"] for r in rows], dtype=np.int64)
    left = np.array([r["left"] for r in rows], dtype=np.int64)
    copies = np.array([r["copies"] for r in rows])
    size = np.array([len(r["bytes"]) for r in rows])
    flat = np.frombuffer(b"".join([r["bytes"] for r in rows]) + bytes(8), dtype=np.uint8)
    base = np.cumsum(size) - size
    of = np.repeat(np.arange(len(rows)), count)
    ordinal = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    # Strings of one group: same token at the same distance from their start.
    kind = np.unique(token, return_inverse=True)[1]
    group = kind[of] * (2 * length) + left[of] - ordinal
    again = repeated_strings(flat, base[of] + ordinal, group, length) | (copies[of] > 1)
    found = []
    for i, (lo, n) in enumerate(zip(np.cumsum(count) - count, count, strict=True)):
        flags = again[lo : lo + n]
        if flags.any():
            found.append((rows[i]["c1"], rows[i]["c2"], *_runs(flags, length)))
    if not found:
        return None
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=["c1", "c2", "starts", "ends"]
    )


def _sort_buckets(length: int, together: int):
    """Windows come in order of lead and token; whole tokens are sorted together."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in rows_of(batch):
                if len(held) >= together and row["token"] != held[-1]["token"]:
                    out = _sort_windows(held, length)
                    if out is not None:
                        yield out
                    held = []
                held.append(row)
        if held:
            out = _sort_windows(held, length)
            if out is not None:
                yield out

    return sort


def _hash_strings(length: int):
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                n, raw = row["count"], row["bytes"]
                digests = [xxhash.xxh3_128_digest(raw[i : i + length]) for i in range(n)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "h1": [_signed(d[:8]) for d in digests],
                        "h2": [_signed(d[8:]) for d in digests],
                        "c1": [row["c1"]] * n,
                        "c2": [row["c2"]] * n,
                        "at": pa.array(np.arange(n, dtype=np.int32)),
                        "copies": pa.array([row["copies"]] * n, pa.int64()),
                    }
                )

    return strings


def numbered(docs: DataFrame) -> DataFrame:
    """(doc_id, text) rows with a (key, kind) of their own: the id where it is unique, else the number of a staged row."""
    often = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter((F.col("n") > 1) | F.isnull("doc_id"))
    often = stage(often.select(F.col("doc_id").alias("_id")), "repeated-ids")
    named = docs.withColumns({"key": F.col("doc_id"), "kind": F.lit(0).cast("tinyint")})
    if often.isEmpty():
        return named
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    rows = stage(docs.join(often, same, "left_semi").withColumn("key", F.monotonically_increasing_id()), "rows-by-number")
    return named.join(often, same, "left_anti").unionByName(rows.withColumn("kind", F.lit(1).cast("tinyint")))


def repeats(docs: DataFrame, steps: Steps, length: int, token: int, crowded: int, together: int) -> DataFrame:
    """(key, kind, starts, ends): repeated byte ranges of each of ``numbered`` rows that has any; ranges may overlap."""
    spots = steps.stage(shared_anchors(docs, length, token), "anchors")
    by_doc = spots.groupBy("key", "kind").agg(
        F.collect_set(F.struct("first", "count", "left", "token")).alias("spots")
    )
    joined = docs.join(by_doc, ["key", "kind"])
    cut = steps.stage(
        joined.select("key", "kind", "text", "spots").mapInArrow(_cut_windows(length), _WINDOWS), "windows"
    )
    instances = cut.filter("bytes is null").select("key", "kind", "first", "c1", "c2")
    windows = cut.filter("bytes is not null").select("lead", "token", "c1", "c2", "left", "count", "copies", "bytes")
    large = steps.stage(
        windows.groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") > crowded).select("token"), "crowded"
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    usual = windows.join(large, "token", "left_anti").select(*windows.columns)
    usual = usual.repartitionByRange(parts, "lead", "token").sortWithinPartitions("lead", "token")
    ranges = usual.mapInArrow(_sort_buckets(length, together), _RANGES)
    if not large.isEmpty():
        hashed = windows.join(large, "token", "left_semi").mapInArrow(
            _hash_strings(length), "h1 long, h2 long, c1 long, c2 long, at int, copies long"
        )
        hashed = steps.stage(hashed, "strings")
        again = hashed.groupBy("h1", "h2").agg(F.sum("copies").alias("n")).filter("n > 1").drop("n")
        marked = hashed.join(again, ["h1", "h2"], "left_semi").groupBy("c1", "c2").agg(F.collect_set("at").alias("starts"))
        ranges = ranges.unionByName(marked.withColumn("ends", F.transform("starts", lambda x: x + F.lit(length))))
    ranges = steps.stage(ranges, "ranges")
    shift = lambda name: F.transform(name, lambda x: x + F.col("first"))
    found = instances.join(ranges, ["c1", "c2"]).select("key", "kind", shift("starts").alias("s"), shift("ends").alias("e"))
    return found.groupBy("key", "kind").agg(
        F.flatten(F.collect_list("s")).alias("starts"), F.flatten(F.collect_list("e")).alias("ends")
    )


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _without(raw: bytes, starts: list[int] | None, ends: list[int] | None) -> tuple[bytes, int]:
    """What is left of ``raw``, and the number of maximal removed runs."""
    if not starts:
        return raw, 0
    change = np.bincount(starts, minlength=len(raw) + 1) - np.bincount(ends, minlength=len(raw) + 1)
    gone = np.cumsum(change)[:-1] > 0
    spans = int((gone & ~np.r_[False, gone[:-1]]).sum())
    return np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes(), spans


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    token: int = TOKEN,
    crowded: int = CROWDED,
    together: int = SORTED_TOGETHER,
    content: bool = False,
) -> DataFrame:
    """A row per document: (doc_id, n_bytes, n_removed, n_spans, kept_sha256), and ``kept`` bytes if ``content``.

    Texts are UTF-8 bytes, null counts as empty. A byte is removed if a string
    of ``length`` bytes over it also starts anywhere else, in the same document
    or another. Repeated rows are documents of their own and so repeat each
    other; ids may be null. Texts shorter than ``length`` stay whole. An empty
    table gives an empty result.
    """
    if not 8 <= token <= length:
        raise ValueError("a token has at least 8 bytes and fits into a string")
    narrow = numbered(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    steps = Steps()
    found = stage(repeats(narrow, steps, length, token, crowded, together), "repeats")
    steps.release()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, starts, ends in zip(*map(values, batch.columns), strict=True):
                raw = _text_bytes(text)
                kept, spans = _without(raw, starts, ends)
                row = (doc_id, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest())
                out.append((*row, kept) if content else row)
            kinds = [*[pa.int64()] * 4, pa.string(), *[pa.binary()] * content]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * content]
            columns = zip(*out, strict=True) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    joined = narrow.join(found, ["key", "kind"], "left").select("doc_id", "text", "starts", "ends")
    return joined.mapInArrow(cut, _RESULT + ", kept binary" * content)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))
