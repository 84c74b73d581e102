"""WARC archives: written from pages, read back, and assembled into one nested row per capture.

A capture is three records. The request and the metadata record name the
response, or the revisit that stands for an equal payload captured elsewhere,
by WARC-Concurrent-To. Archives are plain text to Spark's writer: a record is a
row, its last line feed is the line separator, so the files are WARC files byte
by byte, written with Spark's commit protocol to any store that Spark reaches.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import read, values
from shelfmark.session import new_work_path, stage

# Payloads below this size are stored each time.
LEAST_REVISIT = 1000
# Bytes of a file, about; a file is parsed in one piece.
FILE_BYTES = 12 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_SPACE = uuid.UUID("6f0a5e1c-3f0e-4b1a-9c37-0d6a2f2f7c11")
_DIGEST = T.StructType([T.StructField("sha1", T.StringType()), T.StructField("bytes", T.LongType())])


@F.arrow_udf(_DIGEST)
def payload_digest(payloads: pa.Array) -> pa.Array:
    found = [(hashlib.sha1(p).hexdigest(), len(p)) for p in ((v or "").encode() for v in values(payloads))]
    return pa.StructArray.from_arrays(
        [pa.array([s for s, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=["sha1", "bytes"]
    )


def record_id(page_id: int | None, copy: int, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}:{copy}:{kind}')}>"


def _header_value(value: str) -> str:
    """A value on one line: control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(kind: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record without its last line feed."""
    named = [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in named if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r"


def capture_records(
    page_id: int | None, copy: int, url: str | None, payload: bytes, refers_to: int | None, revisit: bool
) -> list[bytes]:
    """The response (or revisit), request and metadata records of one page."""
    main = record_id(page_id, copy, "response")
    target = None if url is None else _header_value(url)
    shared = [("WARC-Target-URI", target), ("WARC-Date", DATE)]
    digest = f"sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}"
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = [("WARC-Record-ID", main), *shared, ("WARC-Payload-Digest", digest), ("Content-Type", "application/http;msgtype=response")]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, 0, "response"))]
    path = (target or "/").encode()
    request = b"GET " + path.replace(b" ", b"%20") + b" HTTP/1.1\r\n\r\n"
    notes = f"payload-length: {len(payload)}\r\n" + (f"page-id: {page_id}\r\n" if page_id is not None else "")
    beside = lambda kind, media: [
        ("WARC-Record-ID", record_id(page_id, copy, kind)), *shared, ("WARC-Concurrent-To", main), ("Content-Type", media)
    ]
    return [
        record("revisit" if revisit else "response", fields, status if revisit else status + payload),
        record("request", beside("request", "application/http;msgtype=request"), request),
        record("metadata", beside("metadata", "application/warc-fields"), notes.encode()),
    ]


def revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> tuple[DataFrame, float]:
    """(page_id, sha1, refers_to) of every page whose payload is stored with another one, and the mean payload size.

    Only ids, digests and sizes are shuffled, and a task sends one row for all
    equal payloads that it has read.
    """
    narrow = stage(pages.select("page_id", payload_digest("html").alias("d")).select("page_id", "d.sha1", "d.bytes"), "payloads")
    size = narrow.agg(F.avg("bytes")).first()[0]
    large = narrow.filter(F.col("bytes") >= least)
    first = large.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    first = first.filter((F.col("n") > 1) & F.col("refers_to").isNotNull()).drop("n")
    other = large.join(first, "sha1").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return stage(other.select("page_id", "sha1", "refers_to").distinct(), "revisits"), float(size or 0.0)


def _numbered(pages: DataFrame) -> DataFrame:
    """``copy`` tells rows with the same page_id apart; the first is 0. Only such rows are shuffled."""
    several = pages.groupBy("page_id").agg(F.count("*").alias("n")).filter("n > 1")
    several = stage(several.select(F.col("page_id").alias("_several")), "repeated-pages")
    zero = F.lit(0).cast("bigint").alias("copy")
    if several.isEmpty():
        return pages.select("*", zero)
    same = F.col("page_id").eqNullSafe(F.col("_several"))
    # A page without an id is never referred to: any number will do.
    known = Window.partitionBy("page_id").orderBy(F.xxhash64("url", "html"))
    some = pages.join(several.filter("_several is not null"), same, "left_semi")
    return (
        pages.join(several, same, "left_anti").select("*", zero)
        .unionByName(some.withColumn("copy", F.row_number().over(known).cast("bigint") - 1))
        .unionByName(pages.join(several.filter("_several is null"), same, "left_semi").withColumn("copy", F.monotonically_increasing_id()))
    )


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: int = LEAST_REVISIT,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write the captures of all rows to WARC files below ``path``, a folder that does not exist yet.

    Of equal payloads of ``least`` bytes or more, the one with the largest id
    is stored, and the others are revisit records; rows that share that id are
    all stored, as are payloads whose ids are all null. Null payloads are
    empty, a null URL gives no target. Repeated rows are captures of their own.
    """
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    known, size = revisits(rows, least)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            held = 0
            for row in zip(*[values(batch.column(c)) for c in ("page_id", "copy", "url", "html", "refers_to")], strict=True):
                page_id, copy, url, html, refers_to = row
                payload = (html or "").encode()
                out += capture_records(page_id, copy, url, payload, refers_to, refers_to is not None)
                held += len(payload)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pydict({"record": pa.array(out, pa.binary())})
                    out, held = [], 0
            yield pa.RecordBatch.from_pydict({"record": pa.array(out, pa.binary())})

    named = known.toDF("_page", "_sha1", "refers_to")
    # A page id may come with several payloads; the digest tells which of them is stored elsewhere.
    on = F.col("page_id").eqNullSafe(F.col("_page")) & (payload_digest("html")["sha1"] == F.col("_sha1"))
    planned = _numbered(rows).join(named, on, "left").select("page_id", "copy", "url", "html", "refers_to")
    captures = max(1, math.floor(file_bytes / (size + 1500.0)))
    records = planned.mapInArrow(build, "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.option("maxRecordsPerFile", 3 * captures).option("lineSep", "\n").text(path)


def parse_archive(raw: bytes) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """(header fields by lower-case name, block) of every record; bytes that are no record raise ValueError."""
    at = 0
    while at < len(raw):
        if raw[at : at + 2] in (b"\r\n",):
            at += 2
            continue
        end = raw.find(b"\r\n\r\n", at)
        if not raw.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no record at byte {at}")
        fields: dict[str, list[str]] = {}
        for line in raw[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            fields.setdefault(name.decode().strip().lower(), []).append(value.decode().strip())
        size = int(fields["content-length"][0])
        block = raw[end + 4 : end + 4 + size]
        if len(block) < size:
            raise ValueError(f"the record at byte {at} is cut off")
        yield fields, block
        at = end + 4 + size


_RECORDS = (
    "record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, date string,"
    " digest string, fields map<string,string>, payload binary, payload_bytes long, payload_sha1 string"
)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """A row per record of the files below ``path``.

    ``payload`` is the entity body of a response or request, null if not asked
    for; its size and SHA-1 are taken from the bytes. ``fields`` are the lines
    of a metadata record. ``digest`` is what the header says, in hexadecimal.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.strip().split()[0] for c in _RECORDS.replace("map<string,string>", "map").split(",")]
        kinds = [
            pa.string(), pa.string(), pa.list_(pa.string()), *[pa.string()] * 4, pa.map_(pa.string(), pa.string()),
            pa.binary(), pa.int64(), pa.string(),
        ]

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for content in batch.column(0):
                out: list[tuple] = []
                for head, block in parse_archive(content.as_py()):
                    one = lambda name: head[name][0] if name in head else None  # noqa: B023, E731
                    kind = one("warc-type")
                    http = (one("content-type") or "").startswith("application/http")
                    body = block.partition(b"\r\n\r\n")[2] if http else None
                    lines = block.decode().split("\r\n") if kind == "metadata" else []
                    stated = one("warc-payload-digest")
                    digest = base64.b32decode(stated[5:]).hex() if stated and stated.startswith("sha1:") else None
                    out.append((
                        one("warc-record-id"), kind, head.get("warc-concurrent-to", []), one("warc-refers-to"),
                        one("warc-target-uri"), one("warc-date"), digest,
                        [tuple(x.split(": ", 1)) for x in lines if ": " in x],
                        body if payload else None, None if body is None else len(body),
                        None if body is None else hashlib.sha1(body).hexdigest(),
                    ))
                    if len(out) >= 2_000:
                        yield batch_of(out)
                        out = []
                if out:
                    yield batch_of(out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0")
    return files.select("content").mapInArrow(parse, _RECORDS)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: (capture_id, main, requests, metadata).

    ``main`` is the response or revisit record, null where only records that
    name it were found; the other two list the records that name it as
    concurrent. A record that names several captures is part of each. Records
    of other types (warcinfo, resource) take no part. Keys are record ids, so
    no group is larger than a capture.
    """
    main = records.filter(F.col("type").isin("response", "revisit"))
    main = main.select(F.col("record_id").alias("capture_id"), F.struct(*records.columns).alias("main"))
    beside = records.filter(F.col("type").isin("request", "metadata")).select(
        F.explode("concurrent_to").alias("capture_id"), F.struct(*records.columns).alias("beside")
    )
    side = beside.groupBy("capture_id").agg(F.collect_list("beside").alias("beside"))
    of = lambda kind: F.filter(F.coalesce("beside", F.array()), lambda r: r["type"] == kind)
    return main.join(side, "capture_id", "full").select(
        "capture_id", "main", of("request").alias("requests"), of("metadata").alias("metadata")
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_path(spark, "warc")
    write_archives(read(spark, sf_dir, "pages"), path)
    found = captures(read_archives(spark, path, payload=False))
    notes = F.col("metadata")[0]["fields"]
    rows = stage(
        found.select(
            "capture_id", notes["page-id"].cast("bigint").alias("page_id"), F.col("main.type").alias("record_type"),
            F.when(F.col("main.type") == "response", F.col("main.payload_bytes"))
            .otherwise(notes["payload-length"].cast("bigint")).alias("payload_bytes"),
            F.when(F.col("main.type") == "response", F.col("main.payload_sha1"))
            .otherwise(F.col("main.digest")).alias("payload_digest"),
            F.col("main.refers_to").alias("refers_id"),
        ),
        "captures",
    )
    stored = rows.filter("record_type = 'response'").select(F.col("capture_id").alias("refers_id"), F.col("page_id").alias("refers_to"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    again = rows.filter("record_type = 'revisit'").join(stored, "refers_id", "left").select(*columns)
    whole = rows.filter("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("bigint"))
    return whole.select(*columns).unionByName(again)


# Payloads are compared by the text itself.
SQL = """
with p as (select page_id, coalesce(html, '') h, strlen(coalesce(html, '')) n from pages),
g as (select h, max(page_id) first, count(*) c from p where n >= 1000 group by h)
select p.page_id, cast(p.n as bigint) payload_bytes, sha1(p.h) payload_digest,
  case when g.c > 1 and p.page_id <> g.first then 'revisit' else 'response' end record_type,
  case when g.c > 1 and p.page_id <> g.first then g.first end refers_to
from p left join g on p.h = g.h
"""
