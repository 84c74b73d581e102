import hashlib
from collections import Counter, defaultdict

import pytest

from shelfmark.llm import warc as w

SCHEMA = "page_id long, url string, html string"
BIG = "<p>" + "x" * 2000


def expected(rows):
    groups = defaultdict(list)
    for i, _, h in rows:
        groups[(h or "").encode()].append(i)
    out = []
    for raw, ids in groups.items():
        first = max((i for i in ids if i is not None), default=None) if len(ids) > 1 and len(raw) >= 1000 else None
        for i in ids:
            again = first is not None and i != first
            out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def run(spark, df, tmp_path, monkeypatch):
    monkeypatch.setattr(w, "read", lambda *_: df)
    got = w.op8_warc(spark, str(tmp_path))
    return sorted(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


ROWS = [
    (1, "http://a/", BIG), (2, "http://b/x y", BIG), (3, None, BIG), (None, "http://c/", BIG), (4, "http://d/", None), (5, "", ""),
    (6, "http://e/\r\nWARC-Type: x", "é" * 600), (7, "u", "é" * 600), (8, "u", "y" * 999), (9, "u", "y" * 999),
    (10, "u", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n" * 40),
    (11, "u", "line\n\nline\r\n\r"), (12, "u", "z" * 3_000_000), (None, "u", "only null ids" * 200), (None, "v", "only null ids" * 200),
    (20, "u", BIG + "1"), (20, "v", BIG + "1"), (19, "u", BIG + "1"), (20, "u", BIG), (30, "same", BIG + "2"), (30, "same", BIG + "2"),
]


def test_edge_cases(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], SCHEMA + ", record_type string").repartition(3)
    assert run(spark, df, tmp_path, monkeypatch) == expected(ROWS)


def test_empty_table(spark, tmp_path, monkeypatch):
    assert run(spark, spark.createDataFrame([], SCHEMA), tmp_path, monkeypatch) == []


def test_round_trip_of_the_given_pages(spark, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    w.write_archives(pages, str(tmp_path / "out"), file_bytes=60_000)
    files = list((tmp_path / "out").glob("part-*"))
    assert len(files) > 1 and b"".join(f.read_bytes()[:10] for f in files) == b"WARC/1.1\r\n" * len(files)
    records = list(w.parse_archive(b"".join(f.read_bytes() for f in files)))
    assert Counter(h["warc-type"][0] for h, _ in records) == dict.fromkeys(("response", "request", "metadata"), pages.count())
    got = w.captures(w.read_archives(spark, str(tmp_path / "out"))).collect()
    read = {(int(c.metadata[0].fields["page-id"]), c.main.target_uri, bytes(c.main.payload).decode()) for c in got}
    assert read == {(p.page_id, p.url, p.html) for p in pages.collect()} and len(got) == len(read)
    for c in got:
        assert [r.type for r in c.requests] == ["request"] and c.requests[0].concurrent_to == [c.capture_id]
        assert c.main.digest == c.main.payload_sha1 == hashlib.sha1(bytes(c.main.payload)).hexdigest()


def test_records_of_other_writers(spark, tmp_path):
    """Records in any order and file, several concurrent ids, orphans, other types, and a header without a space."""
    make = lambda kind, rid, *more, block=b"": w.record(kind, [("WARC-Record-ID", rid), *more], block) + b"\n"
    http = ("Content-Type", "application/http;msgtype=response")
    (tmp_path / "part-1.warc").write_bytes(
        make("request", "<r>", ("WARC-Concurrent-To", "<a>"), ("WARC-Concurrent-To", "<b>"))
        + make("warcinfo", "<i>") + make("metadata", "<m>", ("WARC-Concurrent-To", "<gone>"), block=b"k: v\r\n")
        + b"WARC/1.0\r\nWARC-Type:response\r\nWARC-Record-ID:<a>\r\nContent-Length:0\r\n\r\n\r\n\r\n"
    )
    (tmp_path / "part-2.warc").write_bytes(make("response", "<b>", http, block=b"HTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n"))
    got = {c.capture_id: c for c in w.captures(w.read_archives(spark, str(tmp_path))).collect()}
    assert set(got) == {"<a>", "<b>", "<gone>"}
    assert got["<gone>"].main is None and got["<gone>"].metadata[0].fields == {"k": "v"}
    assert [r.record_id for r in got["<a>"].requests] == [r.record_id for r in got["<b>"].requests] == ["<r>"]
    assert bytes(got["<b>"].main.payload) == b"body\r\n\r\n" and got["<a>"].main.payload is None


def test_broken_archives_are_refused():
    good = w.record("response", [], b"abc") + b"\n"
    with pytest.raises(ValueError, match="cut off"):
        list(w.parse_archive(good[:-6]))
    with pytest.raises(ValueError, match="no record"):
        list(w.parse_archive(good + b"junk\r\n\r\n"))
