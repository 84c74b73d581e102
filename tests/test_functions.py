"""Column functions against plain Python."""

import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import keys, text, vectors
from shelfmark.functions.fingerprint import content_md5, table_fingerprint
from tests.conftest import column


def _random_keys(n=400):
    rng = random.Random(5)
    parts = ["Q1", "Q22", "q3", "Q", "Q4x", "main", "a.b", "", "Q0007", "pkg_1.2.pdf", ".hidden", "x_.pdf", "_1.pdf"]
    return ["/".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) for _ in range(n)]


def test_item_id(table):
    cases = _random_keys() + ["attic/Q77/Q31/leaf.pdf", "Q902/index", "cellar/Q64x/Q8", "Q5\n", ""]
    found = column(table([(c,) for c in cases], "k string"), keys.item_id(F.col("k")))
    expected = []
    for c in cases:
        fits = [p for p in c.split("/") if re.fullmatch(r"Q[0-9]+", p)]
        expected.append(fits[-1] if fits else None)
    assert found == expected


def test_has_extension(table):
    cases = ["a.pdf", "a.PDF", "a.html", "a.txt", "apdf", "a.pdf.csv", "x/.Html", "a.pdf\n"]
    df = table([(c,) for c in cases], "k string")
    expected = [c.lower().endswith((".pdf", ".html", ".txt")) for c in cases]
    assert column(df, keys.has_extension(F.col("k"))) == expected
    assert column(df, keys.has_extension(F.col("k"), ["csv"])) == [c.endswith(".csv") for c in cases]


def test_shard_path(table):
    cases = {"Q40507": "04/05/07/Q40507", " q7 ": "00/00/07/Q7", "Q123456789": "12/34/56/Q123456789", "\tQ1\n": "00/00/01/Q1"}
    assert column(table([(c,) for c in cases], "q string"), keys.shard_path(F.col("q"))) == list(cases.values())


PACKAGE_CASES = [
    # component, title, package, version
    ("lib/zebra_2.0.pdf", None, "zebra", "2.0"),
    ("lib/zebra_2.0.pdf", "heron: waders", "zebra", "2.0"),
    ("tool_box_10.txt", None, "tool_box", "10"),
    ("jay.v_1.tar.gz", None, "jay.v", "1.tar"),
    (".lark_3", None, ".lark", "3"),
    ("Q4/é_9.pdf", None, "é", "9"),
    ("owl_beta.pdf", "owl : night birds : rest", "owl", "unknown"),
    ("_7.pdf", "maple: trees", "maple", "unknown"),
    ("wren_.html", None, "unknown", "unknown"),
    ("wren_.html", "finch", "unknown", "unknown"),
    ("plain", None, "unknown", "unknown"),
    ("plain", "", "unknown", "unknown"),
    ("plain", ": nothing in front", "unknown", "unknown"),
    ("plain", "   : blanks in front", "unknown", "unknown"),
    ("plain", "  elm  : wide", "elm", "unknown"),
]


def test_package_version(table):
    df = table([case[:2] for case in PACKAGE_CASES], "c string, t string")
    package, version = keys.package_version(F.col("c"), F.col("t"))
    assert [tuple(r) for r in df.select(package, version).collect()] == [case[2:] for case in PACKAGE_CASES]


def test_uuid5_and_point_id(table):
    names = ["Q1-0", "", "é", "a" * 200] + [f"Q{i}-{i * 7}" for i in range(100)]
    df = table([(n,) for n in names], "n string")
    assert column(df, keys.uuid5(F.col("n"))) == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]
    row = table([("Q84", 6), ("", 3), (None, 4)], "p string, i int")
    assert column(row, keys.point_id(F.col("i"), F.col("p"))) == [str(uuid.uuid5(uuid.NAMESPACE_DNS, "Q84-6")), "3", "4"]
    assert column(row, keys.point_id(F.col("i"))) == ["6", "3", "4"]


def test_duration(table):
    cases = {None: "unknown", 0.0: "unknown", -1.0: "unknown", float("inf"): "unknown", 0.5: "0s", 45.9: "45s", 200.0: "3m 20s", 3600.0: "1h 0m", 3725.0: "1h 2m", 90000.0: "25h 0m"}
    assert column(table([(c,) for c in cases], "s double"), keys.duration(F.col("s"))) == list(cases.values())


def test_labels(table):
    one = table([(0,), (8,), (99,)], "p int")
    assert column(one, keys.package_id(F.col("p"))) == ["plan_localworker_01", "plan_localworker_09", "plan_localworker_100"]
    name = table([("a",), ("a.json",)], "n string")
    assert column(name, keys.plan_file_name(F.col("n"))) == ["a.json", "a.json"]
    assert column(name.limit(1), keys.join_path(F.lit(""), F.lit("x"), F.lit(None).cast("string"), F.col("n"))) == ["x/a"]
    counts = table([("t", 5, 2), ("t", 5, 0), ("t", 5, -1), ("t", 5, None)], "t string, n bigint, d bigint")
    assert column(counts, keys.signed_count(F.col("t"), F.col("n"), F.col("d"))) == ["t:5 (+2)", "t:5 (+0)", "t:5 (-1)", "t:5"]


def test_timestamps(table):
    df = table([("2024-01-01T12:00:00Z",), ("2024-01-01T13:00:00+01:00",), ("no",)], "t string")
    parsed = keys.parse_timestamp(F.col("t"))
    assert column(df, keys.compact_timestamp(parsed)) == ["20240101T120000Z", "20240101T120000Z", None]
    assert column(df, keys.iso_timestamp(parsed))[0] == "2024-01-01T12:00:00.000000+00:00"


def test_sentences_and_words(table):
    cases = ["One. Two?  Three!\nFour", "No end", "a.b. c", "", "x. y", "Dots... here. ", "A. B. C"]
    df = table([(c,) for c in cases], "t string")
    assert column(df, text.sentences(F.col("t"))) == [re.split(r"(?<=[.?!])\s+", c) for c in cases]
    assert column(df, text.words(F.col("t"))) == [re.findall(r"[^\W_]+", c.lower()) for c in cases]
    assert column(df, text.word_text(F.col("t"))) == [" ".join(re.findall(r"[^\W_]+", c.lower())) for c in cases]


def test_strip_html(table):
    html = "<html><head><title> A &amp; B </title><style>p{}</style></head><body><!-- x --><p>Hi&nbsp;<b>you</b> &lt;3</p><script>if(a<b){}</script></body>"
    df = table([(html,), ("plain",), ("&amp;lt;",)], "h string")
    assert column(df, text.strip_html(F.col("h"))) == ["Hi you <3", "plain", "&lt;"]
    assert column(df, text.html_title(F.col("h"))) == ["A & B", None, None]


def test_embedding_prefix(table):
    rows = [("CRAN_PACKAGE", "p", "Q1", "t"), ("CRAN_PACKAGE", "", "Q1", "t"), ("ATLAS_KG_ITEM", "p", "Q1", "t"),
            ("PUBLICATION", "p", "Q1", None), ("PUBLICATION", "p", "Q1", "T"), ("OTHER", "p", "Q1", "t"), (None, "p", "Q1", "t")]
    df = table(rows, "d string, package string, qid string, title string")
    fields = {n: F.col(n) for n in ("package", "qid", "title")}
    found = column(df, text.embedding_prefix(F.col("d"), fields, text.prefix_rules("Atlas")))
    assert found == ["Package p. ", "", "Atlas item Q1. ", "", "Publication T. ", "", ""]


def test_vectors(table):
    df = table([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    a, b = F.col("a"), F.col("b")
    assert column(df, F.round(vectors.cosine(a, b), 6)) == [0.96, 0.0]
    assert column(df, vectors.dot(a, b)) == [24.0, 0.0]
    assert column(df, F.round(vectors.euclid(a, b), 6)) == [1.414214, 1.0]
    assert column(df, vectors.manhattan(a, b)) == [2.0, 1.0]
    assert column(df, vectors.normalize(a)) == [pytest.approx([0.6, 0.8]), [0.0, 0.0]]
    assert [vectors.resolve_metric(m) for m in ("euclid", "Dot", "nope", None)] == ["EUCLID", "DOT", "COSINE", "COSINE"]


def test_fingerprint(spark, table):
    df = table([("a", None), (None, "a"), ("b", "c")], "x string, y string")
    base = table_fingerprint(df).collect()[0]
    assert table_fingerprint(df.repartition(3)).collect()[0] == base
    assert table_fingerprint(df.filter("x is not null or y is null")).collect()[0] != base
    swapped = table([("a", None), ("a", None), ("b", "c")], "x string, y string")
    assert table_fingerprint(swapped).collect()[0].fingerprint != base.fingerprint
    maps = table([({"a": "1", "b": "2"},)], "m map<string,string>")
    other = table([({"b": "2", "a": "1"},)], "m map<string,string>")
    assert table_fingerprint(maps).collect() == table_fingerprint(other).collect()
    assert table_fingerprint(df.limit(0)).collect()[0].n == 0
    assert column(table([(b"abc",)], "c binary"), content_md5(F.col("c"))) == ["900150983cd24fb0d6963f7d28e17f72"]
