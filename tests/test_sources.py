"""Listings, triples, pages and package files."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import joins
from shelfmark.sources import graph, listing, objects, packages, pages
from tests.conftest import column


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


@pytest.fixture
def tree(tmp_path):
    for name, body in {
        "north/leaves/Q41/birch.html": "<p>Hi</p>",
        "north/leaves/Q306/alder.TXT": "bark",
        "north/loose.txt": "x",
        "south/Q88/figures.csv": "x",
        "south/Q88/two.txt": "page one\fpage two",
        "cover.pdf": "a",
    }.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(body)
    return str(tmp_path)


def test_listing_and_index(spark, tree):
    listed = objects.list_objects(spark, tree)
    assert "north/leaves/Q41/birch.html" in column(listed, "key")
    files = objects.index_files(listed)
    assert rows(objects.indexed(files)) == [
        ("Q306", "north/leaves/Q306/alder.TXT"),
        ("Q41", "north/leaves/Q41/birch.html"),
        ("Q88", "south/Q88/two.txt"),
    ]
    assert tuple(objects.index_summary(files).collect()[0]) == (3, 2)
    again = objects.index_files(listed.union(listed))
    assert again.count() == files.count()


def test_listing_reads_no_content(spark, tree):
    plan = objects.index_files(objects.list_objects(spark, tree))._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile [path" in plan and "content#" not in plan


def test_listing_in_tasks_equals_the_listing(spark, tree, monkeypatch):
    monkeypatch.setattr(listing, "LIST_FOLDERS", 2)
    hidden = Path(tree) / "north" / "_temporary"
    hidden.mkdir()
    (hidden / "x.txt").write_text("x")
    (Path(tree) / "south" / ".hidden.txt").write_text("x")
    (Path(tree) / "south" / "dt=1" / "empty").mkdir(parents=True)
    (Path(tree) / "south" / "dt=1" / "ü 1%.txt").write_text("y")
    cut = F.date_trunc("second", "modified")
    expected = rows(objects.list_objects(spark, tree), "key", "size", cut)
    assert rows(listing.list_in_tasks(spark, tree), "key", "size", cut) == expected and len(expected) == 7
    assert rows(listing.list_in_tasks(spark, f"file://{tree}/"), "key") == [r[:1] for r in expected]
    (Path(tree) / "south" / "blank.txt").write_text("")
    assert ("south/blank.txt", 0) in rows(listing.list_in_tasks(spark, tree), "key", "size")
    with pytest.raises(Exception, match="FileNotFound"):
        listing.list_in_tasks(spark, f"{tree}/nowhere")


def test_stored_files_come_back(spark, tmp_path):
    n = 3_000
    key = F.concat(F.lit("a/Q"), F.col("id") % 5, F.lit("/"), F.col("id"), F.lit(".txt"))
    made = spark.range(n).select(key.alias("key"), F.when(F.col("id") > 0, F.encode(F.col("id").cast("string"), "UTF-8")).alias("content"))
    nobody = spark.createDataFrame([(None, b"x")], "key string, content binary")
    for _ in range(2):  # a second run replaces the files
        assert listing.store_contents(made.repartition(6).unionByName(nobody), str(tmp_path)) == n
    found = listing.list_in_tasks(spark, str(tmp_path))
    assert found.count() == n and found.agg(F.sum("size")).first()[0] == sum(len(str(i)) for i in range(1, n))
    read = objects.fetch_contents(found.select(F.lit("Q").alias("qid"), F.col("key").alias("component")), objects.file_reader(str(tmp_path)))
    assert read.filter("error is null").filter(F.concat(F.lit("/"), F.decode("content", "UTF-8"), F.lit(".txt")) == F.concat(F.lit("/"), F.substring_index("component", "/", -1))).count() == n - 1
    assert listing.store_contents(nobody, str(tmp_path)) == 0


def test_folder_is_not_searched_below(spark, tree):
    assert column(objects.read_folder(spark, tree), "key") == ["cover.pdf"]
    assert column(objects.read_folder(spark, f"{tree}/north/leaves/Q306"), "key") == []


def test_folder_pages(spark, tree):
    found = pages.load_folder(spark, f"{tree}/south/Q88", ".txt")
    assert rows(found, "component", "page", "text") == [("two.txt", 0, "page one"), ("two.txt", 1, "page two")]


def test_contents_of_wanted_files(spark, tree, table, monkeypatch):
    wanted = table([("Q88", "south/Q88/two.txt")], "qid string, component string")
    contents = objects.read_contents(spark, tree, ".txt")
    found = objects.select_contents(contents, wanted)
    assert [(r.qid, bytes(r.content)) for r in found.collect()] == [("Q88", b"page one\x0cpage two")]
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(joins, "is_small", lambda df: False)
    assert objects.select_contents(contents, wanted).count() == 1


@pytest.mark.parametrize("held", [0, 1 << 20])
def test_fetch_reads_each_file_in_the_tasks(tree, table, monkeypatch, held):
    monkeypatch.setattr(objects, "FETCH_BYTES", held)
    wanted = table([("Q88", "south/Q88/two.txt"), ("Q89", "south/Q89/gone.txt")], "qid string, component string")
    fetched = objects.fetch_contents(wanted, objects.file_reader(tree))
    good, bad = pages.split_errors(pages.load_pages(fetched))
    assert rows(good, "qid", "page", "text") == [("Q88", 0, "page one"), ("Q88", 1, "page two")]
    assert [(r.qid, "FileNotFoundError" in r.error) for r in bad.collect()] == [("Q89", True)]


def test_list_components(table):
    listed = table(
        [("main/00/00/01/Q1/components/a.pdf",), ("main/00/00/01/Q1/components/b.pdf",), ("main/00/00/02/Q2/other/c.pdf",),
         ("main/00/00/01/Q1x/components/d.pdf",), ("dev/00/00/01/Q1/components/e.pdf",)],
        "key string",
    )
    items = table([("Q1",), ("Q2",)], "qid string")
    assert rows(objects.list_components(listed, items, "main")) == [("Q1", "a.pdf"), ("Q1", "b.pdf")]
    assert rows(objects.list_components(listed, items)) == []


def test_items(table):
    triples = table([("http://k/e/Q2", "P", "W"), ("http://k/e/Q1", "P", "W"), ("http://k/e/Q3", "P", "X"), ("Q4", "P", "W")], "s string, p string, o string")
    assert column(graph.items_from_triples(triples, "P", "W", ordered=True), "qid") == ["Q1", "Q2", "Q4"]
    bodies = table(
        [('{"results":{"bindings":[{"qid":{"value":"Q1"}},{"qid":{"value":"Q2"}}]}}',), ('{"results":{}}',), ("{}",), ("no json",)],
        "body string",
    )
    assert sorted(column(graph.items_from_bindings(bodies), "qid")) == ["Q1", "Q2"]


def test_pages_of_all_types(table):
    def pdf(content):
        if content == b"broken":
            raise ValueError("cannot read")
        return content.decode().split("|"), "pkg: Title"

    files = table(
        [("Q1", "a.txt", b"one\x0ctwo"), ("Q2", "b.HTML", b"<title>T</title><p>Hi</p>"), ("Q3", "c.pdf", b"x|y"),
         ("Q4", "d.pdf", b"broken"), ("Q5", "e.doc", b"?"), ("Q6", "noext", b"?")],
        "qid string, component string, content binary",
    )
    loaded = pages.load_pages(files, {"pdf": pdf})
    good, bad = pages.split_errors(loaded)
    assert rows(good.na.fill("-"), "qid", "page", "title", "text") == [
        ("Q1", 0, "-", "one"), ("Q1", 1, "-", "two"), ("Q2", 0, "T", "Hi"), ("Q3", 0, "pkg: Title", "x"), ("Q3", 1, "pkg: Title", "y"),
    ]
    assert rows(bad, "qid", "error") == [
        ("Q4", "ValueError: cannot read"), ("Q5", "no extractor for type: doc"), ("Q6", "no extractor for type: "),
    ]
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    # One pass over the contents, whatever the types.
    assert plan.count("ArrowEvalPython") <= 1 and "Union" not in plan


def test_package_files(spark, tmp_path, table):
    root = tmp_path / "plans"
    (root / "planned").mkdir(parents=True)
    body = '{"package_id":"plan_x","entries":[{"qid":"Q1","component":"a"},{"qid":"","component":"b"},{"component":"c"},{"qid":"Q2","component":"d"}]}'
    (root / "planned" / "plan_x.json").write_text(body)
    for name in ("plan_x", "plan_x.json"):
        good, dropped = packages.read_entries(packages.read_package(spark, str(root), name))
        assert rows(good) == [("Q1", "a"), ("Q2", "d")]
        assert dropped.count() == 2
    assert packages.read_package(spark, str(root), "plan_y") is None
    good, dropped = packages.read_entries(table([("not json",), ('{"entries": []}',), ("{}",)], "body string"))
    assert good.count() == dropped.count() == 0
