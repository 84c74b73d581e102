"""The registered queries."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import keys, vectors
from shelfmark.functions.fingerprint import content_md5, table_fingerprint
from shelfmark.functions.text import embedding_prefix, html_title, prefix_rules, strip_html
from shelfmark.operators import ann, chunking, context, knn, points, runlog, textindex
from shelfmark.operators.arrays import unnest
from shelfmark.operators.backlog import backlog, item_overlap
from shelfmark.operators.counts import count_deltas, count_message, freshness, table_counts
from shelfmark.operators.embedding import HashedEmbedder, embed_column, row_embedder
from shelfmark.operators.guard import oversized, page_stats, within_limit
from shelfmark.operators.items import new_items, page
from shelfmark.operators.packages import cut_packages, package_documents, package_json, reservations
from shelfmark.operators.upsert import latest_by_key, upsert
from shelfmark.plans.collection import Collection
from shelfmark.plans.embed import embed_backlog
from shelfmark.plans.planning import plan_packages
from shelfmark.plans.rankedindex import RankedIndex
from shelfmark.plans.retrieve import retrieve
from shelfmark.plans.run import incremental_run, run_package
from shelfmark.plans.state import StateStore
from shelfmark.plans.textvectors import TextVectors
from shelfmark.schemas import DOC_KEYS, PLAN, ChunkParams
from shelfmark.session import new_work_path, ship, stage
from shelfmark.sources.graph import items_from_bindings
from shelfmark.sources.listing import list_in_tasks, store_contents
from shelfmark.sources.objects import fetch_contents, file_reader, index_files, index_summary, indexed, list_components
from shelfmark.sources.packages import package_entries, read_entries
from shelfmark.sources.pages import load_pages, split_errors
from shelfmark.streaming import jobs
from workload import views
from workload.views import table

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

DIM = 64
SEMANTIC = ChunkParams(min_chunk_size=300, target_max_chunk_size=1_000_000_000, buffer_size=1)


def query(fn: Query) -> Query:
    """Register ``fn``; a trailing underscore keeps a query from hiding an imported name."""
    _REGISTRY[fn.__name__.rstrip("_")] = fn
    return fn


def registered() -> dict[str, Query]:
    def shipped(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark, "workload")
            return fn(spark, sf_dir.rstrip("/"))

        return run

    return {name: shipped(fn) for name, fn in _REGISTRY.items()}


def _second(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


# Items -------------------------------------------------------------------


@query
def item_list_from_triples(spark, sf):
    return views.items(spark, sf).orderBy("qid")


@query
def item_list_page(spark, sf):
    return page(views.items(spark, sf), "qid", offset=10, limit=50)


def _known_items(spark, sf):
    owners = table(spark, sf, "customer").filter("c_acctbal > 0")
    known = owners.select(F.concat(F.lit("Q"), F.col("c_custkey").cast("string")).alias("qid"))
    return views.items(spark, sf).join(known, "qid", "left_semi")


@query
def items_incremental_anti(spark, sf):
    return new_items(views.items(spark, sf), _known_items(spark, sf))


@query
def items_offset(spark, sf):
    """The pull that skips as many items as are known."""
    return new_items(views.items(spark, sf), _known_items(spark, sf), mode="offset")


@query
def items_from_bindings_(spark, sf):
    binding = F.array(F.struct(F.struct(F.concat(F.lit("Q"), F.col("c_custkey").cast("string")).alias("value")).alias("qid")))
    bodies = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") == "FURNITURE", F.lit('{"head": {}}'))
        .otherwise(F.to_json(F.struct(F.struct(binding.alias("bindings")).alias("results"))))
        .alias("body")
    )
    return items_from_bindings(bodies)


# File index --------------------------------------------------------------


@query
def shard_paths(spark, sf):
    return views.items(spark, sf).select("qid", keys.shard_path(F.col("qid")).alias("path"))


@query
def file_index(spark, sf):
    return indexed(index_files(views.objects(spark, sf)))


@query
def file_index_summary(spark, sf):
    return index_summary(index_files(views.objects(spark, sf)))


@query
def component_listing(spark, sf):
    return list_components(views.objects(spark, sf), views.items(spark, sf), "main")


@query
def qid_overlap_count(spark, sf):
    return item_overlap(views.files(spark, sf), views.items(spark, sf)).agg(F.count("*").alias("n"))


@query
def package_version(spark, sf):
    sized = F.concat(F.lit("_"), F.col("p_size").cast("string"), F.lit(".0"))
    named = table(spark, sf, "part").select(
        "p_partkey",
        F.concat(
            F.lit("lib/"),
            F.replace("p_name", F.lit(" "), F.lit("_")),
            F.when(F.col("p_size") % 3 == 0, "").otherwise(sized),
            F.lit(".tar.pdf"),
        ).alias("component"),
        F.when(F.col("p_size") % 2 == 0, F.concat_ws(" : ", "p_brand", "p_type")).otherwise(F.col("p_type")).alias("title"),
    )
    package, version = keys.package_version(F.col("component"), F.col("title"))
    return named.select("p_partkey", package.alias("package"), version.alias("version"))


# Backlog and packages ----------------------------------------------------


def _backlog(spark, sf, mode, ordered=False):
    return backlog(views.files(spark, sf), views.items(spark, sf), views.status(spark, sf), mode, ordered=ordered)


@query
def backlog_new(spark, sf):
    return _backlog(spark, sf, "new")


@query
def backlog_retry(spark, sf):
    return _backlog(spark, sf, "retry", ordered=True)


@query
def work_packages(spark, sf):
    return cut_packages(_backlog(spark, sf, "retry"), 10, 20)


@query
def backlog_batches(spark, sf):
    return cut_packages(_backlog(spark, sf, "retry"), 10)


@query
def plan_documents(spark, sf):
    packaged = cut_packages(_backlog(spark, sf, "retry"), 10)
    made = package_documents(packaged, F.lit("none"), F.lit("2024-01-01T00:00:00+00:00"))
    return package_json(made)


@query
def plan_entries(spark, sf):
    listed = index_files(views.objects(spark, sf), distinct=False)
    entry = F.struct("qid", "component")
    bodies = listed.select(F.to_json(F.struct(F.array(entry).alias("entries"))).alias("body"))
    return package_entries(bodies).drop("document_type")


@query
def plan_files(spark, sf):
    """Package files for the whole backlog, written and read back."""
    root = new_work_path(spark, "plans")
    store = StateStore(spark, f"{root}/state")
    tables = _state(spark, sf)
    tables["software_index"] = tables["software_index"].withColumn("updated_at", F.lit(None).cast("timestamp"))
    store.publish(tables)
    plan_packages(store, root, size=100)
    entries = F.from_json("value", PLAN)["entries"]
    stored = spark.read.text(f"{root}/planned").select("package_id", F.posexplode(entries).alias("position", "entry"))
    return stored.select("package_id", "position", "entry.qid", "entry.component")


@query
def status_upsert(spark, sf):
    planned = reservations(work_packages(spark, sf), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return upsert(views.status(spark, sf), planned, DOC_KEYS).select(*DOC_KEYS, _second("updated_at"), "status")


@query
def status_latest_events(spark, sf):
    newest = latest_by_key(views.status_events(table(spark, sf, "events")), DOC_KEYS, ["updated_at"])
    return newest.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


# State -------------------------------------------------------------------


def _state(spark, sf):
    return {
        "software_index": views.items(spark, sf),
        "component_index": views.file_dates(spark, sf),
        "embeddings_index": views.status(spark, sf),
    }


def _baseline(spark, sf):
    early = views.file_dates(spark, sf).filter("updated_at < timestamp '1998-01-01'")
    return table_counts({"software_index": _known_items(spark, sf), "component_index": early})


@query
def state_counts(spark, sf):
    return count_deltas(table_counts(_state(spark, sf)), _baseline(spark, sf)).select("table", "n", "delta")


@query
def state_message(spark, sf):
    return count_message(count_deltas(table_counts(_state(spark, sf)), _baseline(spark, sf)))


@query
def max_updated_freshness(spark, sf):
    # Read in the session time zone, as the stored dates are.
    now = F.lit("2001-08-01 00:30:00").cast("timestamp")
    return freshness(views.status(spark, sf), now, timedelta(hours=1)).select(_second("updated_at"), "is_fresh")


@query
def state_publish(spark, sf):
    store = StateStore(spark, new_work_path(spark, "state"))
    tables = _state(spark, sf)
    tables["software_index"] = tables["software_index"].withColumn("updated_at", F.lit(None).cast("timestamp"))
    store.publish(tables)
    return table_counts(store.read()).select("table", "n")


@query
def table_fingerprint_(spark, sf):
    status = views.status(spark, sf)
    base = table_fingerprint(status)
    moved = table_fingerprint(status.repartition(7, "component")).select(F.col("fingerprint").alias("moved"))
    changed = status.withColumn("status", F.when(F.col("status") != "planned", F.col("status")))
    other = table_fingerprint(changed).select(F.col("fingerprint").alias("other"))
    one = [df.withColumn("_one", F.lit(1)) for df in (base, moved, other)]
    return one[0].join(one[1], "_one").join(one[2], "_one").select(
        "n",
        (F.col("fingerprint") == F.col("moved")).alias("stable"),
        (F.col("fingerprint") != F.col("other")).alias("sensitive"),
    )


# Pages and chunks --------------------------------------------------------


@query
def doc_page_stats(spark, sf):
    return page_stats(views.conversation_pages(spark, sf))


@query
def page_guard_status(spark, sf):
    return oversized(views.conversation_pages(spark, sf), 5)


@query
def pages_within_limit(spark, sf):
    pages = views.conversation_pages(spark, sf).select(*DOC_KEYS, "page")
    return within_limit(pages, oversized(pages, 5))


@query
def html_pages(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", html_title(F.col("html")).alias("title"), F.md5(strip_html(F.col("html"))).alias("text_md5")
    )


@query
def fixed_chunks(spark, sf):
    pages = views.document_pages(spark, sf).select(*DOC_KEYS, "page", "text")
    return chunking.fixed_chunks(pages).select(
        *DOC_KEYS, "chunk_index", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5")
    )


@query
def chunk_outliers(spark, sf):
    pages = views.document_pages(spark, sf).select(*DOC_KEYS, "page", "text")
    return chunking.outlier_summary(chunking.fixed_chunks(pages), ChunkParams())


@query
def default_chunks(spark, sf):
    pages = views.conversation_pages(spark, sf).select(*DOC_KEYS, "page", "text")
    return chunking.chunk_pages(pages).select(*DOC_KEYS, "page", "chunk_index", F.md5("text").alias("text_md5"))


@query
def semantic_chunks(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    pieces = chunking.semantic_pieces(docs, SEMANTIC, HashedEmbedder(DIM))
    return unnest(pieces, F.col("pieces"), "piece", "position").select(
        "doc_id", "position", "piece.start_index", F.md5("piece.text").alias("text_md5")
    )


def _document_chunks(spark, sf):
    pages = points.add_metadata(views.document_pages(spark, sf), F.col("document_type"))
    return chunking.fixed_chunks(pages.select(*DOC_KEYS, "page", "text", "title", "source", "package", "version", "document_type"))


def _vector_sum():
    """The weights of a vector, each times its place from 1, in sum: differs if any weight does."""
    weighted = F.transform("vector", lambda x, i: x.cast("double") * (i + 1))
    return F.round(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x), 4)


@query
def chunk_points(spark, sf):
    made = points.to_points(_document_chunks(spark, sf), HashedEmbedder(DIM), rules=prefix_rules(views.GRAPH))
    content, rest = points.split_payload(F.col("payload"))
    fields = [F.col("rest")[name].alias(name) for name in ("qid", "chunk_index", "package", "version", "document_type")]
    made = made.select("id", rest.alias("rest"), F.md5(content).alias("text_md5"), _vector_sum().alias("vector_sum"))
    return made.select("id", *fields, "text_md5", "vector_sum")


@query
def points_upsert(spark, sf):
    """Points written in two overlapping parts: the second replaces what both hold."""
    target = Collection(spark, new_work_path(spark, "points"))
    target.ensure(DIM)
    made = stage(points.to_points(_document_chunks(spark, sf), HashedEmbedder(DIM), rules=prefix_rules(views.GRAPH)), "made")
    target.upsert(made.filter(F.col("payload")["package"].isin("src1", "src2", "src3")))
    target.upsert(made)
    return target.points().select(
        "id", "qid", F.md5(F.col("payload")["page_content"]).alias("text_md5"), _vector_sum().alias("vector_sum")
    )


# Embedding and search ----------------------------------------------------


@query
def embedding_prefix_(spark, sf):
    docs = points.add_metadata(views.document_pages(spark, sf), F.col("document_type"))
    fields = {name: F.col(name) for name in ("package", "qid", "title")}
    prefix = embedding_prefix(F.col("document_type"), fields, prefix_rules(views.GRAPH))
    return docs.select("doc_id", prefix.alias("prefix"), F.md5(F.concat(prefix, F.col("text"))).alias("embedded_md5"))


@query
def hash_embedding(spark, sf):
    turns = table(spark, sf, "conversations")
    embedded = turns.select("conv_id", "turn", embed_column(F.col("text"), HashedEmbedder(DIM)).alias("v"))
    entries = unnest(embedded, F.col("v"), "weight", "bucket").drop("v").filter("weight > 0")
    return entries.withColumn("weight", F.round(F.col("weight").cast("double"), 6))


@query
def embed_user_model(spark, sf):
    model = row_embedder(lambda text: [float(len(text))], dim=1)
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", embed_column(F.col("text"), model)[0].cast("double").alias("value"))


@query
def embed_repeated(spark, sf):
    """Half of the texts, then all of them: the model is given what it has not seen, and every row has its vector."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    known = TextVectors(spark, new_work_path(spark, "vectors"), HashedEmbedder(DIM))
    known.learn(docs.filter("doc_id % 2 = 0"), F.col("text"))
    given, _ = known.learn(docs, F.col("text"))
    made = known.embed(docs, F.col("text")).select("doc_id", F.col("_e.vector").alias("vector"))
    return made.select("doc_id", F.lit(given).cast("bigint").alias("n_given"), _vector_sum().alias("vector_sum"))


@query
def vector_normalize(spark, sf):
    scaled = F.transform("embedding", lambda x: (x.cast("double") * (F.col("label") + 2)))
    unit = vectors.normalize(scaled)
    rows = unnest(table(spark, sf, "embeddings"), unit, "value", "at").select("vec_id", "at", "value")
    return rows.withColumn("value", F.round(F.col("value").cast("double"), 6))


def _knn(spark, sf, metric, k=30, **options):
    stored = table(spark, sf, "embeddings")
    corpus = stored.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    asked = stored.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return knn.top_k(corpus, asked, k, metric, **options).hits


@query
def knn_cosine(spark, sf):
    return _knn(spark, sf, "COSINE")


@query
def knn_dot(spark, sf):
    return _knn(spark, sf, "DOT")


@query
def knn_euclid(spark, sf):
    return _knn(spark, sf, "EUCLID")


@query
def knn_manhattan(spark, sf):
    return _knn(spark, sf, "MANHATTAN")


@query
def knn_blocked(spark, sf):
    """Both sides cut into blocks, as for query sets too large to share."""
    return _knn(spark, sf, "COSINE", 10, max_shared_queries=0)


@query
def knn_lsh(spark, sf):
    stored = table(spark, sf, "embeddings")
    corpus = stored.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    asked = stored.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return ann.approximate_top_k(corpus, asked, 10, dim=64, bits=6)


def _retrieved(spark, sf, k, **options):
    embedder = HashedEmbedder(DIM)
    corpus = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        embed_column(F.col("text"), embedder).alias("vector"),
        F.create_map(F.lit("page_content"), F.col("text")).alias("payload"),
    )
    return retrieve(corpus, views.user_questions(spark, sf), embedder, k, **options)


@query
def retrieve_text(spark, sf):
    return _retrieved(spark, sf, 30).select("query_id", "id", "score", "rank", F.md5("page_content").alias("text_md5"))


@query
def retrieve_with_vectors(spark, sf):
    hits = _retrieved(spark, sf, 5, with_vectors=True)
    # Each component of a unit vector by its place: the sum tells vectors apart, whatever their order of magnitude.
    placed = F.transform("vector", lambda x, i: x.cast("double") * (i + 1))
    total = F.round(F.aggregate(placed, F.lit(0.0), lambda a, x: a + x), 4).alias("vector_sum")
    return hits.select("query_id", "id", "rank", total, F.md5(F.col("metadata")["page_content"]).alias("text_md5"))


@query
def rag_context(spark, sf):
    return context.contexts(_retrieved(spark, sf, 5))


@query
def rag_prompt(spark, sf):
    questions = views.user_questions(spark, sf).withColumnRenamed("text", "question")
    return context.prompts(questions, context.contexts(_retrieved(spark, sf, 5)))


# Text index --------------------------------------------------------------


def _postings(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("page_content"))
    return textindex.postings(docs)


def _benchmark(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


@query
def text_postings(spark, sf):
    return _postings(spark, sf)


@query
def token_frequency(spark, sf):
    return textindex.document_frequency(_postings(spark, sf))


@query
def lexical_match_all(spark, sf):
    return textindex.lexical_match(_postings(spark, sf), _benchmark(spark, sf), "and")


@query
def lexical_match_any(spark, sf):
    return textindex.lexical_match(_postings(spark, sf), _benchmark(spark, sf), "or", k=20)


@query
def lexical_bm25(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("page_content"))
    index = RankedIndex(spark, new_work_path(spark, "ranked"))
    index.build(docs, window=64)
    return index.search(_benchmark(spark, sf), 20).hits


@query
def hybrid_search(spark, sf):
    """Questions looked up by their words and by their vectors in one collection."""
    embedder = HashedEmbedder(DIM)
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.lit(None).cast("string").alias("qid"),
        F.lit(None).cast("string").alias("component"), embed_column(F.col("text"), embedder).alias("vector"),
        F.col("text").alias("page_content"), F.create_map(F.lit("lang"), "lang").alias("payload"),
    )
    target = Collection(spark, new_work_path(spark, "points"))
    target.ensure(DIM)
    target.upsert(docs)
    asked = _benchmark(spark, sf).withColumn("vector", embed_column(F.col("text"), embedder))
    return target.search_hybrid(asked, 10, depth=30)


@query
def collection_lexical(spark, sf):
    """Texts written twice, the second time with other texts for every third id; the index follows by itself."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    target = Collection(spark, new_work_path(spark, "points"))
    target.ensure(1)
    none = F.lit(None).cast("string")

    def stored(rows):
        vector, payload = F.array(F.lit(1.0)), F.create_map(F.lit("k"), F.lit("v"))
        return rows.select(
            "id", none.alias("qid"), none.alias("component"), vector.alias("vector"),
            F.col("text").alias("page_content"), payload.alias("payload"),
        )

    target.upsert(stored(docs))
    third = F.col("id").cast("bigint") % 3 == 0
    target.upsert(stored(docs.filter(third).withColumn("text", F.concat(F.lit("rewritten "), "text"))))
    asked = spark.createDataFrame([(1, "rewritten"), (2, "the of"), (3, "nowhere")], "query_id int, text string")
    return target.search_text(asked)


def _points(spark, sf):
    return stage(
        table(spark, sf, "embeddings").select(
            F.col("vec_id").cast("string").alias("id"), F.lit(None).cast("string").alias("qid"),
            F.lit(None).cast("string").alias("component"), F.col("embedding").alias("vector"),
            F.concat(F.lit("text "), F.col("vec_id")).alias("page_content"),
            F.create_map(F.lit("label"), F.col("label").cast("string")).alias("payload"),
        ), "made",
    )


def _asked(made):
    return made.filter(F.col("id").cast("bigint") % 50 == 0).select(F.col("id").alias("query_id"), "vector")


@query
def collection_ann(spark, sf):
    """The vector index of a collection, a part of which was replaced after the index was built."""
    made = _points(spark, sf)
    target = Collection(spark, new_work_path(spark, "points"))
    target.ensure(64)
    target.upsert(made)
    target.index_vectors()
    tenth = made.filter(F.col("id").cast("bigint") % 10 == 0)
    target.upsert(tenth.withColumn("vector", F.transform("vector", lambda x: -x)))
    return target.search_vectors(_asked(made), 10)


@query
def collection_retrieve(spark, sf):
    """A collection of which a part was replaced, searched over its current points."""
    made = _points(spark, sf)
    target = Collection(spark, new_work_path(spark, "points"))
    target.ensure(64)
    target.upsert(made)
    half = made.filter(F.col("id").cast("bigint") % 2 == 0)
    target.upsert(half.withColumn("vector", F.transform("vector", lambda x: -x)))
    found = knn.top_k(target.points(), _asked(made), 10)
    hits = knn.with_payload(found, target.points().select("id", "payload"))
    content, rest = points.split_payload(F.col("payload"))
    return hits.select("query_id", "id", "score", "rank", content.alias("page_content"), rest["label"].alias("label"))


@query
def payload_metadata(spark, sf):
    """What an extractor finds besides the text reaches the payload; fields of the chunk win."""

    def extract(content):
        pages = content.decode("utf-8").split("\n")
        return pages, None, [{"lines": len(pages), "page": "hidden", "producer": f"line {i}"} for i in range(len(pages))]

    stored = _stored_files(spark, sf)
    target = Collection(spark, new_work_path(spark, "points"))
    embed_backlog(
        stored.select("qid", F.col("key").alias("component")), stored.select("key", "content"),
        views.status(spark, sf).limit(0), target, HashedEmbedder(DIM), extractors={"pdf": extract, "bin": extract},
        max_pages=None, id_cols=("qid", "component"),
    )
    stored_pages = target.points().select("qid", "payload").filter(F.col("payload")["producer"].isNotNull())
    of = lambda name: F.col("payload")[name]
    per_page = stored_pages.select("qid", *[of(n).alias(n) for n in ("lines", "page", "producer")]).distinct()
    return per_page


@query
def chunk_min_length(spark, sf):
    """Overlap and outliers by another least length than that of the sentence joiner."""
    made = chunking.fixed_chunks(views.document_pages(spark, sf), min_length=120)
    odd = chunking.is_outlier(F.col("text"), ChunkParams(), 120)
    return made.select(*DOC_KEYS, "chunk_index", F.md5("text").alias("text_md5"), odd.alias("is_outlier"))


@query
def embed_second_run(spark, sf):
    """Half of the files, then all of them: what has a status is not embedded again, and only the rest adds points."""
    stored = _stored_files(spark, sf)
    todo = stored.select("qid", F.col("key").alias("component"))
    target = Collection(spark, new_work_path(spark, "points"))
    even = F.substring("qid", 2, 20).cast("bigint") % 2 == 0
    options = {"extractors": {"pdf": _lines}, "max_pages": None, "now": datetime(2024, 1, 1)}
    contents = stored.select("key", "content")
    first = embed_backlog(todo.filter(even), contents, views.status(spark, sf).limit(0), target, HashedEmbedder(DIM), **options)
    second = embed_backlog(todo, contents, first.status, target, HashedEmbedder(DIM), **{**options, "now": datetime(2024, 1, 2)})
    unread = second.quarantine.select("qid", F.lit("quarantined").alias("status"), F.lit(None).cast("string").alias("run_day"))
    return second.status.select("qid", "status", F.date_format("updated_at", "yyyy-MM-dd").alias("run_day")).unionByName(unread)


@query
def publish_twice(spark, sf):
    """An unchanged state is not published again; a changed one is, and the former stays readable."""
    store = StateStore(spark, f"{new_work_path(spark, 'state')}")
    tables = store.read()
    tables["embeddings_index"] = stage(views.status(spark, sf), "status")
    first = store.publish(tables)
    same = store.publish(tables)
    failed = tables["embeddings_index"].filter("status like 'failed%'")
    changed = store.publish({**tables, "embeddings_index": failed})
    former = store.read(first.snapshot_id)["embeddings_index"]
    n_former, n_now = former.count(), failed.count()
    rows = [(step, done.changed, n_former, n_now) for step, done in (("first", first), ("same", same), ("changed", changed))]
    return spark.createDataFrame(rows, "step string, changed boolean, n_former bigint, n_now bigint")


@query
def state_diff(spark, sf):
    """What differs between two snapshots of which the second was made by an update of some keys."""
    store = StateStore(spark, new_work_path(spark, "state"), bucket_rows=500)
    tables = store.read()
    status = stage(views.status(spark, sf), "status")
    tables["embeddings_index"] = status
    first = store.publish(tables)
    failed = status.filter("status like 'failed%'").withColumn("status", F.lit("ok"))
    new = status.filter("status = 'ok'").withColumn("component", F.concat("component", F.lit(".new")))
    store.update({"embeddings_index": failed.unionByName(new)})
    second = store.read()
    second["embeddings_index"] = second["embeddings_index"].filter("status <> 'planned'")
    store.publish(second)
    return store.diff("embeddings_index", first.snapshot_id)


@query
def collection_recreate(spark, sf):
    """A collection that is dropped and filled anew holds the new points alone."""
    target = Collection(spark, new_work_path(spark, "points"))
    made = stage(points.to_points(_document_chunks(spark, sf), HashedEmbedder(8)), "made")
    target.ensure(8)
    target.upsert(made)
    target.recreate(8)
    target.upsert(made.filter(F.col("payload")["package"] == "src1"))
    return target.points().select("id", "qid")


@query
def text_index_lookup(spark, sf):
    """Postings written by token bucket, matched from there."""
    path = new_work_path(spark, "text")
    textindex.write_index(_postings(spark, sf), path)
    return textindex.lexical_match(spark.read.parquet(path), _benchmark(spark, sf), "and")


# Runs --------------------------------------------------------------------


@query
def run_summary(spark, sf):
    return runlog.run_summary(views.status_events(table(spark, sf, "events")))


@query
def run_progress(spark, sf):
    log = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    steps = runlog.progress(log, ["event_type"], "ts", F.count("*"))
    return steps.withColumn("step_end", F.date_format("step_end", "yyyy-MM-dd HH:mm:ss")).withColumn(
        "per_second", F.round("per_second", 9)
    )


def _stored_files(spark, sf):
    """Documents as stored files of several types, a page per line in those that need an extractor."""
    ext = F.when(F.col("lang") == "en", "txt").when(F.col("lang") == "de", "bin").otherwise("pdf")
    number = F.col("doc_id").cast("string")
    qid = F.concat(F.lit("Q"), number)
    key = F.concat(F.lit("main/"), qid, F.lit("/components/"), F.col("source"), F.lit("_1."), number, F.lit("."), ext)
    return table(spark, sf, "documents").select(
        qid.alias("qid"), key.alias("key"), F.encode("text", "UTF-8").alias("content")
    )


def _store_pages(spark, sf, root):
    """Every web page as a file of one of 97 items; how many there are."""
    item = F.concat(F.lit("Q"), F.pmod("page_id", F.lit(97)))
    key = F.concat(F.lit("main/"), item, F.lit("/components/"), F.col("page_id"), F.lit(".html"))
    return store_contents(table(spark, sf, "pages").select(key.alias("key"), F.encode("html", "UTF-8").alias("content")), root)


@query
def file_roundtrip(spark, sf):
    """Web pages written as files of an item, listed, indexed, fetched and parsed again."""
    root = new_work_path(spark, "files")
    _store_pages(spark, sf, root)
    listed = list_in_tasks(spark, root)
    files = indexed(index_files(listed, distinct=False))
    fetched = stage(fetch_contents(files, file_reader(root)), "fetched")
    good, _ = split_errors(load_pages(fetched))
    sums = fetched.select("component", content_md5(F.col("content")).alias("content_md5"))
    sizes = listed.select(F.col("key").alias("component"), "size")
    page_id = F.regexp_extract("component", "([0-9]+)[.]html$", 1).cast("bigint")
    return good.join(sums, "component").join(sizes, "component").select(
        page_id.alias("page_id"), "qid", "size", "content_md5", "title", F.md5("text").alias("text_md5")
    )


def _lines(content: bytes) -> list[str]:
    return content.decode("utf-8").split("\n")


@query
def embed_backlog_(spark, sf):
    stored = _stored_files(spark, sf)
    empty = views.status(spark, sf).limit(0)
    run = embed_backlog(
        stored.select("qid", F.col("key").alias("component")),
        stored.select("key", "content"),
        empty,
        Collection(spark, new_work_path(spark, "points")),
        HashedEmbedder(DIM),
        extractors={"pdf": _lines},
        max_pages=20,
    )
    quarantined = run.quarantine.select("qid", F.lit("quarantined").alias("status"))
    return run.status.select("qid", "status").unionByName(quarantined)


@query
def incremental_run_(spark, sf):
    root = new_work_path(spark, "run")
    stored = _stored_files(spark, sf)
    store, target = StateStore(spark, f"{root}/state"), Collection(spark, f"{root}/points")
    incremental_run(
        store,
        target,
        stored.select("qid"),
        stored.select("key"),
        stored.select("key", "content"),
        HashedEmbedder(DIM),
        extractors={"pdf": _lines},
        max_pages=None,
    )
    tables = store.read()
    per_item = target.points().groupBy("qid").agg(F.count("*").alias("n_points"))
    return (
        tables["software_index"].select("qid")
        .join(tables["component_index"].select("qid", "component"), "qid", "left")
        .join(tables["embeddings_index"].select("qid", "status"), "qid", "left")
        .join(per_item.select("qid", (F.col("n_points") > 0).alias("has_points")), "qid", "left")
    )


@query
def embed_no_text(spark, sf):
    """The extractor finds no page in a third of the files: they get neither points nor a status, and the run counts what it added."""
    bare = F.substring("qid", 2, 20).cast("bigint") % 3 == 0
    as_pdf = F.regexp_replace("key", "[.][a-z]+$", ".pdf").alias("key")
    content = F.when(bare, F.encode(F.lit(""), "UTF-8")).otherwise(F.col("content")).alias("content")
    stored = stage(_stored_files(spark, sf).select("qid", as_pdf, content), "stored")
    options = {"extractors": {"pdf": lambda content: _lines(content) if content else []}, "max_pages": None}
    target = Collection(spark, new_work_path(spark, "points"))
    todo = stored.select("qid", F.col("key").alias("component"))
    run = embed_backlog(todo, stored.select("key", "content"), views.status(spark, sf).limit(0), target, HashedEmbedder(DIM), **options)
    held = target.points().groupBy("qid").agg(F.count("*").alias("n"))
    all_added = F.lit(run.points_added == target.size() > 0).alias("all_added")
    joined = todo.join(run.status.select("qid", "status"), "qid", "left").join(held, "qid", "left")
    return joined.select("qid", "status", F.col("n").isNotNull().alias("has_points"), all_added)


@query
def run_from_package(spark, sf):
    """Three packages are planned, one of them is run: its files are done, the others stay reserved."""
    root = new_work_path(spark, "run")
    stored = _stored_files(spark, sf)
    store, target = StateStore(spark, f"{root}/state"), Collection(spark, f"{root}/points")
    tables, never = store.read(), F.lit(None).cast("timestamp").alias("updated_at")
    tables["software_index"] = stored.select("qid", never)
    tables["component_index"] = stored.select("qid", F.col("key").alias("component"), never)
    store.publish(tables)
    plan_packages(store, f"{root}/plans", size=50, packages=3)
    run_package(
        spark, store, target, f"{root}/plans", "plan_localworker_02", stored.select("key", "content"), HashedEmbedder(DIM),
        extractors={"pdf": _lines}, max_pages=None,
    )
    embedded = target.points().select("qid", F.lit(True).alias("has_points")).distinct()
    return store.read()["embeddings_index"].select(*DOC_KEYS, "status").join(embedded, "qid", "left")


# Streams -----------------------------------------------------------------


def _stream(spark, sf, name):
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


@query
def stream_file_index(spark, sf):
    root = new_work_path(spark, "stream")
    log = jobs.file_log(spark, f"{root}/log")
    jobs.index_stream(views.objects_of(_stream(spark, sf, "orders")), log, f"{root}/checkpoint").awaitTermination()
    return log.current().select(*DOC_KEYS)


@query
def stream_rate_limit(spark, sf):
    """Stored files come in as a stream, some hundred in a batch, and all of them come."""
    root = new_work_path(spark, "stream")
    n = _store_pages(spark, sf, f"{root}/files")
    log = jobs.file_log(spark, f"{root}/log")
    files = jobs.stream_files(spark, f"{root}/files", max_files=-(-n // 4))
    jobs.index_stream(files, log, f"{root}/checkpoint").awaitTermination()
    per_batch = log.rows().groupBy("batch").agg(F.count("*").alias("n"))
    seen = per_batch.agg(F.count("*").alias("n_batches"), F.max("n").alias("largest")).first()
    return log.current().select(*DOC_KEYS, F.lit(seen.n_batches).cast("bigint").alias("n_batches"), F.lit(seen.largest).cast("bigint").alias("largest"))


@query
def stream_status_latest(spark, sf):
    root = new_work_path(spark, "stream")
    log = jobs.status_log(spark, f"{root}/log")
    jobs.status_stream(views.status_events(_stream(spark, sf, "events")), log, f"{root}/checkpoint").awaitTermination()
    newest = log.current()
    return newest.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query
def stream_embed(spark, sf):
    root = new_work_path(spark, "stream")
    store, target = StateStore(spark, f"{root}/state"), Collection(spark, f"{root}/points")
    number = F.col("doc_id").cast("string")
    key = F.concat(F.lit("main/Q"), number, F.lit("/components/"), F.col("source"), F.lit("_1."), number, F.lit(".txt"))
    files = _stream(spark, sf, "documents").select(key.alias("key"), F.encode("text", "UTF-8").alias("content"))
    jobs.embed_stream(
        files, store, target, HashedEmbedder(DIM), f"{root}/checkpoint", known_only=False
    ).awaitTermination()
    return store.read()["embeddings_index"].select("qid", "component", "status")


@query
def stream_embed_two_batches(spark, sf):
    """Items that become known after their files came: the files wait, and the next batch embeds them."""
    root = new_work_path(spark, "stream")
    store, target = StateStore(spark, f"{root}/state"), Collection(spark, f"{root}/points")
    as_text = F.regexp_replace("key", "[.][a-z]+$", ".txt").alias("key")
    stored = stage(_stored_files(spark, sf).select("qid", as_text, "content"), "stored")
    number = F.substring("qid", 2, 20).cast("bigint")
    never = F.lit(None).cast("timestamp").alias("updated_at")
    for came, known in ((number % 2 == 0, number % 3 == 0), (number % 2 == 1, F.lit(True))):
        stored.filter(came).select("key", "content").write.mode("append").parquet(f"{root}/files")
        tables = store.read()
        tables["software_index"] = stored.filter(known).select("qid", never)
        store.publish(tables)
        files = spark.readStream.schema("key string, content binary").parquet(f"{root}/files")
        jobs.embed_stream(files, store, target, HashedEmbedder(DIM), f"{root}/checkpoint").awaitTermination()
    embedded = target.points().select("qid", F.lit(True).alias("has_points")).distinct()
    return store.read()["embeddings_index"].select(*DOC_KEYS, "status").join(embedded, "qid", "left")
