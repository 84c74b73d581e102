"""Chunks -> points: metadata, ids, payload, embedding input."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import keys
from shelfmark.functions.text import embedding_prefix
from shelfmark.operators.embedding import Embedder, embed_column, embed_column_safely
from shelfmark.operators.joins import narrow_join
from shelfmark.schemas import CRAN_PACKAGE

# Payload fields that describe a chunk, as stored points have them. They win over fields of the same name from the file.
BASE_FIELDS = ("qid", "source", "package", "version", "document_type", "page", "chunk_index", "start_index")


# Fixed value: the source that points name by default.
SOURCE = "CRAN"


def add_metadata(pages: DataFrame, document_type: str | Column = CRAN_PACKAGE, source: str = SOURCE) -> DataFrame:
    """Pages with the document's ``source, package, version, document_type``.

    The title is the one of the document's first page; ``load_pages`` puts the
    same title on every page of a file.
    """
    package, version = keys.package_version(F.col("component"), F.col("title"))
    kind = F.lit(document_type) if isinstance(document_type, str) else document_type
    return pages.withColumns(
        {"source": F.lit(source), "package": package, "version": version, "document_type": kind}
    )


def merge_metadata(extra: Column, base: Column) -> Column:
    """Union of two maps; fields of ``base`` win."""
    extra = F.coalesce(extra, F.create_map().cast("map<string,string>"))
    return F.map_concat(F.map_filter(extra, lambda k, _: ~F.array_contains(F.map_keys(base), k)), base)


def payload(fields: Mapping[str, Column], page_content: Column | None, extra: Column | None = None) -> Column:
    """Metadata plus ``page_content``, if given, as one map; null fields are left out."""
    pairs = [F.struct(F.lit(k).alias("k"), v.cast("string").alias("v")) for k, v in fields.items()]
    if page_content is not None:
        pairs.append(F.struct(F.lit("page_content").alias("k"), page_content.alias("v")))
    base = F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["v"].isNotNull()))
    return base if extra is None else merge_metadata(extra, base)


def split_payload(stored: Column) -> tuple[Column, Column]:
    """``page_content`` (empty when absent) and the remaining metadata."""
    content = F.coalesce(F.try_element_at(stored, F.lit("page_content")), F.lit(""))
    return content, F.map_filter(stored, lambda k, _: k != "page_content")


def with_content(stored: Column, page_content: Column) -> Column:
    """A payload with ``page_content`` put back."""
    bare = F.map_filter(F.coalesce(stored, F.create_map().cast("map<string,string>")), lambda k, _: k != "page_content")
    pair = F.create_map(F.lit("page_content"), page_content)
    return F.when(page_content.isNull(), bare).otherwise(F.map_concat(bare, pair))


def identify(chunks: DataFrame, id_cols: Sequence[str] = ("qid",)) -> DataFrame:
    """Chunks with their point ``id``.

    ``id_cols`` make up the id prefix. With the item alone, two files of one
    item claim the same ids and the later file wins; ``("qid", "component")``
    keeps them apart.
    """
    prefix = F.concat_ws("/", *id_cols) if len(id_cols) > 1 else F.col(id_cols[0])
    identified = chunks.withColumn("id", keys.point_id(F.col("chunk_index"), prefix))
    if "component" in id_cols:
        return identified
    # Only items with several files have rivals for an id; which file wins is settled on keys alone.
    narrow = identified.select("id", "qid", "component")
    several = narrow.groupBy("qid").agg(F.min("component").alias("_a"), F.max("component").alias("_b")).filter("_a <> _b")
    rivals = narrow_join(narrow, several.select("qid"), ["qid"], ["id"], "left_semi")
    best = rivals.groupBy("id").agg(F.max("component").alias("_best"))
    losers = rivals.join(best, "id").filter(F.col("component") < F.col("_best")).select("id", "component").distinct()
    return narrow_join(identified, losers, ["id", "component"], ["id"], "left_anti")


def embedding_text(
    chunks: DataFrame, rules: Mapping[str, tuple[str, str]] | None = None
) -> Column:
    """Provenance prefix plus chunk text; the stored text stays without the prefix."""
    fields = {name: F.col(name) if name in chunks.columns else F.lit(None).cast("string") for name in ("package", "qid", "title")}
    if rules is not None:
        fields.update({f: F.col(f) for f, _ in rules.values() if f in chunks.columns})
    return F.concat(embedding_prefix(F.col("document_type"), fields, rules), F.col("text"))


def to_points(
    chunks: DataFrame,
    embedder: Embedder,
    id_cols: Sequence[str] = ("qid",),
    rules: Mapping[str, tuple[str, str]] | None = None,
    isolate: bool = False,
    content_in_payload: bool = True,
    known=None,
) -> DataFrame:
    """``id, qid, component, vector, page_content, payload`` for every chunk.

    Without ``content_in_payload`` the text is there once; a collection puts it
    into the payload of the points that it gives out.

    Ids are settled before embedding, so no text is embedded only to be
    overwritten. ``known`` is a store of vectors by text, see ``plans.textvectors``:
    its model is asked about texts that it does not hold only. With ``isolate`` there is also ``error``, set where the model
    failed on a text; otherwise that fails the job.
    """
    settled = identify(chunks, id_cols)
    fields = {name: F.col(name) for name in BASE_FIELDS if name in settled.columns}
    if "title" in settled.columns:
        fields["title"] = F.col("title")
    extra = F.col("extra") if "extra" in settled.columns else None
    text = embedding_text(settled, rules)
    if known is None:
        embedded = settled.withColumn("_e", (embed_column_safely if isolate else embed_column)(text, embedder))
    else:
        embedded = known.embed(settled, text, "_e")
        if not isolate:
            failed = F.raise_error(F.col("_e.error")).cast("array<float>")
            embedded = embedded.withColumn("_e", F.when(F.col("_e.error").isNull(), F.col("_e.vector")).otherwise(failed))
    return embedded.select(
        "id",
        "qid",
        "component",
        F.col("_e.vector" if isolate else "_e").alias("vector"),
        F.col("text").alias("page_content"),
        payload(fields, F.col("text") if content_in_payload else None, extra).alias("payload"),
        *([F.col("_e.error").alias("error")] if isolate else []),
    )
