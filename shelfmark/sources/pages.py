"""File contents -> pages, one row per page.

Every file is read once, whatever mix of types comes in: text and HTML are
handled by Spark expressions, other types by user-supplied extractors, all in
one projection over the contents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import keys
from shelfmark.functions.text import html_title, strip_html
from shelfmark.operators.arrays import unnest
from shelfmark.sources.objects import read_folder

# bytes -> page texts, or (page texts, title), or (page texts, title, metadata): a dict for the file, or one for each page
Extractor = Callable[[bytes], "list[str] | tuple"]

_PARSED = "struct<texts: array<string>, title: string, error: string, extra: array<map<string,string>>>"


def _parsed(texts: Column, title: Column, error: Column) -> Column:
    none = F.lit(None).cast("array<map<string,string>>")
    return F.struct(texts.alias("texts"), title.alias("title"), error.alias("error"), none.alias("extra")).cast(_PARSED)


def _null() -> Column:
    return F.lit(None).cast("string")


def parse_text(content: Column) -> Column:
    """UTF-8 text; a form feed separates pages."""
    texts = F.split(F.decode(content, "UTF-8"), "\f", -1)
    return _parsed(texts, _null(), _null())


def parse_html(content: Column) -> Column:
    """HTML; one page with the visible text."""
    html = F.decode(content, "UTF-8")
    return _parsed(F.array(strip_html(html)), html_title(html), _null())


def _by_page(extra: Mapping | list[Mapping] | None, pages: int) -> list[dict[str, str]] | None:
    """Metadata as text, a map for each page; fields without a value are left out."""
    if not extra:
        return None
    each = [extra] * pages if isinstance(extra, Mapping) else list(extra)
    if len(each) != pages:
        raise ValueError(f"metadata for {len(each)} pages, but {pages} pages")
    return [{str(k): str(v) for k, v in (m or {}).items() if v is not None} for m in each]


def _extract(extractors: Mapping[str, Extractor]):
    by_extension = dict(extractors)

    def parse(ext: str, content: bytes | None) -> tuple:
        if content is None:
            return None, None, None, None
        try:
            found = by_extension[ext](bytes(content))
            texts, title, extra = (*found, None, None)[:3] if isinstance(found, tuple) else (found, None, None)
            texts = list(texts)
            return texts, title, None, _by_page(extra, len(texts))
        except Exception as exc:  # one bad file must not stop the batch
            return None, None, f"{type(exc).__name__}: {exc}", None

    @F.pandas_udf(_PARSED)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for exts, contents in batches:
            rows = [parse(e, c) for e, c in zip(exts, contents)]
            yield pd.DataFrame(rows, columns=["texts", "title", "error", "extra"])

    return run


def load_pages(files: DataFrame, extractors: Mapping[str, Extractor] | None = None) -> DataFrame:
    """Pages of ``(qid, component, content)`` files: ``qid, component, page, title, text, error, extra``.

    ``extra`` holds what an extractor found besides: author, dates, producer and the like.

    A file that cannot be read gives one row with ``error`` set and no text;
    it never stops the other files. An ``error`` column of the input, from
    fetching, is passed on.
    """
    extractors = dict(extractors or {})
    ext, content = F.col("ext"), F.col("content")
    unreadable = _parsed(F.lit(None).cast("array<string>"), _null(), F.concat(F.lit("no extractor for type: "), ext))
    parsed = unreadable
    if "html" not in extractors:
        parsed = F.when(ext == "html", parse_html(content)).otherwise(parsed)
    if "txt" not in extractors:
        parsed = F.when(ext == "txt", parse_text(content)).otherwise(parsed)
    fetched = F.col("error") if "error" in files.columns else _null()
    typed = files.select(
        "qid", "component", keys.extension(F.col("component")).alias("ext"), "content", fetched.alias("fetch_error")
    )
    if extractors:
        chosen = ext.isin(*extractors) & content.isNotNull()
        typed = typed.withColumn("found", _extract(extractors)(ext, F.when(chosen, content)))
        parsed = F.when(chosen, F.col("found")).otherwise(parsed)
    failed = F.col("fetch_error").isNotNull()
    parsed = F.when(failed, _parsed(F.lit(None).cast("array<string>"), _null(), F.col("fetch_error"))).otherwise(parsed)
    rows = typed.select("qid", "component", parsed.alias("doc"))
    # A file without pages and without an error has nothing to show and gives no row.
    listed = F.coalesce("doc.texts", F.array(_null()))
    return unnest(rows, listed, "text", "page").select(
        "qid", "component", "page", F.col("doc.title").alias("title"), "text", F.col("doc.error").alias("error"),
        F.try_element_at(F.col("doc.extra"), F.col("page") + 1).alias("extra"),
    )


def load_folder(
    spark: SparkSession, folder: str, suffix: str = ".pdf", extractors: Mapping[str, Extractor] | None = None
) -> DataFrame:
    """Pages of the files directly in ``folder`` whose name ends with ``suffix``; they belong to no item."""
    files = read_folder(spark, folder, suffix)
    named = files.select(_null().alias("qid"), F.col("key").alias("component"), "content")
    return load_pages(named, extractors)


def split_errors(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable pages, and the quarantined files with their errors."""
    good = pages.filter(F.col("error").isNull()).drop("error")
    bad = pages.filter(F.col("error").isNotNull()).select("qid", "component", "error")
    return good, bad
