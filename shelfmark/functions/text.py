"""Text functions: whitespace, tokens, sentences, markup removal, embedding prefixes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.schemas import CRAN_PACKAGE, PUBLICATION

# Unicode whitespace, spelled out because \s is ASCII-only in the regex engine.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
SENTENCE_GAP = r"(?<=[.?!])" + SPACE + "+"
NON_WORD = r"[^\p{L}\p{N}]+"


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of every kind (``trim`` only knows spaces)."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+\\z", "")


def word_text(text: Column) -> Column:
    """Lower-cased words separated by single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), NON_WORD, " "))


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NON_WORD, -1), lambda w: w != "")


def sentences(text: Column) -> Column:
    """Split after ``.``, ``?`` or ``!`` followed by whitespace; the whitespace is dropped."""
    return F.split(text, SENTENCE_GAP, -1)


def strip_html(html: Column) -> Column:
    """Visible text of an HTML document on one line."""
    hidden = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<title\b.*?</title\s*>"
    text = F.regexp_replace(F.regexp_replace(html, hidden, " "), r"<[^>]*>", " ")
    return strip(F.regexp_replace(_unescape(text), SPACE + "+", " "))


def html_title(html: Column) -> Column:
    found = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title\s*>", 1)
    return F.nullif(strip(_unescape(found)), F.lit(""))


def _unescape(text: Column) -> Column:
    # The predefined entities; the ampersand goes last so nothing is decoded twice.
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def prefix_rules(graph: str | None = None) -> dict[str, tuple[str, str]]:
    """Lead text per document type: ``{document_type: (field, lead)}``.

    ``graph`` is the name of the knowledge graph that items come from; it is
    part of both the type name and the lead text of graph items.
    """
    graph_type = f"{graph.upper()}_KG_ITEM" if graph else "KG_ITEM"
    graph_lead = f"{graph} item " if graph else "Item "
    # Lead texts.
    return {
        CRAN_PACKAGE: ("package", "Package "),
        graph_type: ("qid", graph_lead),
        PUBLICATION: ("title", "Publication "),
    }


def embedding_prefix(
    document_type: Column,
    fields: Mapping[str, Column],
    rules: Mapping[str, tuple[str, str]] | None = None,
) -> Column:
    """Short provenance text put before a chunk when it is embedded, else empty."""
    result = F.lit("")
    for doc_type, (field, lead) in (prefix_rules() if rules is None else rules).items():
        value = F.coalesce(fields[field].cast("string"), F.lit(""))
        result = F.when(
            (document_type == doc_type) & (value != ""), F.concat(F.lit(lead), value, F.lit(". "))
        ).otherwise(result)
    return result
