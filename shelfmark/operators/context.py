"""Retrieved texts -> context -> prompt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTEXT_TEXTS = 3
SEPARATOR = "\n\n"

DEFAULT_TEMPLATE = (
    "Answer the question from the context alone. "
    "If the context does not hold the answer, say that you do not know.\n\n"
    "Context:\n{context}\n\nQuestion: {question}\nAnswer:"
)


def contexts(
    ranked: DataFrame, n: int = CONTEXT_TEXTS, query_col: str = "query_id", text: str = "page_content"
) -> DataFrame:
    """The best ``n`` texts of each query joined with blank lines: ``query, context``."""
    best = ranked.filter(F.col("rank") <= n)
    listed = best.groupBy(query_col).agg(
        F.sort_array(F.collect_list(F.struct("rank", F.col(text).alias("t")))).alias("_texts")
    )
    joined = F.array_join(F.transform("_texts", lambda x: x["t"]), SEPARATOR)
    return listed.select(query_col, joined.alias("context"))


def prompts(questions: DataFrame, context: DataFrame, template: str = DEFAULT_TEMPLATE, query_col: str = "query_id") -> DataFrame:
    """``query, prompt`` from ``(query, question)`` and the contexts; a query without hits has an empty context."""
    joined = questions.join(context, query_col, "left")
    # The template is cut at its fields, so text that looks like a field is left alone.
    parts, rest = [], template
    while rest:
        at = {f: rest.find("{%s}" % f) for f in ("question", "context")}
        found = [(i, f) for f, i in at.items() if i >= 0]
        if not found:
            parts.append(F.lit(rest))
            break
        i, field = min(found)
        parts += [F.lit(rest[:i]), F.coalesce(F.col(field), F.lit(""))]
        rest = rest[i + len(field) + 2 :]
    return joined.select(query_col, F.concat(*parts).alias("prompt"))
