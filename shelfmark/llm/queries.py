"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import exact_dedup, language, lloyd, mixing, packing, quality, resampling, secrets, simhash, stable_ann, suffixes, toxicity, warc
from shelfmark.session import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: tuple[Query, ...] = (
    quality.op1_quality,
    exact_dedup.op2_exact_dedup,
    toxicity.op3_toxicity,
    stable_ann.op4_nearest,
    packing.op5_packing,
    suffixes.op6_suffix_dedup,
    mixing.op7_mixing,
    warc.op8_warc,
    simhash.op9_simhash,
    secrets.op10_secret_scan,
    lloyd.op11_vector_codes,
    resampling.op12_resampling,
    language.op13_language,
)
SQL = {"op2_exact_dedup": exact_dedup.SQL, "op8_warc": warc.SQL, "op11_vector_codes": lloyd.SQL, "op12_resampling": resampling.SQL}


def registered() -> dict[str, Query]:
    def shipped(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir.rstrip("/"))

        return run

    return {fn.__name__: shipped(fn) for fn in QUERIES}


def sql() -> dict[str, str]:
    return dict(SQL)
