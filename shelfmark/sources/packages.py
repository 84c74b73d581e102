"""Work-package files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.arrays import unnest
from shelfmark.schemas import PLAN
from shelfmark.session import path_exists


def package_paths(root: str, name: str) -> list[str]:
    """Where a package may be: a single file, or the folder that ``write_packages`` makes.

    The suffix ``.json`` may be left out of the name.
    """
    plain = name.removesuffix(".json")
    folder = "/".join(p for p in (root.rstrip("/"), "planned") if p)
    return [f"{folder}/{plain}.json", f"{folder}/package_id={plain}"]


def read_package(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The text of one package as ``body``, or None when there is no such package."""
    for path in package_paths(root, name):
        if path_exists(spark, path):
            return spark.read.text(path, wholetext=True).withColumnRenamed("value", "body")
    return None


def package_entries(bodies: DataFrame, column: str = "body") -> DataFrame:
    """All entries of package bodies, valid or not: ``qid, component, document_type, is_valid``.

    A body that is not JSON has no entries.
    """
    parsed = bodies.select(F.from_json(F.col(column), PLAN, {"mode": "PERMISSIVE"}).alias("plan"))
    return unnest(parsed, F.col("plan.entries"), "e").select(
        "e.qid",
        "e.component",
        "e.document_type",
        is_complete(F.col("e.qid"), F.col("e.component")).alias("is_valid"),
    )


def is_complete(qid: Column, component: Column) -> Column:
    return (F.coalesce(qid, F.lit("")) != "") & (F.coalesce(component, F.lit("")) != "")


def read_entries(bodies: DataFrame, column: str = "body") -> tuple[DataFrame, DataFrame]:
    """Usable ``(qid, component)`` rows, and the entries dropped for missing a field."""
    entries = package_entries(bodies, column)
    good = entries.filter("is_valid").select("qid", "component")
    dropped = entries.filter("not is_valid").drop("is_valid")
    return good, dropped
