"""Functions on object keys, identifiers and labels."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import strip
from shelfmark.schemas import ALLOWED_EXTENSIONS, UNKNOWN

# Fixed value: the DNS name space of RFC 4122.
DNS_NAMESPACE_HEX = "6ba7b8109dad11d180b400c04fd430c8"

# The forms of worker and package names in plans.
WORKER_FORM, PACKAGE_PREFIX = "localworker_%02d", "plan_"


def has_extension(key: Column, extensions: Iterable[str] = ALLOWED_EXTENSIONS) -> Column:
    """True when the key ends with one of the extensions, whatever the case."""
    dotted = [re.escape(e if e.startswith(".") else f".{e}") for e in extensions]
    return key.rlike(f"(?i)(?:{'|'.join(dotted)})\\z")


def extension(key: Column) -> Column:
    """Lower-cased extension without the dot, empty when there is none."""
    return F.lower(F.regexp_extract(file_name(key), r"[^.].*\.([^.]*)\z", 1))


def item_id(key: Column) -> Column:
    """Last path segment that is ``Q`` plus digits, or null."""
    # The greedy lead takes as many segments as it can, so the last fitting one is left.
    return F.nullif(F.regexp_extract(key, r"(?s)^(?:.*/)?(Q[0-9]+)(?:/.*)?\z", 1), F.lit(""))


def file_name(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def file_stem(key: Column) -> Column:
    """File name without its last extension; leading dots do not start an extension."""
    return F.regexp_replace(file_name(key), r"(?s)^(.*[^.].*)\.[^.]*\z", "$1")


def shard_path(qid: Column) -> Column:
    """``NN/NN/NN/Q…`` from the first six digits of the zero-padded number."""
    name = F.upper(strip(qid))
    digits = F.substr(name, F.lit(2))
    padded = F.when(F.length(digits) < 6, F.lpad(digits, 6, "0")).otherwise(digits)
    parts = [F.substring(padded, at, 2) for at in (1, 3, 5)]
    return F.concat_ws("/", *parts, name)


def package_version(component: Column, title: Column) -> tuple[Column, Column]:
    """Package and version from ``{package}_{version}.ext``, else from ``package: title``."""
    pattern = r"(?s)^(.+)_([0-9][^_]*)\z"
    stem = file_stem(component)
    package = F.regexp_extract(stem, pattern, 1)
    version = F.regexp_extract(stem, pattern, 2)
    from_title = F.when(F.instr(title, ":") > 0, F.nullif(strip(F.substring_index(title, ":", 1)), F.lit("")))
    named = package != ""
    return (
        F.when(named, package).otherwise(F.coalesce(from_title, F.lit(UNKNOWN))),
        F.when(named, version).otherwise(F.lit(UNKNOWN)),
    )


def uuid5(name: Column, namespace_hex: str = DNS_NAMESPACE_HEX) -> Column:
    """Name-based UUID, version 5."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def point_id(index: Column, prefix: Column | None = None) -> Column:
    """Deterministic point id: UUID of ``prefix-index``, or the index itself without a prefix."""
    number = index.cast("string")
    if prefix is None:
        return number
    named = uuid5(F.concat(prefix, F.lit("-"), number))
    return F.when(F.coalesce(prefix, F.lit("")) != "", named).otherwise(number)


def plan_file_name(name: Column) -> Column:
    return F.when(name.endswith(".json"), name).otherwise(F.concat(name, F.lit(".json")))


def join_path(*parts: Column) -> Column:
    """Join path parts with ``/``, leaving out the empty ones."""
    return F.array_join(F.filter(F.array(*parts), lambda p: F.coalesce(p, F.lit("")) != ""), "/")


def worker_id(package: Column) -> Column:
    """``localworker_01`` for package 0, and so on."""
    return F.format_string(WORKER_FORM, package + 1)


def package_id(package: Column) -> Column:
    return F.concat(F.lit(PACKAGE_PREFIX), worker_id(package))


def duration(seconds: Column) -> Column:
    """``1h 2m`` / ``3m 20s`` / ``45s``; ``unknown`` for null, non-positive or infinite input."""
    value = seconds.cast("double")
    usable = value.isNotNull() & ~F.isnan(value) & (value > 0) & (value < F.lit(float("inf")))
    whole = F.when(usable, F.floor(value))
    minutes = F.floor(whole / 60).cast("bigint")
    hours = F.floor(whole / 3600).cast("bigint")
    return (
        F.when(~usable, UNKNOWN)
        .when(hours > 0, F.format_string("%dh %dm", hours, minutes % 60))
        .when(minutes > 0, F.format_string("%dm %ds", minutes, whole % 60))
        .otherwise(F.format_string("%ds", whole))
    )


def signed_count(name: Column, n: Column, delta: Column) -> Column:
    """``name:n (+d)``; without a delta just ``name:n``."""
    plain = F.format_string("%s:%d", name, n)
    return F.when(delta.isNull(), plain).otherwise(F.format_string("%s:%d (%+d)", name, n, delta))


def iso_timestamp(ts: Column) -> Column:
    """ISO-8601 text in UTC."""
    return F.date_format(_utc(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def compact_timestamp(ts: Column) -> Column:
    """``yyyyMMddTHHmmssZ`` in UTC."""
    return F.date_format(_utc(ts), "yyyyMMdd'T'HHmmss'Z'")


def _utc(ts: Column) -> Column:
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def parse_timestamp(text: Column) -> Column:
    """ISO text with ``Z`` or a numeric offset; null when it cannot be read."""
    return F.try_to_timestamp(text)
