"""Table schemas and default parameters."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# File extensions that are indexed.
ALLOWED_EXTENSIONS = ("pdf", "html", "txt")

# Document types and the status domain.
CRAN_PACKAGE = "CRAN_PACKAGE"
PUBLICATION = "PUBLICATION"
OTHER = "OTHER"
STATUS_OK = "ok"
STATUS_PLANNED = "planned"
STATUS_TIMEOUT = "failed - TimeoutError"
STATUS_TOO_LARGE = "failed - PDF too large (%d pages)"
UNKNOWN = "unknown"

DOC_KEYS = ("qid", "component")


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


_S, _TS = T.StringType(), T.TimestampType()

ITEMS = _struct(("qid", _S, False), ("updated_at", _TS, True))
FILES = _struct(("qid", _S, False), ("component", _S, False), ("updated_at", _TS, True))
STATUS = _struct(
    ("qid", _S, False), ("component", _S, False), ("updated_at", _TS, True), ("status", _S, True)
)
OBJECTS = _struct(("key", _S, False))
TRIPLES = _struct(("s", _S, False), ("p", _S, False), ("o", _S, False))
PAGES = _struct(
    ("qid", _S, False),
    ("component", _S, False),
    ("page", T.IntegerType(), False),
    ("title", _S, True),
    ("text", _S, True),
)
POINTS = _struct(
    ("id", _S, False),
    ("qid", _S, True),
    ("component", _S, True),
    ("vector", T.ArrayType(T.FloatType()), True),
    ("page_content", _S, True),
    ("payload", T.MapType(_S, _S), True),
)
PLAN_ENTRY = _struct(("qid", _S, True), ("component", _S, True), ("document_type", _S, True))
PLAN = _struct(
    ("planner_version", _S, True),
    ("created_at", _S, True),
    ("state_db_checksum", _S, True),
    ("package_id", _S, True),
    ("entries", T.ArrayType(PLAN_ENTRY), True),
)
BINDINGS = T.StructType(
    [
        T.StructField(
            "results",
            T.StructType(
                [
                    T.StructField(
                        "bindings",
                        T.ArrayType(_struct(("qid", _struct(("value", _S, True)), True))),
                    )
                ]
            ),
        )
    ]
)

# The three state tables and their keys, in the order counts are reported.
STATE_TABLES = {
    "software_index": (ITEMS, ("qid",)),
    "component_index": (FILES, DOC_KEYS),
    "embeddings_index": (STATUS, DOC_KEYS),
}


@dataclass(frozen=True)
class ChunkParams:
    """Chunking parameters; lengths are in characters, ``buffer_size`` in sentences."""

    # Chunker defaults.
    min_chunk_size: int = 900
    target_max_chunk_size: int = 1600
    buffer_size: int = 200
    breakpoint_percentile: float = 80.0
    max_overlap: int = 100

    def __post_init__(self) -> None:
        if self.target_max_chunk_size <= self.overlap:
            raise ValueError("target_max_chunk_size must exceed the overlap")
        if self.buffer_size < 0:
            raise ValueError("buffer_size must not be negative")

    @property
    def overlap(self) -> int:
        return min(self.max_overlap, self.min_chunk_size // 4)

    def overlap_for(self, min_length: int | None) -> int:
        """The overlap if ``min_length`` is expected of a chunk; 0 or none means the default."""
        return min(self.max_overlap, min_length // 4) if min_length else self.overlap

    def override(self, **changes: object) -> "ChunkParams":
        return replace(self, **changes)
