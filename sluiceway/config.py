"""Validated settings of a feed."""

from __future__ import annotations

from dataclasses import dataclass, field

RECORDS, DOCUMENT = "records", "document"
FILE_FORMATS = ("parquet", "csv", "json", "avro")


def split_names(text: str) -> tuple[str, ...]:
    """Names out of a comma-separated setting."""
    return tuple(part.strip() for part in text.split(",") if part.strip())


@dataclass(frozen=True)
class ResponseFeed:
    """API responses of one domain."""

    landing: str
    base: str
    silver_shape: str = RECORDS
    buckets: int | None = None

    def __post_init__(self):
        if self.silver_shape not in (RECORDS, DOCUMENT):
            raise ValueError(f"silver_shape is {RECORDS} or {DOCUMENT}, not {self.silver_shape!r}")

    @property
    def keys(self) -> list[str]:
        return ["endpoint", "run_id"] if self.silver_shape == DOCUMENT else ["endpoint", "record_id"]


@dataclass(frozen=True)
class FileFeed:
    """Files that a connector drops into a folder."""

    source: str
    base: str
    file_format: str = "parquet"
    dedup_keys: tuple[str, ...] = ()
    dedup_order_by: str = "source_file_modified_at"
    max_files: int = 1000
    buckets: int | None = None
    options: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.file_format not in FILE_FORMATS:
            raise ValueError(f"file_format is one of {', '.join(FILE_FORMATS)}, not {self.file_format!r}")
        if isinstance(self.dedup_keys, str):
            object.__setattr__(self, "dedup_keys", split_names(self.dedup_keys))
