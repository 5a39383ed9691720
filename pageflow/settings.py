"""Fixed values of the page-conversion pipeline and the tunables of a run."""

from __future__ import annotations

from dataclasses import dataclass

# Texts written into status columns, error columns and stage stamps.
ERROR_PREFIX = "ERROR:"
COMPLETED = "markdown conversion completed"
FAILED = "markdown conversion failed"
INVALID_PAYLOAD = "ERROR: Invalid or missing encoding"
BLANK_PAYLOAD = "ERROR: Empty or null encoding provided"
OVERSIZE_PAYLOAD = "ERROR: Encoding exceeds size limit"
MISSING_PAGE = "ERROR: Page not found in the page table"

# Error categories that are never retried.
PERMANENT_CATEGORIES = ("PERMANENT_INVALID_ENCODING", "PERMANENT_SIZE_LIMIT")

# Labels of the two conversion modes (document page, page image).
PAGE_MODE = "Page"
IMAGE_MODE = "Image"


@dataclass(frozen=True)
class Settings:
    """Rules of one run.

    ``min_length`` is a declared validity rule. ``max_length`` is a limit of some services; it is off unless
    set where the converter is opened. The last ones, from ``lookup_buckets`` on, only steer the physical plan; results do
    not depend on them. A task of a conversion makes about ``task_calls`` calls at most, for pages of about ``task_bytes``.
    Every ``snapshot_every`` runs the keys that planning reads are folded into one table.
    """

    min_length: int = 200
    max_length: int | None = None
    max_attempts: int = 3
    breaker_min_rows: int = 100
    breaker_min_failures: int = 100
    breaker_rate: float = 0.9
    lookup_buckets: int = 16
    chunk_rows: int = 100_000
    chunk_files: int = 2_000
    chunks_at_once: int = 4
    task_calls: int = 2_000
    task_bytes: int = 64 << 20
    snapshot_every: int = 100


DEFAULTS = Settings()
