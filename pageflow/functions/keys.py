"""Record id and content hash of a page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_id(doc_id: str = "doc_id", page_number: str = "page_number") -> Column:
    """``doc_id::page_number``. Nulls are filled in, so pages of unnamed documents keep the separator."""
    return F.concat_ws(
        "::",
        F.coalesce(F.col(doc_id), F.lit("")),
        F.coalesce(F.col(page_number).cast("string"), F.lit("-1")),
    )


def content_hash(payload: str = "page_payload", image: str = "page_image") -> Column:
    """SHA-256 over the two payload hashes; a null payload hashes like an empty one."""
    part = lambda c: F.sha2(F.coalesce(F.col(c), F.lit("")), 256)
    return F.sha2(F.concat_ws("||", part(payload), part(image)), 256)


def bucket_of(key: str, buckets: int) -> Column:
    """The share of a table that a key is in; null for a null key."""
    return F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
