"""From pages to work: keys, flags, payload choice and the checks made before a conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow import schemas
from pageflow.functions.keys import content_hash, record_id
from pageflow.functions.text import is_blank
from pageflow.operators.joins import PLAIN_ROWS, lookup, probe_in_place
from pageflow.settings import BLANK_PAYLOAD, DEFAULTS, INVALID_PAYLOAD, OVERSIZE_PAYLOAD, Settings


def page_keys(pages: DataFrame) -> DataFrame:
    """The slim side of the page table: keys, hashes and what the payload checks need.

    The only pass over both payloads; no payload leaves the scan's tasks.
    """
    return pages.select(
        "page_key",
        "doc_id",
        "page_number",
        record_id().alias("record_id"),
        content_hash().alias("content_hash"),
        F.length("page_payload").alias("page_length"),
        F.length("page_image").alias("image_length"),
        is_blank(F.col("page_payload")).alias("page_blank"),
        is_blank(F.col("page_image")).alias("image_blank"),
        *[f.name for f in schemas.ROW_REF],
    )


def set_flags(flags: DataFrame) -> DataFrame:
    """Documents whose flag is set, each once: false and missing are the same, so only these are looked up."""
    return flags.where("use_image").select("doc_id").distinct().withColumn("use_image", F.lit(True))


def attach_flags(
    rows: DataFrame, flags: DataFrame, spread_by: list[str], settings: Settings = DEFAULTS, heavy: Sequence[int] = ()
) -> DataFrame:
    """Add ``use_image`` by document to slim rows; documents without a flag count as false.

    A document may own any share of the rows: ``heavy`` names such documents, whose rows are spread.
    """
    joined = lookup(rows, set_flags(flags), ["doc_id"], spread_by, buckets=settings.lookup_buckets, heavy=heavy)
    return joined.withColumn("use_image", F.coalesce("use_image", F.lit(False)))


def attach_flags_in_place(pages: DataFrame, flags: DataFrame) -> DataFrame:
    """``attach_flags`` for rows that carry payloads: set flags are counted, and broadcast in parts if they are many."""
    per_doc = set_flags(flags)
    joined = probe_in_place(pages, per_doc, ["doc_id"], "left", 1 + per_doc.count() // (10 * PLAIN_ROWS))
    return joined.withColumn("use_image", F.coalesce("use_image", F.lit(False)))


def is_valid(length: Column, settings: Settings = DEFAULTS) -> Column:
    """Payload present and longer than the minimum; never null."""
    return F.coalesce(length > settings.min_length, F.lit(False))


def rejection(length: Column, blank: Column, settings: Settings = DEFAULTS) -> Column:
    """Why a payload is not sent to the service, null where it is sent. First reason wins."""
    return (
        F.when(~is_valid(length, settings), F.lit(INVALID_PAYLOAD))
        .when(blank, F.lit(BLANK_PAYLOAD))
        .when(is_oversize(length, settings), F.lit(OVERSIZE_PAYLOAD))
    )


def is_oversize(length: Column, settings: Settings = DEFAULTS) -> Column:
    """Longer than the service's limit, if it has one."""
    return F.lit(False) if settings.max_length is None else length > settings.max_length


def guard(payload: Column, settings: Settings = DEFAULTS) -> Column:
    """The two checks of the service call itself: blank and oversize payloads."""
    return F.when(is_blank(payload), F.lit(BLANK_PAYLOAD)).when(
        is_oversize(F.length(payload), settings), F.lit(OVERSIZE_PAYLOAD)
    )
