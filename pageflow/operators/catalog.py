"""The error catalog: one row per (record_id, content_hash)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow import schemas
from pageflow.functions.errors import UNKNOWN
from pageflow.operators.joins import lookup
from pageflow.operators.tables import conform_schema
from pageflow.settings import DEFAULTS, PERMANENT_CATEGORIES, Settings

KEY = ["record_id", "content_hash"]

PERMANENT, DUE, WAITING = "permanent", "due", "waiting"


def one_per_content(catalog: DataFrame) -> DataFrame:
    """Fold catalog rows to one per key, the one with most attempts (latest, on a tie)."""
    ranked = ["attempt_count", "last_attempt_at", "error_category", "last_error", "error_date", "page_key"]
    folded = catalog.groupBy(*KEY).agg(F.max(F.struct(*ranked)).alias("_top"))
    return conform_schema(folded.select(*KEY, "_top.*"), schemas.CATALOG)


def category_or_unknown() -> Column:
    return F.coalesce("error_category", F.lit(UNKNOWN))


def is_permanent(settings: Settings = DEFAULTS) -> Column:
    return category_or_unknown().isin(*PERMANENT_CATEGORIES) | (F.col("attempt_count") >= settings.max_attempts)


def retry_after() -> Column:
    """Backoff: 2^attempts minutes after the last attempt."""
    minutes = F.pow(F.lit(2), "attempt_count").cast("int")
    return F.timestamp_add("MINUTE", minutes, F.col("last_attempt_at"))


def is_due(as_of: Column) -> Column:
    """Backoff over; an unknown last attempt is due."""
    return F.coalesce(retry_after() <= as_of, F.lit(True))


def catalog_state(as_of: Column, settings: Settings = DEFAULTS) -> Column:
    return (
        F.when(is_permanent(settings), F.lit(PERMANENT)).when(is_due(as_of), F.lit(DUE)).otherwise(F.lit(WAITING))
    )


def new_errors(failures: DataFrame, as_of: Column) -> DataFrame:
    """Catalog rows for failed pages (``page_key, record_id, content_hash, attempt_count, error, error_category``).

    Several pages may share a content, so these are not folded yet.
    """
    return failures.select(
        *KEY,
        (F.col("attempt_count") + 1).cast("int").alias("attempt_count"),
        F.col("error").alias("last_error"),
        category_or_unknown().alias("error_category"),
        as_of.alias("last_attempt_at"),
        F.to_date(as_of).alias("error_date"),
        "page_key",
    )


def waiting_rows(failures: DataFrame, as_of: Column, settings: Settings = DEFAULTS) -> DataFrame:
    """New failures with the time from which they are due again."""
    again = F.when(~is_permanent(settings), retry_after())
    rows = new_errors(failures, as_of).withColumns({"at": F.col("last_attempt_at"), "due_at": again})
    return conform_schema(rows, schemas.WAITING)


def touched_records(catalog: DataFrame, settled: DataFrame, replaced: DataFrame, failures: DataFrame) -> DataFrame:
    """``record_id`` of all rows that ``merge_catalog`` would take out of the catalog or put into it, maybe of some more."""
    tried = catalog.join(settled.select(*KEY).distinct(), KEY, "left_semi")
    arrived = catalog.join(replaced.select("page_key").distinct(), "page_key", "left_semi")
    return reduce(DataFrame.unionAll, [rows.select("record_id") for rows in (failures, tried, arrived)])


def merge_catalog(
    catalog: DataFrame,
    settled: DataFrame,
    replaced: DataFrame,
    failures: DataFrame,
    as_of: Column,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """The catalog after a run.

    ``settled``: keys tried in this run or known to have succeeded; they leave the catalog and come
    back only as a new failure. ``replaced``: ``page_key, record_id, content_hash`` of newly arrived pages;
    other contents of the same page leave too. Everything else is carried over: waiting rows, rows of other
    pages that share the record id, and rows whose page key is unknown.
    """
    # What a run tried may be far more than the catalog holds: it is narrowed to the catalog's keys first.
    of_catalog = lambda rows, keys: rows.join(catalog.select(*keys).distinct(), keys, "left_semi")
    kept = catalog.join(of_catalog(settled.select(*KEY), KEY).distinct(), KEY, "left_anti")
    arrived = of_catalog(replaced.select("page_key", *KEY), ["page_key"])
    arrived = arrived.groupBy("page_key").agg(F.min(F.concat_ws(" ", *KEY)).alias("_first"), F.max(F.concat_ws(" ", *KEY)).alias("_last"))
    kept = lookup(kept, arrived, ["page_key"], KEY, buckets=settings.lookup_buckets)
    own = F.concat_ws(" ", *KEY)
    outdated = (F.col("_first") != own) | (F.col("_last") != own)
    kept = kept.where(~F.coalesce(outdated, F.lit(False))).select(*[f.name for f in schemas.CATALOG])
    return one_per_content(kept.unionByName(new_errors(failures, as_of)))
