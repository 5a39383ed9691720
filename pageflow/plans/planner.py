"""What a run has to do: new pages, due retries, and nothing twice.

Planning works on slim keys only; payloads never take part. The tables of earlier runs (successes, known
keys) are the large ones here: they are scanned and probed with the keys at hand, and shuffled only where
those keys are too many to broadcast.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pageflow.operators import catalog as C
from pageflow.operators.dedup import keep_one_per_key
from pageflow.operators.joins import lookup
from pageflow.settings import DEFAULTS, Settings

ADDED, RETRY = "added", "retry"
ORDER = ["content_hash", "record_id", "row_file", "row_index"]

# Writes an intermediate table under a name and reads it back, so that it is computed once.
Keep = Callable[[str, DataFrame], DataFrame]


def succeeded(success: DataFrame, pages: DataFrame) -> DataFrame:
    """Page keys of ``pages`` that are in the success table."""
    wanted = pages.select("page_key").distinct()
    return success.select("page_key").join(wanted, "page_key", "left_semi").distinct()


def unseen_pages(added: DataFrame, success: DataFrame) -> DataFrame:
    """Added pages without an earlier success. ``added`` is unique on ``page_key``, so no key is hot."""
    return added.join(succeeded(success, added), "page_key", "left_anti")


def catalog_states(catalog: DataFrame, as_of: Column, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per content: attempts so far and whether it is permanent, due or waiting."""
    state = C.catalog_state(as_of, settings).alias("state")
    return C.one_per_content(catalog).select(*C.KEY, "attempt_count", "last_attempt_at", state)


def due_retries(catalog: DataFrame, as_of: Column, settings: Settings = DEFAULTS) -> DataFrame:
    return catalog_states(catalog, as_of, settings).where(F.col("state") == C.DUE).drop("state")


def one_per_page_key(added: DataFrame) -> DataFrame:
    """Added pages, one per key (one per content where the key is null)."""
    return keep_one_per_key(added, "page_key", ORDER, C.KEY)


def fresh_pages(
    unique: DataFrame, success: DataFrame, states: DataFrame, settings: Settings = DEFAULTS, entry_rows: int | None = None,
    seen: Observation | None = None,
) -> DataFrame:
    """Pages of ``unique`` to process, with their attempts so far.

    A page that arrives again keeps its attempts, and stays out while its content is given up or waiting. ``entry_rows``
    bounds the rows of ``states``; ``seen`` observes how many pages have no success yet.
    """
    unseen = unseen_pages(unique, success)
    if seen is not None:
        unseen = unseen.observe(seen, F.count("*").alias("n"))
    relevant = states.join(unique.select(*C.KEY).distinct(), C.KEY, "left_semi")
    known = lookup(unseen, relevant, C.KEY, ["page_key"], buckets=settings.lookup_buckets, entry_rows=entry_rows)
    return (
        known.where(F.coalesce(F.col("state") == C.DUE, F.lit(True)))
        .withColumn("attempt_count", F.coalesce("attempt_count", F.lit(0)))
        .drop("state")
    )


def match_due(previous: DataFrame, due: DataFrame, settings: Settings = DEFAULTS, entry_rows: int | None = None) -> DataFrame:
    """Previous pages whose content is due for another attempt.

    Copies of one page with one content are one retry; folding them also unloads hot keys.
    """
    spread = ["page_key", "row_file", "row_index"]
    matched = lookup(previous, due, C.KEY, spread, "inner", settings.lookup_buckets, entry_rows)
    return keep_one_per_key(matched, ["page_key", *C.KEY], ["row_file", "row_index"])


def mark_done(matched: DataFrame, success: DataFrame, settings: Settings = DEFAULTS, entry_rows: int | None = None) -> DataFrame:
    """Add ``done`` where the page has succeeded since; the others become unique on ``page_key``.

    ``entry_rows`` bounds the rows of ``matched``, and so the successes among them.
    """
    done = succeeded(success, matched).withColumn("done", F.lit(True))
    flagged = lookup(matched, done, ["page_key"], C.KEY, buckets=settings.lookup_buckets, entry_rows=entry_rows)
    return _one_per_page(flagged.withColumn("done", F.coalesce("done", F.lit(False))), ORDER)


def _one_per_page(rows: DataFrame, order: list[str]) -> DataFrame:
    """One row per page key among rows to process; done rows and those without a key stay, one per content."""
    content = F.when(F.col("done") | F.col("page_key").isNull(), F.concat_ws(" ", *C.KEY))
    return keep_one_per_key(rows.withColumn("_content", content), ["page_key", "_content"], order).drop("_content")


def retry_candidates(
    previous: DataFrame, due: DataFrame, success: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    return mark_done(match_due(previous, due, settings), success, settings)


def combine(
    fresh: DataFrame, retries: DataFrame, settings: Settings = DEFAULTS, fresh_rows: int | None = None, retry_rows: int | None = None
) -> DataFrame:
    """Fresh pages and retries as one plan, unique on ``page_key`` among rows with ``done`` false.

    New content of a page wins over a retry of its old content; the same content is tried once, as a retry.
    Pages are told apart by their key, not by record id, which pages of a document without page numbers share.
    Rows with ``done`` true are there for the catalog, not for conversion. The last two arguments bound the tables' rows.
    """
    arrived = fresh.join(retries.select("page_key").distinct(), "page_key", "left_semi")
    arrived = arrived.select("page_key", F.concat_ws(" ", *C.KEY).alias("_arrived"))
    current = lookup(retries, arrived, ["page_key"], C.KEY, buckets=settings.lookup_buckets, entry_rows=fresh_rows)
    replaced = F.coalesce(F.col("_arrived") != F.concat_ws(" ", *C.KEY), F.lit(False))
    current = current.where(F.col("done") | ~replaced).drop("_arrived").withColumn("origin", F.lit(RETRY))
    tried = current.where(~F.col("done")).select("page_key", *C.KEY).distinct()
    new = lookup(fresh, tried, ["page_key", *C.KEY], C.KEY, "left_anti", settings.lookup_buckets, retry_rows)
    new = new.withColumns({"done": F.lit(False), "origin": F.lit(ADDED)})
    return _one_per_page(new.unionByName(current), ["origin", *ORDER])


def plan_work(
    added: DataFrame,
    previous: DataFrame,
    success: DataFrame,
    catalog: DataFrame,
    as_of: Column,
    settings: Settings = DEFAULTS,
    keep: Keep = lambda name, df: df,
) -> DataFrame:
    """Slim rows of the pages to process, with ``origin``, ``done``, ``attempt_count`` and ``last_attempt_at``."""
    states = catalog_states(catalog, as_of, settings)
    fresh = keep("fresh", fresh_pages(keep("unique", one_per_page_key(added)), success, states, settings))
    due = states.where(F.col("state") == C.DUE).drop("state")
    matched = keep("matched", match_due(previous, due, settings))
    retries = keep("retries", mark_done(matched, success, settings))
    return combine(fresh, retries, settings)
