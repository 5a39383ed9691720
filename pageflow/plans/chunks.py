"""Fetching the wide rows of a slim plan without moving payloads.

A plan names pages by file and row. Its rows are packed into chunks by counted size: whole files, or blocks of
``chunk_rows`` row numbers of a larger file, one after the other, until ``chunk_rows`` rows or ``chunk_files``
files are reached. A chunk thus has fewer than twice as many of either, which bounds what is broadcast to its scan
and the list of files that narrows it, whatever the size of the table. Payloads stay in the tasks that read them.
A chunk is also the unit in which a broken run is taken up again.

A scan deals out files by bytes, so one task may get very many small pages. The rows of a chunk, in order of file and
place, are cut where a scan would cut them, by the bytes counted before; what a task gets beyond ``task_calls`` pages goes
into further slices. Each slice is a scan of its own over the files it needs, and so has tasks of its own. Files of large
pages are in the first slice only; those of small pages are read once for each slice, which costs little against the calls.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from pageflow.functions.keys import content_hash, record_id
from pageflow.settings import DEFAULTS, Settings
from pageflow.sources.tables import PageFolder

PLACE = ["row_file", "row_index"]

# Between two looks at chunks that run.
WATCH_SECONDS = 0.5
# Chunks that one task numbers at most when the plan is packed.
CHUNKS_PER_BUCKET = 1000


def with_chunks(rows: DataFrame, expected_rows: int, settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``chunk`` to slim rows with ``row_file, row_index``, of which there are ``expected_rows`` at most."""
    if expected_rows <= min(settings.chunk_rows, settings.chunk_files):
        return rows.withColumn("chunk", F.lit(0))
    block = F.floor(F.col("row_index") / settings.chunk_rows)
    buckets = 1 + expected_rows // (settings.chunk_rows * CHUNKS_PER_BUCKET)
    units = rows.groupBy("row_file", block.alias("_block")).agg(F.count("*").alias("_rows"))
    share = F.greatest(F.col("_rows") / settings.chunk_rows, F.lit(1 / settings.chunk_files))
    bucket = F.pmod(F.xxhash64("row_file"), F.lit(buckets))
    before = Window.partitionBy("_bucket").orderBy("row_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    packed = units.withColumns({"_bucket": bucket, "_share": share}).withColumn(
        "chunk", (F.floor(F.coalesce(F.sum("_share").over(before), F.lit(0.0))) * buckets + F.col("_bucket")).cast("int")
    )
    numbered = rows.withColumn("_block", block).join(packed.select("row_file", "_block", "chunk"), ["row_file", "_block"])
    return numbered.drop("_block")


def with_slices(rows: DataFrame, expected_rows: int, size: Column, settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``slice`` to rows with ``row_file, row_index, chunk``, whose pages have about ``size`` bytes in their files."""
    if expected_rows <= settings.task_calls:
        return rows.withColumn("slice", F.lit(0))
    order = Window.partitionBy("chunk").orderBy("row_file", "row_index")
    read = F.sum(F.coalesce(size, F.lit(0)).cast("double")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    cut = rows.withColumn("_task", F.floor(read / settings.task_bytes))
    within = Window.partitionBy("chunk", "_task").orderBy("row_file", "row_index")
    number = F.floor((F.row_number().over(within) - 1) / settings.task_calls)
    return cut.withColumn("slice", number.cast("int")).drop("_task")


def chunk_numbers(plan: DataFrame) -> list[int]:
    """Chunks that fetch pages."""
    return sorted(r.chunk for r in plan.where(F.col("chunk") >= 0).select("chunk").distinct().collect())


def fetch(pages: DataFrame | PageFolder, part: DataFrame) -> DataFrame:
    """Pages named by ``part``: a chunk's ``row_file, row_index``, ``slice`` where it has several, and columns to add.

    Where ``part`` has ``expected_hash``, a page whose content is another is not fetched: files may have been
    replaced since.
    """
    sliced = part if "slice" in part.columns else part.withColumn("slice", F.lit(0))
    files: dict[int, list[str]] = {}
    for r in sliced.select("slice", "row_file").distinct().collect():
        files.setdefault(r.slice, []).append(r.row_file)

    def scan(number: int, names: list[str]) -> DataFrame:
        own = sliced.where(F.col("slice") == number).drop("slice")
        named = pages.of(names) if isinstance(pages, PageFolder) else pages.where(F.col("row_file").isin(names))
        return named.join(F.broadcast(own), PLACE)

    scans = [scan(number, names) for number, names in sorted(files.items())] or [scan(0, [])]
    wide = reduce(DataFrame.unionByName, scans)
    if "expected_hash" not in part.columns:
        return wide
    same = F.col("expected_hash").isNull() | (content_hash() == F.col("expected_hash"))
    return wide.where(same).drop("expected_hash")


def place_sum() -> Column:
    """An aggregate over places that tells tables with different ones apart, whatever their order."""
    return F.coalesce(F.sum(F.xxhash64(*PLACE).cast("decimal(38,0)")), F.lit(0)).cast("string")


def differences(fetched: DataFrame, results: DataFrame) -> Row:
    """``lost``: places that were to be fetched and have no result; ``extra``: places with one too many."""
    rows = fetched.select(*PLACE, F.lit(1).alias("planned")).unionByName(results.select(*PLACE, F.lit(0).alias("planned")))
    per_place = rows.groupBy(*PLACE).agg(F.sum("planned").alias("planned"), F.count_if(F.col("planned") == 0).alias("results"))
    lost, extra = F.col("results") < F.col("planned"), F.col("results") > F.col("planned")
    return per_place.agg(F.count_if(lost).alias("lost"), F.count_if(extra).alias("extra")).first()


def in_flight(
    spark: SparkSession, work: Callable[[int], None], items: list[int], at_once: int, give_up: Callable[[], None] = lambda: None
) -> None:
    """Some Spark jobs at a time; after a failure those not started are dropped.

    ``give_up`` is asked every now and then; if it raises, the jobs that run are cancelled too.
    """
    context, tag = spark.sparkContext, f"pageflow-{uuid.uuid4().hex}"

    def tagged(item: int) -> None:
        context.addJobTag(tag)
        try:
            work(item)
        finally:
            context.removeJobTag(tag)

    with ThreadPoolExecutor(at_once) as pool:
        futures = {pool.submit(tagged, item) for item in items}
        try:
            while futures:
                done, futures = wait(futures, WATCH_SECONDS, FIRST_COMPLETED)
                for future in done:
                    future.result()
                if futures:
                    give_up()
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            context.cancelJobsWithTag(tag)
            raise


def find_again(pages: DataFrame | PageFolder, lost: DataFrame) -> DataFrame:
    """Where the pages of ``lost`` (plan rows) are now: the same rows with a new ``row_file, row_index``.

    Pages are looked up by key and content, those without a key by record and content. Only pages with a wanted key
    or record are hashed. Pages that are found nowhere don't come back.
    """
    pages = pages.all() if isinstance(pages, PageFolder) else pages
    wanted = lost.drop("row_file", "row_index")
    at = F.struct("row_file", "row_index").alias("_at")

    def found(named: DataFrame, key: str) -> DataFrame:
        hashed = named.select(key, content_hash().alias("content_hash"), at)
        places = hashed.groupBy(key, "content_hash").agg(F.min("_at").alias("_at"))
        return wanted.join(places, [key, "content_hash"]).select(*wanted.columns, "_at.*")

    keyed = pages.join(wanted.select("page_key").distinct(), "page_key", "left_semi")
    records = wanted.where(F.col("page_key").isNull()).select("record_id").distinct()
    bare = pages.where(F.col("page_key").isNull()).withColumn("record_id", record_id())
    bare = bare.join(records, "record_id", "left_semi")
    without = found(bare, "record_id").where(F.col("page_key").isNull())
    return found(keyed, "page_key").unionByName(without)
