"""Incremental runs as Structured Streaming micro-batches."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from pageflow import schemas
from pageflow.operators.convert import Converter
from pageflow.operators.tables import empty
from pageflow.plans.incremental import run_batch
from pageflow.settings import DEFAULTS, Settings
from pageflow.sources.store import PageStore
from pageflow.sources.tables import PageFolder, with_row_ref


def stream_pages(
    store: PageStore,
    folder: str,
    flags: DataFrame,
    converter: Converter,
    as_of: Callable[[], Column],
    earlier: DataFrame | None = None,
    files_per_batch: int = 1000,
    settings: Settings = DEFAULTS,
    name: str = "pages",
) -> StreamingQuery:
    """Start a query that runs one incremental run per micro-batch of new page files, then stops.

    The success table and the error catalog are the state, so no watermark is needed. ``name`` tells the streams
    of a store apart: give each input folder its own. Run ids hold the name, the id that Spark keeps in the
    stream's checkpoint, and the batch number: a micro-batch that is replayed keeps its run id and is committed
    once, one after a tripped breaker converts anew, and a renewed checkpoint reads its folder as new.
    A micro-batch opens its own files and those of its retries, by name; the folder is listed by the stream alone.
    ``earlier`` holds pages that never were in ``folder``; ``as_of`` is asked once per micro-batch.
    """
    spark = store.spark
    pages = PageFolder(spark, folder, schemas.PAGE, earlier)

    def on_batch(added: DataFrame, batch_id: int) -> None:
        checkpoint = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        run_id = f"{name}-{checkpoint}-{batch_id:08d}"
        run_batch(store, added, pages, flags, converter, as_of(), run_id, settings=settings)

    arriving = with_row_ref(
        spark.readStream.schema(schemas.PAGE).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    )
    return (
        arriving.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", f"{store.path('stream')}/{name}")
        .trigger(availableNow=True)
        .start()
    )


def run_due_retries(
    store: PageStore,
    pages: DataFrame,
    flags: DataFrame,
    converter: Converter,
    as_of: Column,
    run_id: str,
    settings: Settings = DEFAULTS,
) -> None:
    """A run without new pages. A stream fires on new files only, so due retries need a run of their own.

    All its pages have failed before, so that they fail again says nothing about the service: the breaker is off, which would
    otherwise stop such a run for good. The attempt limit bounds the calls.
    """
    settings = replace(settings, breaker_rate=math.inf)
    nothing = empty(store.spark, pages.select(*[f.name for f in schemas.PAGE], "row_file", "row_index").schema)
    run_batch(store, nothing, pages, flags, converter, as_of, run_id, store.head().last_ingest_id, settings)
