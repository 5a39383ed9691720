"""One-shot conversion: all pages in, the same pages out, failures kept in the markdown column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow import schemas
from pageflow.operators.convert import Converter, by_chunk
from pageflow.operators.payloads import attach_flags
from pageflow.operators.tables import conform_schema, empty, fail_batch
from pageflow.plans.chunks import PLACE, chunk_numbers, differences, fetch, in_flight, with_chunks, with_slices
from pageflow.plans.pages import check_payload, convert_pages, finish_pages, with_payload
from pageflow.settings import DEFAULTS, Settings
from pageflow.sources.store import PageStore

PLAN = schemas.schema("page_key string, row_file string, row_index bigint, use_image boolean, slice int, chunk int")
CONVERTED = T.StructType([*schemas.SUCCESS.fields, *schemas.ROW_REF.fields, T.StructField("error", T.StringType())])

# Progress entry of the planning step; chunks count from 0.
PLANNED = -1


class PagesMissing(RuntimeError):
    """Pages were no longer where the plan had found them."""


def in_band(results: DataFrame) -> DataFrame:
    """The 18 output columns, failures as markdown text."""
    return conform_schema(results.withColumn("markdown", F.coalesce("error", "markdown")), schemas.SUCCESS)


def _slim(pages: DataFrame) -> DataFrame:
    """Rows without payloads, with ``block``: the part of its file that a task of this scan reads."""
    block = F.struct(F.input_file_block_start().alias("start"), F.input_file_block_length().alias("length"))
    try:
        return pages.select("page_key", "doc_id", *PLACE, block.alias("block"))
    except AnalysisException as e:  # pages that are made of several tables are in no one block
        if e.getCondition() != "MULTI_SOURCES_UNSUPPORTED_FOR_EXPRESSION":
            raise
        return pages.select("page_key", "doc_id", *PLACE, F.struct(F.lit(0).alias("start"), F.lit(0).alias("length")).alias("block"))


def _plan(pages: DataFrame, flags: DataFrame, settings: Settings) -> DataFrame:
    """Slim rows of all pages. What a page takes of its file is told by the part that a task of this scan reads."""
    slim = _slim(pages)
    flagged = attach_flags(slim, flags, PLACE, settings)
    expected = slim.count()
    chunked = with_chunks(flagged, expected, settings)
    in_block = F.count("*").over(Window.partitionBy("row_file", "block"))
    return conform_schema(with_slices(chunked, expected, F.col("block.length") / in_block, settings), PLAN)


def one_shot_run(
    pages: DataFrame,
    flags: DataFrame,
    converter: Converter,
    as_of: Column,
    output: str,
    run_id: str,
    settings: Settings = DEFAULTS,
    ready: Callable[[], object] | None = None,
) -> DataFrame:
    """Convert every page once, written below ``output``; returns what was written, with ``error``.

    ``pages`` carry their row identity, flags are joined to slim rows, and figures are read from the result instead of
    converting again. A run that broke off and is started again goes on with the chunks it has finished; one that had ended starts anew.
    Every planned page has a row in the result, or the run raises ``PagesMissing`` and its next start plans anew.

    ``ready`` is called before anything else, say to fetch credentials. If it raises, nothing is planned or sent: all pages
    come out as failed for that reason, and the run has ended.
    """
    spark, store = pages.sparkSession, PageStore(pages.sparkSession, output)
    version = store.version(run_id)
    try:
        if ready is not None:
            ready()
    except Exception as e:
        failed = fail_batch(pages, str(e), as_of).withColumn("error", F.col("markdown")).withColumn("markdown", F.lit(None).cast("string"))
        store.write(conform_schema(failed, CONVERTED), "results", version)
        store.give_up(run_id)
        return store.read("results", version, CONVERTED).drop(*PLACE)
    finished = store.progress(version)
    if PLANNED not in finished:
        store.write(_plan(pages, flags, settings), "plan", version, "chunk")
        store.mark_finished(version, PLANNED, 0)
    plan = spark.read.schema(PLAN).parquet(store.path("plan", version))

    def convert(chunk: int) -> None:
        wide = fetch(pages, plan.where(F.col("chunk") == chunk).drop("page_key", "chunk"))
        checked = check_payload(with_payload(wide), settings)
        rows = conform_schema(finish_pages(convert_pages(checked, converter_of(chunk)), as_of), CONVERTED)
        rows.write.mode("overwrite").parquet(f"{store.path('results', version)}/chunk-{chunk:05d}")
        store.mark_finished(version, chunk, 0)

    chunks = chunk_numbers(plan)
    left = [c for c in chunks if c not in finished]
    if left:
        todo = plan if len(left) == len(chunks) else plan.where(F.col("chunk").isin(left))
        converter_of = by_chunk(converter, todo, store.path("steps/answers", version))
    in_flight(spark, convert, left, settings.chunks_at_once)
    results = store.read("results", version, CONVERTED) if chunks else empty(spark, CONVERTED)
    apart = differences(plan, results) if chunks else None
    store.give_up(run_id)
    if apart and (apart.lost or apart.extra):
        raise PagesMissing(f"{apart.lost} pages of {run_id} were no longer where they had been, {apart.extra} came twice")
    return results.drop(*PLACE)
