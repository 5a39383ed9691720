"""One query per operator, over the shared test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow import schemas
from pageflow.functions.content import analyse, word_count
from pageflow.functions.errors import classify_error
from pageflow.functions.requests import request_document
from pageflow.functions.responses import parse_responses
from pageflow.functions.scores import clean_score
from pageflow.functions.stages import merge_stage, stamp_text
from pageflow.functions.text import is_error_text
from pageflow.operators import catalog as C
from pageflow.operators import dedup, metrics, payloads, tables
from pageflow.operators.convert import python_converter, recorded_converter
from pageflow.plans.incremental import run_batch
from pageflow.plans.one_shot import in_band, one_shot_run
from pageflow.plans.pages import with_payload
from pageflow.plans import planner
from pageflow.session import work_folder
from pageflow.settings import COMPLETED, DEFAULTS
from pageflow.sources import testdata as td
from pageflow.sources.html_service import open_html_service
from pageflow.sources.store import PageStore
from pageflow.sources.tables import added_pages, previous_pages
from pageflow.streaming.micro_batch import stream_pages
from pageflow.streaming.retries import stream_retries as start_retries

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removesuffix("_query")] = fn
    return fn


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = td.page_batch(spark, sf_dir, totals=False)
    return payloads.attach_flags_in_place(pages, td.page_flags(spark, sf_dir))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_responses(td.responses(spark, sf_dir).withColumn("mode", F.lit("Page")))


def _keys(pages: DataFrame) -> DataFrame:
    return payloads.page_keys(pages)


def _keep(spark: SparkSession) -> planner.Keep:
    """Steps of planning as tables in a work folder, as a run has them."""
    folder = work_folder(spark)

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    return keep


# -- page level ---------------------------------------------------------------------------------


@query
def page_keys(spark, sf_dir):
    return _keys(td.page_batch(spark, sf_dir, totals=False)).drop("row_file", "row_index")


@query
def page_flags(spark, sf_dir):
    return _flagged(spark, sf_dir).select("page_key", "doc_id", "use_image")


@query
def payload_choice(spark, sf_dir):
    return with_payload(_flagged(spark, sf_dir)).select(
        "page_key", "mode", F.sha2("payload", 256).alias("payload_hash"), F.length("payload").alias("payload_length")
    )


@query
def payload_validity(spark, sf_dir):
    length = F.length("payload")
    return with_payload(_flagged(spark, sf_dir)).select(
        "page_key",
        payloads.is_valid(F.length("page_payload")).alias("page_valid"),
        payloads.is_valid(length).alias("payload_valid"),
        payloads.rejection(length, F.lit(False)).alias("error"),
    )


@query
def payload_guard(spark, sf_dir):
    """With the size limit lowered to 500 characters, so that it matters on the test texts."""
    limits = replace(DEFAULTS, max_length=500)
    blank = F.when(F.col("page_number") == 3, F.lit(" \t ")).otherwise(F.col("page_payload"))
    pages = td.page_batch(spark, sf_dir, totals=False)
    return pages.select("page_key", payloads.guard(blank, limits).alias("error"))


@query
def request_docs(spark, sf_dir):
    """The request documents, taken apart again: the text form of JSON is not compared."""
    number = F.when(F.col("page_number") != 2, F.col("page_number"))
    sent = with_payload(_flagged(spark, sf_dir)).select(
        "page_key", "mode", request_document(F.col("use_image"), F.col("payload"), number).alias("request")
    )
    field = lambda name: F.get_json_object("request", f"$.parameters.{name}")
    return sent.select(
        "page_key",
        "mode",
        F.sha2(field("pdf_encoding"), 256).alias("page_hash"),
        F.sha2(field("page_image_base64_encoding"), 256).alias("image_hash"),
        field("include_images").alias("include_images"),
        field("include_ocr").alias("include_ocr"),
        field("page_number").alias("page_number"),
    )


@query
def parse_response(spark, sf_dir):
    return _parsed(spark, sf_dir).drop("doc_id", "page_number", "mode", "status_code")


@query
def clean_scores(spark, sf_dir):
    return td.raw_scores(spark, sf_dir).select("event_id", clean_score(F.col("raw")).alias("score"))


@query
def content_analysis(spark, sf_dir):
    docs = td.markdown_docs(spark, sf_dir)
    return docs.select("doc_id", analyse(F.col("markdown")).alias("a")).select("doc_id", "a.*")


@query
def word_count_whole(spark, sf_dir):
    docs = td.table(spark, sf_dir, "documents")
    return docs.select("doc_id", word_count(F.col("text")).alias("word_count"))


@query
def classify_error_query(spark, sf_dir):
    return td.messages(spark, sf_dir).select("event_id", classify_error(F.col("message")).alias("error_category"))


@query
def stage_times(spark, sf_dir):
    pages = td.page_batch(spark, sf_dir, totals=False)
    merged = merge_stage(F.col("stage_times"), F.lit(COMPLETED), stamp_text(td.as_of()))
    entries = F.explode(F.from_json(merged, "map<string,string>")).alias("stage", "at")
    return pages.select("page_key", entries)


@query
def conform_schema(spark, sf_dir):
    """Page rows without two of the declared columns and with some that are not declared."""
    pages = td.page_batch(spark, sf_dir).drop("media_ref", "page_number")
    return tables.conform_schema(pages, schemas.PAGE)


@query
def fail_batch(spark, sf_dir):
    return tables.fail_batch(td.page_batch(spark, sf_dir), "OAuth2 authentication failed", td.as_of())


# -- keys and planning --------------------------------------------------------------------------


@query
def dedup_added(spark, sf_dir):
    keys = _keys(td.page_batch_with_copies(spark, sf_dir))
    return dedup.keep_one_per_key(keys, "page_key", planner.ORDER, C.KEY).select("page_key", "record_id", "content_hash")


@query
def key_audit(spark, sf_dir):
    return dedup.key_audit(td.page_batch_with_copies(spark, sf_dir), "page_key")


@query
def unseen_pages(spark, sf_dir):
    added = added_pages(td.page_batch(spark, sf_dir, totals=False), 1)
    done = td.success_previous(spark, sf_dir)
    return planner.unseen_pages(_keys(added), done).select("page_key", "record_id")


@query
def error_split(spark, sf_dir):
    permanent = F.when(C.is_permanent(), C.PERMANENT).otherwise("retriable")
    return td.catalog_from_events(spark, sf_dir).select(
        "record_id", "attempt_count", "error_category", permanent.alias("split")
    )


@query
def due_retries(spark, sf_dir):
    due = planner.due_retries(td.catalog_from_events(spark, sf_dir), td.as_of("2024-01-30 00:00:00"))
    return due.withColumn("last_attempt_at", F.date_format("last_attempt_at", "yyyy-MM-dd HH:mm:ss"))


@query
def retry_candidates(spark, sf_dir):
    previous = previous_pages(td.page_batch(spark, sf_dir, totals=False), 1)
    due = planner.due_retries(td.catalog_from_pages(spark, sf_dir), td.as_of())
    matched = _keep(spark)("matched", planner.match_due(_keys(previous), due))
    return planner.mark_done(matched, td.success_previous(spark, sf_dir)).select(
        "page_key", "record_id", "content_hash", "attempt_count", "done"
    )


@query
def work_plan(spark, sf_dir):
    pages = td.page_batch_with_changes(spark, sf_dir)
    plan = planner.plan_work(
        _keys(added_pages(pages, 1)),
        _keys(previous_pages(pages, 1)),
        td.success_previous(spark, sf_dir),
        td.catalog_from_pages(spark, sf_dir),
        td.as_of(),
        keep=_keep(spark),
    )
    return plan.select("page_key", "record_id", "content_hash", "origin", "attempt_count", "done")


# -- results and errors -------------------------------------------------------------------------


@query
def result_split(spark, sf_dir):
    """Outcome by the error column, and by the text as older tables carry it."""
    text = F.coalesce("error", "content")
    return _parsed(spark, sf_dir).select(
        "page_key", is_error_text(text).alias("failed_by_text"), F.col("error").isNotNull().alias("failed")
    )


@query
def error_catalog(spark, sf_dir):
    catalog = td.catalog_from_pages(spark, sf_dir)
    tried = _keys(added_pages(td.page_batch(spark, sf_dir, totals=False), 1))
    before = C.one_per_content(catalog).select(*C.KEY, "attempt_count")
    failed = _parsed(spark, sf_dir).where(F.col("error").isNotNull())
    failures = (
        tried.join(before, C.KEY, "left")
        .withColumn("attempt_count", F.coalesce("attempt_count", F.lit(0)))
        .join(failed.select("page_key", "error", "status_code"), "page_key")
        .withColumn("error_category", classify_error(F.col("error"), F.col("status_code")))
    )
    merged = C.merge_catalog(catalog, tried, tried, failures, td.as_of())
    return merged.withColumn("last_attempt_at", F.date_format("last_attempt_at", "yyyy-MM-dd HH:mm:ss"))


@query
def dedup_success(spark, sf_dir):
    """Success rows for a batch with copies: one row per page, the one with the smaller content hash."""
    keys = _keys(td.page_batch_with_copies(spark, sf_dir)).select("page_key", "record_id", "content_hash")
    done = _parsed(spark, sf_dir).where(F.col("error").isNull()).select("page_key", "content", "parse_score")
    return dedup.keep_one_per_key(keys.join(done, "page_key"), "page_key", ["content_hash", "record_id"], C.KEY)


def _stored_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return td.stored_page_batch(spark, sf_dir, f"{work_folder(spark)}/pages")


def _one_shot(spark, sf_dir):
    """Written once; figures are read from what was written."""
    return one_shot_run(
        _stored_pages(spark, sf_dir),
        td.page_flags(spark, sf_dir),
        recorded_converter(td.responses(spark, sf_dir)),
        td.as_of(),
        work_folder(spark),
        "one-shot",
    )


@query
def run_metrics(spark, sf_dir):
    return metrics.run_metrics(_one_shot(spark, sf_dir))


@query
def error_summary(spark, sf_dir):
    errors = td.catalog_from_events(spark, sf_dir).withColumn("error_category", C.category_or_unknown())
    return metrics.error_summary(errors)


@query
def error_counts(spark, sf_dir):
    return metrics.category_counts(classify_error_query(spark, sf_dir))


@query
def error_top5(spark, sf_dir):
    return metrics.top_categories(classify_error_query(spark, sf_dir))


@query
def sample_rows(spark, sf_dir):
    pages = td.page_batch(spark, sf_dir, totals=False).select("page_key", "stage_times")
    return tables.sample_rows(pages, "page_key", 5)


@query
def breaker_check(spark, sf_dir):
    counts = metrics.run_metrics(_one_shot(spark, sf_dir)).select("processed_count", "error_count", "error_rate")
    return metrics.breaker_check(counts)


# -- whole runs ---------------------------------------------------------------------------------


@query
def one_shot_query(spark, sf_dir):
    return in_band(_one_shot(spark, sf_dir))


@query
def one_shot_chunked(spark, sf_dir):
    """The same table in small chunks."""
    return in_band(
        one_shot_run(
            _stored_pages(spark, sf_dir),
            td.page_flags(spark, sf_dir),
            recorded_converter(td.responses(spark, sf_dir)),
            td.as_of(),
            work_folder(spark),
            "chunked",
            replace(DEFAULTS, chunk_rows=4_000, chunk_files=4),
        )
    )


@query
def convert_pages(spark, sf_dir):
    """Web pages through a Python converter, read back and analysed by the engine."""
    flags = tables.empty(spark, schemas.FLAGS)
    service = python_converter(open_html_service())
    done = one_shot_run(td.web_pages(spark, sf_dir), flags, service, td.as_of(), work_folder(spark), "web")
    return done.select(
        "page_key", "markdown", "parse_score", "ocr_score", "has_table", "has_image", "word_count", "error"
    )


def _store_with_history(spark: SparkSession, sf_dir: str) -> tuple[PageStore, DataFrame]:
    store = PageStore(spark, work_folder(spark))
    pages = _stored_pages(spark, sf_dir)
    store.import_history(
        previous_pages(pages, 1),
        td.success_previous(spark, sf_dir),
        td.catalog_from_pages(spark, sf_dir),
        1,
        td.as_of("2024-01-30 11:59:00"),
    )
    return store, pages


def _after_batch(spark: SparkSession, sf_dir: str) -> PageStore:
    store, pages = _store_with_history(spark, sf_dir)
    run_batch(
        store,
        added_pages(pages, 1),
        pages,
        td.page_flags(spark, sf_dir),
        recorded_converter(td.responses(spark, sf_dir)),
        td.as_of(),
        "run-2",
        2,
    )
    return store


def _new_successes(store: PageStore) -> DataFrame:
    """Successes of the runs themselves: imported ones carry no status."""
    return store.successes().where(F.col("status").isNotNull())


@query
def batch_run(spark, sf_dir):
    return _new_successes(_after_batch(spark, sf_dir))


@query
def batch_run_catalog(spark, sf_dir):
    catalog = _after_batch(spark, sf_dir).catalog()
    return catalog.withColumn("last_attempt_at", F.date_format("last_attempt_at", "yyyy-MM-dd HH:mm:ss"))


@query
def batch_run_metrics(spark, sf_dir):
    return _after_batch(spark, sf_dir).metrics().drop("as_of")


@query
def batch_run_report(spark, sf_dir):
    return _after_batch(spark, sf_dir).report()


@query
def stream_run(spark, sf_dir):
    """The added pages as files, one micro-batch each; the success table equals that of one batch."""
    store, pages = _store_with_history(spark, sf_dir)
    folder = store.path("arriving")
    conformed = T.StructType([*schemas.PAGE.fields, *schemas.ROW_REF.fields])
    earlier = tables.conform_schema(previous_pages(pages, 1), conformed)
    arriving = tables.conform_schema(added_pages(pages, 1), schemas.PAGE)
    arriving.repartition(3, "page_key").write.parquet(folder)
    stream = stream_pages(
        store,
        folder,
        td.page_flags(spark, sf_dir),
        recorded_converter(td.responses(spark, sf_dir)),
        td.as_of,
        earlier,
        files_per_batch=1,
    )
    stream.awaitTermination()
    return _new_successes(store)


@query
def stream_retries(spark, sf_dir):
    """All pages in one run, then only a clock: what fails for the time being is sent again after 2 and 4 minutes.

    The last tick is late enough for a fourth attempt, which there must not be.
    """
    store, pages = PageStore(spark, work_folder(spark)), _stored_pages(spark, sf_dir)
    flags, converter = td.page_flags(spark, sf_dir), recorded_converter(td.responses(spark, sf_dir))
    run_batch(store, pages, pages, flags, converter, td.as_of(), "run-1", 2)
    clock_folder = store.path("clock")
    for tick in ("2024-01-30 12:02:30", "2024-01-30 12:06:45", "2024-01-30 13:00:00"):
        spark.range(1).select(td.as_of(tick).alias("at")).write.mode("append").parquet(clock_folder)
        clock = spark.readStream.schema("at timestamp").parquet(clock_folder)
        stream = start_retries(store, pages, flags, converter, lambda tick=tick: td.as_of(tick), clock, availableNow=True)
        stream.awaitTermination()
    return store.catalog().withColumn("last_attempt_at", F.date_format("last_attempt_at", "yyyy-MM-dd HH:mm:ss"))
