"""From answered pages to success-shaped rows; shared by the one-shot and the incremental plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.functions.content import analyse
from pageflow.functions.requests import choose_payload, mode
from pageflow.functions.responses import parse_responses
from pageflow.functions.stages import merge_stage, stamp_text
from pageflow.functions.text import is_blank
from pageflow.operators.convert import Converter
from pageflow.operators.payloads import rejection
from pageflow.settings import COMPLETED, DEFAULTS, FAILED, Settings


def with_payload(pages: DataFrame) -> DataFrame:
    """Add the payload to send and the mode, for pages that carry ``use_image``."""
    use_image = F.col("use_image")
    return pages.withColumn(
        "payload", choose_payload(use_image, F.col("page_payload"), F.col("page_image"))
    ).withColumn("mode", mode(use_image))


def check_payload(pages: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``rejected``, the reason not to send a page, and blank the payload of such pages."""
    payload = F.col("payload")
    rejected = rejection(F.length(payload), is_blank(payload), settings)
    return pages.withColumn("rejected", rejected).withColumn(
        "payload", F.when(F.col("rejected").isNull(), payload)
    )


def convert_pages(pages: DataFrame, converter: Converter) -> DataFrame:
    """Run the converter over pages with ``payload`` and ``mode`` and read its answers.

    A ``rejected`` column names pages that are kept back; they come out as failures for that reason, in
    the same pass over the pages.
    """
    answered = converter(pages).drop("payload")
    if "rejected" in pages.columns:
        answered = answered.withColumn("call_error", F.coalesce("rejected", "call_error")).drop("rejected")
    return parse_responses(answered)


def finish_pages(parsed: DataFrame, as_of: Column) -> DataFrame:
    """Analysis, status and stage time, by the outcome in ``error``."""
    failed = F.col("error").isNotNull()
    return (
        parsed.withColumn("_analysis", analyse(F.col("content"), failed))
        .withColumn("status", F.when(failed, FAILED).otherwise(COMPLETED))
        .withColumn("stage_times", merge_stage(F.col("stage_times"), F.col("status"), stamp_text(as_of)))
        .withColumnRenamed("content", "markdown")
        .select("*", "_analysis.*")
        .drop("_analysis")
    )
