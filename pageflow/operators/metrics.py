"""Run metrics, error summaries and the circuit breaker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.settings import DEFAULTS, INVALID_PAYLOAD, PERMANENT_CATEGORIES, Settings


def count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def rate(part: Column, whole: Column, scale: float = 1.0) -> Column:
    return F.when(whole > 0, part / whole * F.lit(scale))


def outcome_counts() -> list[Column]:
    """Aggregates over rows with ``error, markdown, has_table, has_image``."""
    failed = F.col("error").isNotNull()
    total = F.count("*")
    return [
        total.alias("processed_count"),
        count_if(~failed).alias("success_count"),
        count_if(failed).alias("error_count"),
        count_if(F.col("error") == INVALID_PAYLOAD).alias("invalid_count"),
        count_if(F.col("has_table")).alias("table_count"),
        count_if(F.col("has_image")).alias("image_count"),
        count_if(~failed & F.col("markdown").isNull()).alias("null_content_count"),
        rate(count_if(~failed), total, 100.0).alias("success_rate"),
        rate(count_if(failed), total).alias("error_rate"),
    ]


def run_metrics(results: DataFrame) -> DataFrame:
    """One row of counts and rates, in one pass."""
    return results.agg(*outcome_counts())


def error_summary(errors: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Errors, mean attempts and how many of them will not be tried again, by category."""
    permanent = F.col("error_category").isin(*PERMANENT_CATEGORIES)
    return errors.groupBy("error_category").agg(
        F.count("*").alias("error_count"),
        F.avg("attempt_count").alias("avg_attempts"),
        count_if(F.col("attempt_count") >= settings.max_attempts).alias("exhausted_count"),
        count_if(permanent).alias("permanent_count"),
    )


def category_counts(errors: DataFrame) -> DataFrame:
    return errors.groupBy("error_category").agg(F.count("*").alias("error_count"))


def top_categories(errors: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most frequent categories, ties by name."""
    return category_counts(errors).orderBy(F.desc("error_count"), "error_category").limit(n)


def is_tripped(processed: int, errors: int, settings: Settings = DEFAULTS) -> bool:
    """The breaker's rule for plain numbers."""
    enough = processed >= settings.breaker_min_rows and errors >= settings.breaker_min_failures
    return enough and errors / processed >= settings.breaker_rate


def breaker_check(counts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Adds ``tripped`` to a row with ``processed_count, error_count, error_rate``."""
    tripped = (
        (F.col("processed_count") >= settings.breaker_min_rows)
        & (F.col("error_count") >= settings.breaker_min_failures)
        & (F.coalesce("error_rate", F.lit(0.0)) >= settings.breaker_rate)
    )
    return counts.withColumn("tripped", tripped)
