"""Operators on whole tables: schema conformity, failed batches, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow import schemas
from pageflow.functions.stages import stamp_text
from pageflow.settings import FAILED


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, in a form whose emptiness the optimizer sees: joins with it fold away."""
    value = lambda f: null_of(f) if f.nullable else F.lit("" if f.dataType == T.StringType() else 0).alias(f.name)
    return spark.range(1).where(F.lit(False)).select([value(f) for f in schema.fields])


def null_of(field: T.StructField) -> Column:
    return F.lit(None).cast(field.dataType).alias(field.name)


def conform_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns in its order: missing ones as typed nulls, others dropped, no casts."""
    present = set(df.columns)
    return df.select([F.col(f.name) if f.name in present else null_of(f) for f in schema.fields])


def fail_batch(pages: DataFrame, reason: str, as_of: Column) -> DataFrame:
    """Success-shaped output for a batch that could not be tried at all, e.g. for want of credentials."""
    outcome = {
        "status": F.lit(reason),
        "stage_times": F.to_json(F.create_map(F.lit(FAILED), stamp_text(as_of))),
        "markdown": F.lit(f"ERROR: {reason}"),
        "has_table": F.lit(False),
        "has_image": F.lit(False),
        "word_count": F.lit(0),
    }
    kept = set(schemas.PAGE.names) & set(pages.columns)
    value = lambda f: outcome[f.name].alias(f.name) if f.name in outcome else F.col(f.name) if f.name in kept else null_of(f)
    return pages.select([value(f) for f in schemas.SUCCESS.fields])


def sample_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows by key, for the run log."""
    return df.orderBy(key).limit(n)
