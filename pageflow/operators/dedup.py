"""Duplicate keys: keep one row, audit the rest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_one_per_key(
    df: DataFrame, key: str | Sequence[str], order: Sequence[str], null_by: Sequence[str] = ()
) -> DataFrame:
    """One row per key, the smallest by ``order`` (then by the remaining columns).

    Null is one key, unless ``null_by`` names the columns that tell rows with a null in the key apart.

    A minimum over structs rather than a window: copies of a key are folded into one row before the
    shuffle, so a key with a third of all rows costs no more than any other.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if null_by:
        missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys])
        told_apart = df.withColumn("_apart", F.when(missing, F.concat_ws(" ", *null_by)))
        return keep_one_per_key(told_apart, [*keys, "_apart"], order).drop("_apart")
    ranked = [*order, *[c for c in df.columns if c not in keys and c not in order]]
    best = F.min(F.struct(*ranked)).alias("_best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )


def key_audit(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys (null counts as one) and the difference, as one row.

    Counting per key first keeps the distinct count exact and its state spread over the cluster.
    """
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("row_count"),
        F.count("*").alias("distinct_count"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count("*")).cast("long").alias("duplicate_count"),
    )
