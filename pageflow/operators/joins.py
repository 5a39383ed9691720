"""Joins whose probe side may be dominated by one key, and joins whose probe side must not move."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.settings import DEFAULTS

_SALT, _PART = "_salt", "_part"

# Entries that are broadcast as they are where the caller knows how many there are: at some hundred bytes each, tens of megabytes.
PLAIN_ROWS = 100_000
# Of a sketch of keys: how many are named, and how many it keeps track of.
HEAVY_KEYS, TRACKED_KEYS = 64, 4096
# A key is heavy if it has more than this share of the rows.
HEAVY_SHARE = 1 / 200


def key_sketch(keys: Sequence[str]) -> Column:
    """An aggregate that names the most frequent keys (by hash) with their counts; it can be observed while rows are written."""
    hashed = ", ".join(f"`{k}`" for k in keys)
    return F.expr(f"approx_top_k(xxhash64({hashed}), {HEAVY_KEYS}, {TRACKED_KEYS})")


def heavy_of(sketch: list | None, rows: int) -> list[int]:
    """Hashes of the keys that a sketch of ``rows`` rows shows to be heavy."""
    return [r["item"] for r in sketch or [] if r["item"] is not None and r["count"] > HEAVY_SHARE * rows]


def heavy_keys(rows: DataFrame, keys: Sequence[str]) -> list[int]:
    """Hashes of the heavy keys of ``rows``, by a pass over them. Cheaper: observe ``key_sketch`` in the pass that writes them."""
    found = rows.agg(key_sketch(keys).alias("sketch"), F.count("*").alias("n")).first()
    return heavy_of(found.sketch, found.n)


def lookup(
    rows: DataFrame,
    entries: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str] = (),
    how: str = "left",
    buckets: int = DEFAULTS.lookup_buckets,
    entry_rows: int | None = None,
    heavy: Sequence[int] = (),
) -> DataFrame:
    """Join ``rows`` to ``entries`` that are unique on ``keys``, however the keys of ``rows`` are spread.

    Nothing is counted here. Where the caller knows that there are few entries (``entry_rows``, or a bound of it), they are
    broadcast. Where it knows heavy keys of ``rows`` (``heavy``, hashes from ``key_sketch``), each of these is spread over
    ``buckets`` tasks by ``spread_by`` (columns that differ between the rows of one key), and the entries of these keys, no
    others, are sent to all of them. Otherwise Spark picks the join by the size of the tables, and splits large partitions
    at run time. Null keys match nothing.
    """
    if entry_rows is not None and entry_rows <= PLAIN_ROWS:
        return rows.join(F.broadcast(entries), list(keys), how).select(*_columns(rows, entries, keys, how))
    if not heavy:
        return rows.join(entries, list(keys), how).select(*_columns(rows, entries, keys, how))
    is_heavy = F.xxhash64(*keys).isin(*heavy)
    salt = F.when(is_heavy, F.pmod(F.xxhash64(*spread_by), F.lit(buckets)).cast("int")).otherwise(F.lit(0))
    salts = F.explode(F.when(is_heavy, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0))))
    # Spark takes the copies for as small as the originals, so they are kept from being broadcast.
    return (
        rows.withColumn(_SALT, salt)
        .join(entries.withColumn(_SALT, salts).hint("merge"), [*keys, _SALT], how)
        .select(*_columns(rows, entries, keys, how))
    )


def probe_in_place(rows: DataFrame, entries: DataFrame, keys: Sequence[str], how: str, parts: int) -> DataFrame:
    """Join wide ``rows`` to ``entries`` without moving a row: ``entries`` are broadcast, in ``parts`` by key if they are many.

    ``rows`` are scanned once for each part. Null keys match nothing.
    """
    if parts <= 1:
        return rows.join(F.broadcast(entries), list(keys), how).select(*_columns(rows, entries, keys, how))
    part = F.pmod(F.xxhash64(*keys), F.lit(parts))
    joined = [
        rows.where(part == n).join(F.broadcast(entries.where(part == n)), list(keys), how).select(*_columns(rows, entries, keys, how))
        for n in range(parts)
    ]
    return reduce(DataFrame.unionAll, joined)


def _columns(rows: DataFrame, entries: DataFrame, keys: Sequence[str], how: str) -> list[str]:
    added = [] if how in ("left_anti", "left_semi") else [c for c in entries.columns if c not in keys]
    return [*rows.columns, *added]
