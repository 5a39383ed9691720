"""Removal of repeated passages by overlapping windows of three lines.

Every three consecutive lines are hashed. Windows that occur once more anywhere, in the same document or another,
are found by counting hashes; of a repeated window, every occurrence but the first in order goes. The positions
that the later occurrences cover are merged to intervals, and each document keeps the lines between them.

A line that goes always has an earlier line like it, and the first of those stays: content is lost from no corpus.

Rules
* Lines are cut at ``\\n`` only; a window is the exact text of ``WINDOW`` lines, so texts with fewer lines keep all.
  Windows without a letter or digit count like others.
* Order of occurrences: id (null last), then the rows as stored (file by name, place in it), then position.
* Null text: no lines, stays null. Repeated ids are different rows. Other columns are kept as they are; names may
  clash. An empty table gives an empty table.
* Keys are 128-bit hashes. Counts are combined on the map side and the join on keys can be split, so a line that
  a third of the documents share is no hot key; a document's intervals are no longer than the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageflow.llm.common import bounded, numbered, staged

WINDOW = 3
ROW_BYTES = 120  # a broadcast row of intervals, without the intervals


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _window_keys(lines: Column, window: int) -> Column:
    """128-bit hashes of every ``window`` consecutive lines, in order."""
    starts = F.when(F.size(lines) >= window, F.sequence(F.lit(0), F.size(lines) - window)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.unhex(F.md5(F.array_join(F.slice(lines, i + 1, window), "\n").cast("binary"))))


def windows(rows: DataFrame, window: int) -> DataFrame:
    """``row, id, pos, key``: one row per window of ``rows`` (``row, id, text``)."""
    keyed = rows.where(F.col("text").isNotNull()).select("row", "id", _window_keys(_lines(F.col("text")), window).alias("keys"))
    return keyed.select("row", "id", F.posexplode("keys").alias("pos", "key"))


def later_occurrences(found: DataFrame, work: str) -> DataFrame:
    """``row, pos`` of the windows whose key occurs earlier."""
    repeated = staged(found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), f"{work}/repeated")
    shared = staged(found.join(repeated, "key", "left_semi"), f"{work}/shared")
    first = shared.groupBy("key").agg(F.min(F.struct(F.col("id").isNull(), "id", "row", "pos")).alias("first"))
    first = staged(first.select("key", F.col("first.row").alias("first_row"), F.col("first.pos").alias("first_pos")), f"{work}/first")
    return shared.join(first, "key").where("row <> first_row or pos <> first_pos").select("row", "pos")


def merged_intervals(later: DataFrame, window: int) -> DataFrame:
    """``row, gone``: a row's covered lines as sorted, disjoint ``(begin, end)``, end exclusive."""
    order = Window.partitionBy("row").orderBy("pos")
    opens = F.coalesce(F.col("pos") > F.lag("pos").over(order) + window, F.lit(True))
    numbered = later.withColumn("run", F.sum(opens.cast("int")).over(order))
    runs = numbered.groupBy("row", "run").agg(F.min("pos").alias("begin"), (F.max("pos") + window).alias("end"))
    return runs.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("gone"))


def _kept_lines(lines: Column, gone: Column) -> Column:
    """The lines outside ``gone``: slices from the end of one interval to the beginning of the next."""
    froms = F.concat(F.array(F.lit(0)), F.transform(gone, lambda g: g["end"]))
    tos = F.concat(F.transform(gone, lambda g: g["begin"]), F.array(F.size(lines)))
    return F.flatten(F.transform(F.arrays_zip(froms.alias("a"), tos.alias("b")), lambda x: F.slice(lines, x["a"] + 1, x["b"] - x["a"])))


def dedup_lines(docs: DataFrame, work: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc`` (the input row as a struct), ``text`` without repeated passages, ``n_lines``, ``n_removed``, ``gone``.

    ``docs`` is a stored table. Nothing but keys and positions is shuffled unless the intervals outgrow a broadcast.
    """
    whole = numbered(docs, F.struct("*").alias("doc"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = staged(windows(whole.select("row", "id", "text"), window), f"{work}/windows")
    gone = staged(merged_intervals(later_occurrences(found, work), window), f"{work}/intervals")
    size = gone.agg(F.count("*"), F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()
    joined = whole.join(bounded(gone, size[0] * ROW_BYTES + size[1] * 40), "row", "left")
    lines = _lines(F.col("text"))
    removed = F.coalesce(F.aggregate("gone", F.lit(0), lambda n, g: n + g["end"] - g["begin"]), F.lit(0))
    return joined.select(
        "doc",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(_kept_lines(lines, F.col("gone")), "\n")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        removed.cast("long").alias("n_removed"),
        F.coalesce("gone", F.array().cast("array<struct<begin:int,end:int>>")).alias("gone"),
    )
