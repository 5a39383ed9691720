"""Mixing of sources to target weights.

The words of each source, its documents in pseudorandom order, are packed into blocks of ``BLOCK`` words. A source's
target decides how many block slots it gets. All slots of all sources are put into output shards of ``SHARD_SLOTS``
slots by a pseudorandom permutation; a shard's counts by source are thus a multinomial draw under the condition that
the totals hold, so no target and no cap is missed by chance. The slots of a source run through its blocks along
pseudorandom permutations of the block numbers, a new one for each pass, and are joined with the blocks by number.
The last slot of a source is cut so that the words taken equal the target, rounded.

Permutations are swap-or-not shuffles: any domain, a few rounds of hashes, each number on its own; nothing is sorted
to permute. Prefix sums run in buckets of a source, so a source with a third of all rows is spread as well.

Rules
* Size: words ``[^\\x20\\x09-\\x0D]+`` of the text, null: 0. Sources by code point, null last, as one source each.
* Weights repeat along the sources. Targets share ``SHARE`` of all sizes; a target stops at ``CAP`` times its source's
  size and the excess is reshared by weight.
* Rerun on the same table, the mix is the same. The order of documents follows ids and texts; rows alike in all
  that matters (id, source, text) are interchangeable. Documents without words are never taken.
* One row for each input row; an empty table gives none. Other columns and clashing names play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageflow.llm.common import WORD, numbered, staged, whole_text

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BLOCK = 256
SHARD_SLOTS = 4096
ROUNDS = 24
BUCKET_ROWS = 4_000
CHUNK = 1 << 16  # slots of a source are generated in chunks


def permuted(x: Column, n: Column, *seed: Column, inverse: bool = False) -> Column:
    """The image of ``x`` under a pseudorandom permutation of ``0 .. n - 1`` (swap-or-not shuffle)."""
    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def swap(at: Column, turn: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(turn, *seed), n) - at, n)
        swapped = F.xxhash64(F.greatest(at, partner), turn, *seed).bitwiseAND(F.lit(1)) == 1
        return F.when(swapped, partner).otherwise(at)

    return F.aggregate(rounds, x.cast("long"), swap)


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``sources`` (one row each: ``source, source_size``) with ``number`` and ``target``.

    With sources in order of cap by weight, the level at which the rest shares what the capped ones leave grows
    until the first one that is not capped: the largest level is the one that holds.
    """
    number = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("number") % len(weights) + 1).cast("double")
    limit = F.lit(float(cap)) * F.col("source_size")
    before = Window.orderBy(limit / F.col("weight"), "number").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    level = (F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    return (
        sources.withColumn("number", number)
        .withColumn("weight", weight)
        .withColumn("level", level)
        .withColumn("target", F.least(limit, F.max("level").over(every) * F.col("weight")))
        .drop("weight", "level")
    )


@dataclass(frozen=True)
class Mix:
    """``rows``: ``row, id, size, source_size, target``, one per document.

    ``uses``: ``row, shard, place, turn, first, last``, one per slot and document that the slot takes words from:
    words ``first .. last - 1`` of the document on the source's pass ``turn``.
    """

    rows: DataFrame
    uses: DataFrame


def _streams(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with words and ``start``: where the document begins among the words of its source."""
    buckets = (F.col("n_rows") / BUCKET_ROWS).cast("int") + 1
    placed = (
        rows.where("size > 0")
        .join(sources.select("source", "number", buckets.alias("buckets")), F.expr("source <=> src"))
        .select("row", "id", "order", "size", "number", F.pmod(F.xxhash64("order", "row"), F.col("buckets")).alias("bucket"))
    )
    sums = placed.groupBy("number", "bucket").agg(F.sum("size").alias("bucket_size"))
    along = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("number", "bucket", F.coalesce(F.sum("bucket_size").over(along), F.lit(0)).alias("bucket_start"))
    inside = Window.partitionBy("number", "bucket").orderBy("order", "id", "row").rowsBetween(Window.unboundedPreceding, -1)
    within = placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return within.join(starts, ["number", "bucket"]).select("row", "size", "number", (F.col("bucket_start") + F.col("inside")).alias("start"))


def _pieces(streams: DataFrame) -> DataFrame:
    """``number, block, row, first, at, words``: a document's words in each block that it reaches."""
    start, end = F.col("start"), F.col("start") + F.col("size")
    blocks = F.sequence(F.floor(start / BLOCK), F.floor((end - 1) / BLOCK))
    reached = streams.withColumn("block", F.explode(blocks))
    begin = F.greatest(start, F.col("block") * BLOCK)
    stop = F.least(end, (F.col("block") + 1) * BLOCK)
    return reached.select(
        "number", "block", "row", (begin - start).alias("first"), (begin - F.col("block") * BLOCK).alias("at"), (stop - begin).alias("words")
    )


def _budgets(sources: DataFrame) -> DataFrame:
    """Blocks and slots of each source that is taken from."""
    short_at = permuted(F.col("blocks") - 1, F.col("blocks"), F.col("number"), F.col("passes"), inverse=True)
    rest, full = F.col("rest"), F.col("short_at") * BLOCK
    partial = (
        F.when(rest <= full, F.ceil(rest / BLOCK))
        .when(rest <= full + F.col("short"), F.col("short_at") + 1)
        .otherwise(F.col("short_at") + 1 + F.ceil((rest - full - F.col("short")) / BLOCK))
    )
    along = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sources.where("source_size > 0")
        .withColumn("words", F.floor(F.col("target") + 0.5))
        .withColumn("blocks", F.ceil(F.col("source_size") / BLOCK))
        .withColumn("short", F.col("source_size") - (F.col("blocks") - 1) * BLOCK)
        .withColumn("passes", F.expr("words div source_size"))
        .withColumn("rest", F.col("words") % F.col("source_size"))
        .withColumn("short_at", short_at)
        .withColumn("slots", F.col("passes") * F.col("blocks") + partial)
        .withColumn("slot_start", F.coalesce(F.sum("slots").over(along), F.lit(0)))
        .withColumn("all_slots", F.sum("slots").over(Window.partitionBy(F.lit(0))))
    )


def _slots(budgets: DataFrame) -> DataFrame:
    """``number, block, turn, take, shard, place``: one row per slot that takes words."""
    chunks = budgets.where("slots > 0").withColumn("chunk", F.explode(F.expr(f"sequence(0L, (slots - 1) div {CHUNK})")))
    # As many partitions as chunks: a few tiny rows, of which Spark would make one task, grow to all slots here.
    slots = chunks.repartition(max(1, chunks.count()), "number", "chunk").withColumn(
        "slot", F.explode(F.sequence(F.col("chunk") * CHUNK, F.least(F.col("slots"), (F.col("chunk") + 1) * CHUNK) - 1))
    )
    turn, step = F.expr("slot div blocks"), F.col("slot") % F.col("blocks")
    block = permuted(F.col("step"), F.col("blocks"), F.col("number"), F.col("turn"))
    length = F.when(F.col("block") == F.col("blocks") - 1, F.col("short")).otherwise(BLOCK)
    before = F.col("step") * BLOCK - F.when(F.col("step") > F.col("short_at"), BLOCK - F.col("short")).otherwise(0)
    left = F.when(F.col("turn") < F.col("passes"), length).otherwise(F.greatest(F.lit(0), F.least(length, F.col("rest") - before)))
    seat = permuted(F.col("slot_start") + F.col("slot"), F.col("all_slots"), F.lit("shards"))
    return (
        slots.withColumn("turn", turn)
        .withColumn("step", step)
        .withColumn("block", block)
        .withColumn("take", left)
        .withColumn("seat", seat)
        .select(
            "number", "block", "turn", "take", F.expr(f"seat div {SHARD_SLOTS}").alias("shard"), (F.col("seat") % SHARD_SLOTS).alias("place")
        )
    )


def mix(docs: DataFrame, work: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Mix:
    """Plan the mix of all ``docs``; a stored table; ``row`` is that of ``numbered``. ``work``: a shared folder."""
    text = whole_text(text_col)
    slim = staged(
        numbered(
            docs,
            F.col(id_col).alias("id"),
            F.col(source_col).cast("string").alias("src"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            F.xxhash64(F.col(id_col), text).alias("order"),
        ),
        f"{work}/sizes",
    )
    sums = slim.groupBy(F.col("src").alias("source")).agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    sources = staged(source_targets(sums), f"{work}/sources")
    pieces = _pieces(_streams(slim, sources))
    # A table of its own: what generators make of a few sources must not pass for a small side of the join.
    slots = staged(_slots(_budgets(sources)), f"{work}/slots")
    last = F.least(F.col("at") + F.col("words"), F.col("take")) - F.col("at") + F.col("first")
    uses = slots.join(pieces, ["number", "block"]).select("row", "shard", "place", "turn", "first", last.alias("last"))
    rows = slim.join(sources.select("source", "source_size", "target"), F.expr("source <=> src"))
    return Mix(rows.select("row", "id", "size", "source_size", "target"), uses.where("last > first"))


def taken_words(mixed: Mix) -> DataFrame:
    """``mixed.rows`` with ``taken``: the words that the mix takes from each document, repeats counted."""
    taken = mixed.uses.groupBy("row").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    return mixed.rows.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def mixed_texts(docs: DataFrame, mixed: Mix, text_col: str = "text") -> DataFrame:
    """``doc`` (the input row as a struct), ``turn`` and ``text``: a row for each pass that takes words of a document.

    A document that a pass takes whole keeps its text as it is; of others the taken words stay, with the white
    space behind them.
    """
    runs = mixed.uses.groupBy("row", "turn").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"), F.sum(F.col("last") - F.col("first")).alias("taken"))
    whole = numbered(docs, F.struct("*").alias("doc"), F.col(text_col).alias("whole"))
    sizes = mixed.rows.select("row", "size")
    joined = whole.join(runs.join(sizes, "row"), "row")
    words = F.regexp_extract_all("whole", F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0))
    part = F.flatten(F.transform("runs", lambda r: F.slice(words, (r["first"] + 1).cast("int"), (r["last"] - r["first"]).cast("int"))))
    return joined.select("doc", "turn", F.when(F.col("taken") == F.col("size"), F.col("whole")).otherwise(F.array_join(part, "")).alias("text"))
