"""Conflict-constrained best-fit packing of documents into sequences of fixed length.

Documents are cut into pieces of at most ``capacity`` words; a full piece is a sequence of its own. The other pieces
are dealt into shards of about ``SHARD_ROWS`` rows by a hash of the row, so that no source or cluster is a hot key,
and each shard is packed by best fit, longest pieces first: the open bins are kept in order of the room they have
left, with bitmaps of the sources (one for each document that a source may have in a bin) and of the duplicate
clusters they hold. From the tightest bin with room, the search goes on to the next larger one until it meets one
without a conflict. Only lengths and keys are shuffled.

Rules
* A bin holds at most ``per_source`` pieces of a source (null is one source) and one of a cluster (a null cluster
  conflicts with none). Ties: lower bin number; equal pieces by id (null last), piece and row.
* A document without words (or null text) gives one row without a bin. Each other document gives its pieces; their
  words add up to the document's. Repeated ids are different documents. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.llm.common import SPACE, WORD, staged, whole_text

CAPACITY = 2048
PER_SOURCE = 2
SHARD_ROWS = 8192


def text_cluster(text: Column | str) -> Column:
    """One key for texts alike but for case and white space."""
    return F.xxhash64(F.lower(F.regexp_replace(whole_text(text), f"{SPACE}+", " ")))


class Bins:
    """Open bins in order of the room left."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.open: list[tuple[int, int]] = []  # (room, bin)
        self.sources: list[list[int]] = []  # of each bin: bitmaps of sources held once, twice, ...
        self.clusters: list[int] = []  # of each bin: bitmap of clusters held
        self.used: list[int] = []

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """``(bin, offset)`` for a piece; ``cluster`` is a bit number, or -1 for one that conflicts with none."""
        source_bit, cluster_bit = 1 << source, 1 << cluster if cluster >= 0 else 0
        at = bisect_left(self.open, (length, -1))
        while at < len(self.open):
            number = self.open[at][1]
            if not (self.sources[number][-1] & source_bit or self.clusters[number] & cluster_bit):
                room, _ = self.open.pop(at)
                break
            at += 1
        else:
            number, room = len(self.used), self.capacity
            self.sources.append([0] * self.per_source)
            self.clusters.append(0)
            self.used.append(0)
        planes = self.sources[number]
        planes[next(i for i, plane in enumerate(planes) if not plane & source_bit)] |= source_bit
        self.clusters[number] |= cluster_bit
        offset = self.used[number]
        self.used[number] += length
        if room > length:
            insort(self.open, (room - length, number))
        return number, offset


def pack(lengths: Sequence[int], sources: Sequence[int], clusters: Sequence[int], capacity: int, per_source: int) -> list[tuple[int, int]]:
    """``(bin, offset)`` of pieces in the given order."""
    bins = Bins(capacity, per_source)
    return [bins.place(*piece) for piece in zip(lengths, sources, clusters)]


def _bits(keys: Sequence) -> list[int]:
    """A bit number for each key that occurs twice or more, else -1."""
    counts = Counter(keys)
    numbers = {k: i for i, k in enumerate(k for k, n in counts.items() if n > 1)}
    return [numbers.get(k, -1) for k in keys]


def pack_documents(
    docs: DataFrame,
    work: str,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cluster: Column | None = None,
) -> DataFrame:
    """``id, piece, start, n_words, bin, offset``: where each piece of each document goes. ``work``: a shared folder.

    ``bin`` is unique over all shards; ``start`` counts words in the document, ``offset`` words in the bin.
    """
    cluster = text_cluster(text_col) if cluster is None else cluster
    slim = staged(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            F.regexp_count(whole_text(text_col), F.lit(WORD)).cast("long").alias("size"),
            F.xxhash64(F.col(source_col).cast("string"), F.col(source_col).isNull()).alias("source"),
            F.coalesce(
                F.when(cluster.isNotNull(), F.xxhash64(cluster)), F.xxhash64(F.monotonically_increasing_id(), F.lit("alone"))
            ).alias("cluster"),
        ),
        f"{work}/pieces",
    )
    shards = -(-slim.count() // SHARD_ROWS) or 1
    full = F.expr(f"size div {capacity}")
    empty = slim.where("size = 0").select(
        "id", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast("string").alias("bin"), F.lit(None).cast("long").alias("offset"),
    )
    whole = slim.withColumn("full", full).where("full > 0").withColumn("piece", F.explode(F.expr("sequence(0L, full - 1)"))).select(
        "id", "piece", (F.col("piece") * capacity).alias("start"), F.lit(capacity).cast("long").alias("n_words"),
        F.concat_ws("-", F.lit("whole"), "row", "piece").alias("bin"), F.lit(0).cast("long").alias("offset"),
    )
    rest = slim.withColumn("piece", full).withColumn("n_words", F.col("size") % capacity).where("n_words > 0").select(
        F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), "row", "id", "piece", "n_words", "source", "cluster"
    )
    kind = rest.schema["id"].dataType.simpleString()

    def pack_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_words", "rank", "piece", "row"], ascending=[False, True, True, True], kind="stable")
        sources = {s: i for i, s in enumerate(dict.fromkeys(rows["source"]))}
        placed = pack(rows["n_words"].tolist(), [sources[s] for s in rows["source"]], _bits(rows["cluster"].tolist()), capacity, per_source)
        return pd.DataFrame({"row": rows["row"], "bin": [f"{key[0]}-{b}" for b, _ in placed], "offset": [o for _, o in placed]})

    # Python gets numbers only; ids of another type are ordered by their hash.
    number = F.col("id").cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64("id")
    ranked = rest.withColumn("rank", F.when(F.col("id").isNull(), F.lit((1 << 63) - 1)).otherwise(number))
    placed = ranked.select("shard", "row", "rank", "piece", "n_words", "source", "cluster").groupBy("shard").applyInPandas(
        pack_shard, "row long, bin string, offset long"
    )
    packed = rest.join(placed, "row").select("id", "piece", (F.col("piece") * capacity).alias("start"), "n_words", "bin", "offset")
    return empty.unionByName(whole).unionByName(packed)
