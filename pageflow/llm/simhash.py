"""Near duplicates by SimHash, with links found through Golay-code keys.

A fingerprint has 64 bits: the majority of the hashes of a text's word shingles, bit by bit. It is cut into three
segments of at most 23 bits. Two fingerprints that differ in two bits have a segment without an error that is
followed, in a circle, by one with one error at most. So each fingerprint gets keys of an exact segment and of the
indexes of the Golay codewords near the next one (one or six of them), and fingerprints meet in the buckets of these
keys, where they are verified.

Equal fingerprints are one node. Buckets of up to ``SMALL_BUCKET`` nodes are compared pair by pair. In larger ones
no pairs are made: two words within two bits have a common word within one bit of both, so each node of the bucket
is put under itself and its neighbours in the bits that may differ, and all nodes under one word are linked to the
least. That is as exact and grows with the number of nodes, however large a group of near copies is.

Rules
* Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A text with fewer words than a shingle is one shingle; a
  text without words (or null) has fingerprint zero and is linked like any other.
* Repeated ids are different documents in one class. A null id stays null and counts as the largest. An empty table
  gives no rows. Other columns and clashing names play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow.llm import golay
from pageflow.llm.common import staged, whole_text
from pageflow.llm.components import components

SHINGLE = 3
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and bits; each followed by the next, the last by the first
RADIUS = 2
SMALL_BUCKET = 32
VOTES = 1 << 15  # hashes whose bits are counted at once


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included."""
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends - 1).tolist()[size - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(stops))


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have, as a signed number."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), VOTES):
        raw = hashes[at : at + VOTES].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id, fp`` (signed 64 bits) for every row."""
    slim = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [majority(shingle_hashes(words_of(t), shingle)) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(found, pa.int64())], ["id", "fp"])

    return slim.mapInArrow(hashed, T.StructType([slim.schema["id"], T.StructField("fp", T.LongType())]))


def bucket_keys(nodes: DataFrame) -> DataFrame:
    """``key, fp`` for each different key of each ``fp``: segment number, exact segment, codeword index."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch["fp"].to_numpy()
            bits = fp.view(np.uint64)
            parts = [(bits >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
            for number in range(len(SEGMENTS)):
                following = (number + 1) % len(SEGMENTS)
                index = np.sort(golay.nearby(parts[following], SEGMENTS[following][1]), axis=1)
                new = np.ones(index.shape, bool)
                new[:, 1:] = index[:, 1:] != index[:, :-1]
                row, column = np.nonzero(new)
                keys = (number << 60) | (parts[number][row] << golay.DATA) | index[row, column]
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[row])], ["key", "fp"])

    return nodes.select("fp").mapInArrow(keyed, "key long, fp long")


def _segment_mask(number: Column) -> Column:
    """The bits of a key's exact segment: they are equal in the whole bucket."""
    masks = [((1 << n) - 1) << at for at, n in SEGMENTS]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    return F.element_at(F.array(*(F.lit(m).cast("long") for m in signed)), number.cast("int") + 1)


def bucket_links(keys: DataFrame, work: str) -> DataFrame:
    """Links ``a, b`` between fingerprints within ``RADIUS`` bits that share a bucket, enough to connect all such."""
    sizes = keys.groupBy("key").agg(F.count("*").alias("n"))
    sizes = staged(sizes.where("n > 1"), f"{work}/sizes")
    small = keys.join(sizes.where(F.col("n") <= SMALL_BUCKET).select("key"), "key")
    pairs = small.join(small.select("key", F.col("fp").alias("other")), "key").where("fp < other")
    near = pairs.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= RADIUS).select(F.col("fp").alias("a"), F.col("other").alias("b"))

    large = keys.join(sizes.where(F.col("n") > SMALL_BUCKET).select("key"), "key")
    fixed = _segment_mask(F.shiftright("key", 60))
    bits = F.array(F.lit(0).cast("long"), *(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64)))
    free = F.filter(bits, lambda b: b.bitwiseAND(fixed) == 0)
    around = large.select("fp", F.explode(F.transform(free, lambda b: F.col("fp").bitwiseXOR(b))).alias("word")).distinct()
    least = around.groupBy("word").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    stars = around.join(least.select("word", "b"), "word").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return near.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, work: str, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id, fp, component``: the smallest id that can be reached over links. ``work``: a shared folder."""
    rows = staged(fingerprints(docs, id_col, text_col, shingle), f"{work}/fingerprints")
    nodes = staged(rows.groupBy("fp").agg(F.min("id").alias("least")), f"{work}/nodes")
    keys = staged(bucket_keys(nodes), f"{work}/keys")
    roots = staged(components(bucket_links(keys, work), f"{work}/components"), f"{work}/roots")
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    classes = rooted.groupBy("root").agg(F.min("least").alias("component"))
    member = staged(rooted.join(classes, "root").select("fp", "component"), f"{work}/members")
    return rows.join(member, "fp").select("id", "fp", "component")
