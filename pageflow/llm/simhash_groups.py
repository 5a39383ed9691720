"""Groups of similar documents: SimHash candidates over Golay-code keys, verified on word shingles.

Two documents are similar if their sets of five-word shingles have a Jaccard similarity of 0.8 or more. One changed
word costs five shingles but one word, so candidates come from fingerprints over the set of words: ``PRINTS``
independent ones of 64 bits. Documents meet in a bucket if, in one fingerprint, a segment is equal and the next one
shares a Golay codeword index (at most one bit apart).

Texts alike but for case and white space are one node. Buckets stream through tasks in order. In a bucket of up to
``SMALL_BUCKET`` different fingerprints all of them are compared. In a larger one each node is compared with the
bucket's most central node and with its nearest one, block by block, a block's centre being carried on; nodes with
one fingerprint are compared with the first of them. That connects most of a large group with few candidates, and is
not the whole answer: chance, and what these comparisons leave out, cost links.

The second pass is complete. The prefix filter (``prefix_join``) over the shingle sets finds every pair of the
similarity or more that the first pass has not connected. All candidates are verified on whole shingle sets, so
groups are neither too wide nor too narrow. The sets are files in the shared, mounted folder, which workers memory-map.

Rules: as in ``simhash``; texts with fewer than five words are one shingle, texts without words are one node.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow.llm import golay, prefix_join
from pageflow.llm import hash_arrays as H
from pageflow.llm.common import bounded, drop_staged, numbered, staged, whole_text
from pageflow.llm.components import components
from pageflow.llm.simhash import SEED, SEGMENTS, shingle_hashes, words_of

SHINGLE = 5
SIMILARITY = 0.8
PRINTS = 8
SMALL_BUCKET = 4
FILE_SHINGLES = 1 << 21  # of a file of sets
MAPPED = 512  # files of sets that a worker keeps open
SEEN = 200_000  # pairs that a task remembers before it starts anew
BLOCK = 2048  # nodes of a bucket that are compared with each other at once
PREFIX_ROWS = 1 << 14  # of a batch, so that a task needs little memory
ORDER_NODES = 4096  # whose shingles are counted, about, for the order of the prefix filter
ORDER_SHINGLES = 1 << 18  # most frequent ones that are told apart from rare ones


def _spread(hashes: np.ndarray, number: int) -> np.ndarray:
    """Independent hashes from one (the finalizer of splitmix64)."""
    x = hashes + np.uint64(0x9E3779B97F4A7C15 * (number + 1) & (1 << 64) - 1)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def word_prints(words: list[bytes], prints: int = PRINTS) -> np.ndarray:
    """``prints`` fingerprints (signed) of the set of words."""
    digest = xxhash.xxh64_intdigest
    distinct = set(words)
    hashes = np.fromiter((digest(w, SEED) for w in distinct), np.uint64, len(distinct))
    found = []
    for number in range(prints):
        counts = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 15):
            raw = _spread(hashes[at : at + (1 << 15)], number).astype("<u8").view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        found.append(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])
    return np.array(found, np.int64)


def print_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, key, print)`` of all bucket keys of an array with a row of fingerprints per node."""
    rows, keys, held = [], [], []
    for number in range(prints.shape[1]):
        own = prints[:, number]
        bits = own.view(np.uint64)
        parts = [(bits >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
        for segment in range(len(SEGMENTS)):
            following = (segment + 1) % len(SEGMENTS)
            index = np.sort(golay.nearby(parts[following], SEGMENTS[following][1]), axis=1)
            new = np.ones(index.shape, bool)
            new[:, 1:] = index[:, 1:] != index[:, :-1]
            row, column = np.nonzero(new)
            family = np.int64(number * len(SEGMENTS) + segment)
            rows.append(row)
            keys.append(family << 40 | parts[segment][row] << golay.DATA | index[row, column])
            held.append(own[row])
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(held)


def _lead_key(prints: np.ndarray, family: int) -> np.ndarray:
    """Of all keys of a fingerprint (of ``family``'s number), the one in whose bucket nodes of one fingerprint are compared.

    They share every bucket of it, with the same first node, so one is enough.
    """
    bits = prints.view(np.uint64)
    parts = [(bits >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS[:2]]
    index = golay.nearby(parts[1], SEGMENTS[1][1]).min(axis=1)
    first = np.int64(family - family % len(SEGMENTS))
    return first << 40 | parts[0] << golay.DATA | index


def block_pairs(nodes: np.ndarray, prints: np.ndarray, key: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Candidate pairs among the nodes of a block, each once, and the place of its centre.

    Nodes with one fingerprint are compared with the first of them, which alone meets other fingerprints; in the bucket of
    their lead key, if ``key`` is given. Of equally near ones the first is taken, in all buckets: the same pair is then found
    again, not another one.
    """
    distinct, first, group = np.unique(prints, return_index=True, return_inverse=True)
    raw = distinct.astype("<i8").view(np.uint8).reshape(-1, 8)
    held = np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64) * 2 > len(distinct)
    middle = np.packbits(held, bitorder="little").view("<i8")[0]
    centre = int(first[np.argmin(np.bitwise_count((distinct ^ middle).view(np.uint64)))])
    order = np.sort(first)
    n = len(order)
    if n <= SMALL_BUCKET:
        a, b = np.triu_indices(n, 1)
        a, b = order[a], order[b]
    else:
        own = prints[order]
        apart = np.bitwise_count((own[:, None] ^ own).view(np.uint64)).astype(np.uint8)
        np.fill_diagonal(apart, 255)
        a, b = np.tile(order, 2), np.concatenate([order[np.argmin(apart, axis=1)], np.full(n, centre)])
    later = np.flatnonzero(first[group] != np.arange(len(nodes)))
    if key is not None and len(later):
        later = later[_lead_key(prints[later], int(key) >> 40) == key]
    a, b = np.concatenate([later, a]), np.concatenate([first[group][later], b])
    # Two that are each other's nearest, or one whose nearest is the centre, make one pair.
    pair = np.unique(np.maximum(a, b) * len(nodes) + np.minimum(a, b))
    return nodes[pair // len(nodes)], nodes[pair % len(nodes)], centre


def _bucket_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates from rows sorted by key; at most a block of a bucket is held."""
    key, nodes, prints = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen: set[tuple[int, int]] = set()  # pairs of other buckets of this task

    def compared(carry: bool):
        nonlocal nodes, prints
        a, b, centre = block_pairs(nodes, prints, key)
        nodes, prints = (nodes[centre : centre + 1], prints[centre : centre + 1]) if carry else (nodes[:0], prints[:0])
        a, b = np.maximum(a, b), np.minimum(a, b)
        fresh = [x != y and not ((x, y) in seen or seen.add((x, y))) for x, y in zip(a.tolist(), b.tolist())]
        if len(seen) > SEEN:
            seen.clear()
        fresh = np.array(fresh, bool)
        return pa.RecordBatch.from_arrays([pa.array(a[fresh]), pa.array(b[fresh])], ["a", "b"])

    for batch in batches:
        keys, own, held = (batch[c].to_numpy() for c in ("key", "node", "print"))
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
        single = np.diff(cuts) == 1
        for i in range(len(cuts) - 1):
            first, last = int(cuts[i]), int(cuts[i + 1])
            if keys[first] != key:
                if len(nodes) > 1:
                    yield compared(False)
                key, nodes, prints = keys[first], nodes[:0], prints[:0]
                if single[i] and i < len(cuts) - 2:
                    continue  # a bucket of one node
            for at in range(first, last, BLOCK):
                stop = min(last, at + BLOCK)
                nodes, prints = np.concatenate([nodes, own[at:stop]]), np.concatenate([prints, held[at:stop]])
                if len(nodes) >= BLOCK:
                    yield compared(True)
    if len(nodes) > 1:
        yield compared(False)


def _shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """``node, shingles``: the distinct shingles of each ``node, text``."""

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(words_of(t.as_py()), shingle)).view(np.int64) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return texts.select("node", "text").mapInArrow(shingled, "node long, shingles array<long>")


def _write_sets(texts: DataFrame, folder: str, shingle: int) -> DataFrame:
    """``node, file, begin, size``: where in files below ``folder`` the distinct shingles of each ``node, text`` are, sorted.

    Workers memory-map the files, so a set is written once, however many pairs it is in, and none is shuffled.
    """
    folder, names = H.local_path(folder), ["node", "file", "begin", "size"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, sets, held = [], [], 0

        def close():
            file = uuid.uuid4().hex  # an attempt's own: rows name the file of the attempt that counts
            H.write_arrays(f"{folder}/{file}", shingles=np.concatenate(sets))
            sizes = np.array([len(s) for s in sets], np.int64)
            columns = [pa.array(nodes, pa.int64()), pa.array([file] * len(nodes)), pa.array(np.cumsum(sizes) - sizes), pa.array(sizes)]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for node, text in zip(batch["node"].to_pylist(), batch["text"]):
                nodes.append(node)
                sets.append(np.unique(shingle_hashes(words_of(text.as_py()), shingle)))
                held += len(sets[-1])
                if held >= FILE_SHINGLES:
                    yield close()
                    nodes, sets, held = [], [], 0
        if nodes:
            yield close()

    return texts.select("node", "text").mapInArrow(write, "node long, file string, begin long, size long")


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sets (sorted arrays) have the similarity; empty ones do."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    common = np.intersect1d(a, b, assume_unique=True).size
    alike = len(a) + len(b) - common
    return alike == 0 or common >= similarity * alike


def _verified(pairs: DataFrame, texts: DataFrame, folder: str, similarity: float, shingle: int) -> DataFrame:
    """The ``pairs`` (``a, b``) of the similarity or more. Their sets lie below ``folder`` until they are dropped."""
    wanted = staged(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), f"{folder}-wanted")
    chosen = texts.join(bounded(wanted, wanted.count() * 40), "node", "left_semi")
    places = staged(_write_sets(chosen, f"{folder}-sets", shingle), f"{folder}-places")
    sets = H.local_path(f"{folder}-sets")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict[str, np.ndarray] = {}

        def held(file: str, begin: int, size: int) -> np.ndarray:
            if file not in files:
                if len(files) >= MAPPED:
                    files.clear()
                files[file] = H.map_arrays(f"{sets}/{file}")["shingles"]
            return files[file][begin : begin + size]

        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("fa", "ba", "na", "fb", "bb", "nb")))
            good = [similar(held(fa, ba, na), held(fb, bb, nb), similarity) for fa, ba, na, fb, bb, nb in rows]
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    both = pairs.join(places.toDF("a", "fa", "ba", "na"), "a").join(places.toDF("b", "fb", "bb", "nb"), "b")
    return both.mapInArrow(verify, "a long, b long")


def _unconnected_pairs(texts: DataFrame, roots: DataFrame, work: str, similarity: float, shingle: int) -> DataFrame:
    """Candidates ``a, b`` by the prefix filter: all pairs of the similarity or more, but for those under one root."""
    sample = texts.where(F.pmod(F.xxhash64("node"), F.lit(max(1, texts.count() // ORDER_NODES))) == 0)
    counted = _shingle_sets(sample, shingle).select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n"))
    often = counted.where("n > 1").orderBy(F.desc("n"), "shingle").limit(ORDER_SHINGLES).collect()
    frequent = np.array([(r["shingle"], r["n"]) for r in often], np.int64).reshape(-1, 2)
    common, counts = frequent[:, 0].astype(np.uint64), frequent[:, 1]
    at = np.argsort(common)
    shared = texts.sparkSession.sparkContext.broadcast((common[at], counts[at]))

    def prefixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts = shared.value
        names, found, held = ["key", "node", "size", "pos", "root"], [], 0
        for batch in batches:
            for node, root, text in zip(batch["node"].to_pylist(), batch["root"].to_pylist(), batch["text"]):
                members = np.unique(shingle_hashes(words_of(text.as_py()), shingle))
                n = prefix_join.prefix_length(len(members), similarity)
                keys = prefix_join.ordered(members, common, counts)[:n].view(np.int64)
                found.append((keys, np.full(n, node), np.full(n, len(members), np.int32), np.arange(n, dtype=np.int32), np.full(n, root)))
                held += n
                if held >= PREFIX_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names)
                    found, held = [], 0
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names)

    rooted = texts.join(bounded(roots, roots.count() * 40), "node", "left").select("node", F.coalesce("root", "node").alias("root"), "text")
    keys = rooted.mapInArrow(prefixed, "key long, node long, size int, pos int, root long")

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return prefix_join.pairs_of_sorted(batches, similarity)

    return keys.repartition("key").sortWithinPartitions("key").mapInArrow(met, "a long, b long").distinct()


def similar_groups(
    docs: DataFrame,
    work: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    shingle: int = SHINGLE,
    prints: int = PRINTS,
) -> DataFrame:
    """``row, id, group_row, group_id``: the group's row with the smallest id (null last, then row) stands for it.

    ``row`` numbers ``docs`` (a stored table). ``work``: a shared folder.
    """
    text = F.lower(F.trim(F.regexp_replace(whole_text(text_col), r"[\x20\x09-\x0D]+", " ")))
    rows = staged(
        numbered(docs, F.col(id_col).alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("digest")),
        f"{work}/rows",
    )
    first = F.min(F.struct(F.col("id").isNull(), "id", "row"))
    nodes = staged(rows.groupBy("digest").agg(F.min("row").alias("node"), first.alias("first")), f"{work}/nodes")

    texts = numbered(docs, whole_text(text_col).alias("text"), name="node")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch["node"].to_numpy()
            found = np.array([word_prints(words_of(t.as_py()), prints) for t in batch["text"]], np.int64).reshape(-1, prints)
            for at in range(0, len(own), 1024):
                row, keys, held = print_keys(found[at : at + 1024])
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(own[at : at + 1024][row]), pa.array(held)], ["key", "node", "print"])

    ids = staged(rows.select("row", "digest").join(nodes.select("digest", "node"), "digest").select("row", "node"), f"{work}/ids")
    copies = ids.where("row <> node").select(F.col("row").alias("node"))
    texts = texts.join(bounded(copies, copies.count() * 40), "node", "left_anti")
    keys = texts.mapInArrow(keyed, "key long, node long, print long")
    met = keys.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_bucket_pairs, "a long, b long")
    pairs = staged(met.distinct(), f"{work}/pairs")

    links = staged(_verified(pairs, texts, f"{work}/near", similarity, shingle), f"{work}/near-links")
    drop_staged(docs.sparkSession, f"{work}/near-sets", f"{work}/near-wanted", f"{work}/near-places")
    roots = staged(components(links, f"{work}/components"), f"{work}/near-roots")
    rest = staged(_unconnected_pairs(texts, roots, work, similarity, shingle), f"{work}/rest")
    more = staged(_verified(rest, texts, f"{work}/rest", similarity, shingle), f"{work}/rest-links")
    drop_staged(docs.sparkSession, f"{work}/rest-sets", f"{work}/rest-wanted", f"{work}/rest-places")
    # Stars of the first pass stand for its links.
    stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = staged(components(stars.unionByName(more), f"{work}/all-components"), f"{work}/roots")
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = rooted.groupBy("root").agg(F.min("first").alias("first"))
    member = staged(rooted.select("node", "root").join(groups, "root").select("node", "first"), f"{work}/groups")
    joined = rows.select("row", "id").join(ids, "row").join(member, "node")
    return joined.select("row", "id", F.col("first.row").alias("group_row"), F.col("first.id").alias("group_id"))


def drop_similar(docs: DataFrame, work: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group; only numbers of rows are shuffled or broadcast, if that many fit."""
    groups = similar_groups(docs, work, id_col, text_col)
    gone = staged(groups.where("row <> group_row").select("row"), f"{work}/gone")
    rows = numbered(docs, F.struct("*").alias("doc"))
    return rows.join(bounded(gone, gone.count() * 40), "row", "left_anti").select("doc.*")
