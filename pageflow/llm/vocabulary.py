"""Words of a corpus with ids, as sorted hash arrays that workers memory-map.

The id of a word is its shard (the upper bits of its hash) and its place there, so ids need no numbering over all
words. The hash is XXH64; that no two words of the corpus share one is checked, and another hash is taken if they do,
so ids are exact. A vocabulary may be far larger than a worker's memory: pages of it are mapped as they are touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.llm import hash_arrays as H

SEED = 42
PLACE_BITS = 21  # of an id: place in the shard, which has half as many words on average at most
SHARD_BITS = 10  # of an id at most
ABSENT = -1
P1, P2, P3, P4, P5 = (  # the primes of XXH64
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
)


@dataclass(frozen=True)
class Vocabulary:
    """``folder`` with ``2 ** bits`` files; ``suffix`` is put behind a key before it is hashed."""

    folder: str
    bits: int
    suffix: bytes


def _hash(suffix: bytes) -> Column:
    return F.xxhash64(F.concat(F.col("key").cast("binary"), F.lit(suffix)))


def build(counted: DataFrame, keep: Column, columns: list[str], work: str) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary of ``counted`` (a stored table ``key, n`` and ``columns``, ``key`` unique), of the rows ``keep`` tells.

    The vocabulary is written as the second frame is computed: its words, as ``id, n`` and ``columns``. Keys that are not
    kept are never taken for one that is.
    """
    turn = 0
    while counted.groupBy(_hash(b"\0" * turn).alias("h")).count().where("count > 1").limit(1).count():
        turn += 1
    suffix = b"\0" * turn
    bits = max(0, (counted.where(keep).count() >> (PLACE_BITS - 1)).bit_length())
    if bits > SHARD_BITS:
        raise OverflowError(f"more than {1 << PLACE_BITS + SHARD_BITS - 1} words")
    names, folder = ["id", "n", *columns], f"{H.local_path(work)}/vocabulary"
    hashed = counted.where(keep).select(_hash(suffix).alias("h"), "n", *columns)
    sharded = hashed.withColumn("shard", F.shiftrightunsigned("h", 64 - bits).cast("int") if bits else F.lit(0))
    # Unsigned order: negative hashes come last.
    ordered = sharded.repartition(1 << bits, "shard").sortWithinPartitions("shard", F.col("h") < 0, "h")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, hashes, counts = None, [], []

        def close():
            H.write_arrays(f"{folder}/{shard}", hashes=np.concatenate(hashes).view(np.uint64), counts=np.concatenate(counts))

        for batch in batches:
            numbers = batch["shard"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for first, last in zip(cuts, cuts[1:]):
                if first == last:
                    continue
                if numbers[first] != shard:
                    if hashes:
                        close()
                    shard, hashes, counts = int(numbers[first]), [], []
                place = sum(map(len, hashes))
                if place + last - first > 1 << PLACE_BITS:
                    raise OverflowError(f"more than {1 << PLACE_BITS} words in one of {1 << bits} shards")
                part = batch.slice(first, last - first)
                hashes.append(part["h"].to_numpy().copy())
                counts.append(part["n"].to_numpy().copy())
                ids = (shard << PLACE_BITS) + place + np.arange(last - first)
                yield pa.RecordBatch.from_arrays([pa.array(ids), part["n"], *(part[c] for c in columns)], names)
        if hashes:
            close()

    kinds = {f.name: f.dataType.simpleString() for f in hashed.schema}
    table = ordered.mapInArrow(write, ", ".join(["id long", "n long", *(f"{c} {kinds[c]}" for c in columns)]))
    return Vocabulary(folder, bits, suffix), table


def xxh64(keys: pa.Array, seed: int) -> np.ndarray:
    """XXH64 of binary ``keys`` without nulls; those below 32 bytes all at once, a lane of bytes after the other."""
    offsets = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset : keys.offset + len(keys) + 1].astype(np.int64)
    if not len(keys) or offsets[0] == offsets[-1]:
        return np.full(len(keys), xxhash.xxh64_intdigest(b"", seed), np.uint64)
    data = np.frombuffer(keys.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    eight, four = (np.ndarray(len(data) - 7, kind, data, strides=(1,)) for kind in ("<u8", "<u4"))
    first, size = offsets[:-1] - offsets[0], np.diff(offsets)
    h = size.astype(np.uint64) + np.uint64(seed + P5 & (1 << 64) - 1)

    def mix(own: np.ndarray, x: np.ndarray, bits: int, times: int, plus: int):
        x = h[own] ^ x
        h[own] = (x << np.uint64(bits) | x >> np.uint64(64 - bits)) * np.uint64(times) + np.uint64(plus)

    for lane in range(3):
        own = np.flatnonzero((size >= 8 * lane + 8) & (size < 32))
        x = eight[first[own] + 8 * lane] * np.uint64(P2)
        mix(own, (x << np.uint64(31) | x >> np.uint64(33)) * np.uint64(P1), 27, P1, P4)
    own = np.flatnonzero((size & 4 > 0) & (size < 32))
    mix(own, four[first[own] + (size[own] & ~7)] * np.uint64(P1), 23, P2, P3)
    for byte in range(3):
        own = np.flatnonzero((size & 3 > byte) & (size < 32))
        mix(own, data[first[own] + (size[own] & ~3) + byte] * np.uint64(P5), 11, P1, 0)
    h = (h ^ h >> np.uint64(33)) * np.uint64(P2)
    h = (h ^ h >> np.uint64(29)) * np.uint64(P3)
    h ^= h >> np.uint64(32)
    for at in np.flatnonzero(size >= 32).tolist():
        h[at] = xxhash.xxh64_intdigest(keys[at].as_py(), seed)
    return h


class Words:
    """A worker's view of a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.shards: dict[int, dict[str, np.ndarray] | None] = {}

    def _shard(self, number: int) -> dict[str, np.ndarray] | None:
        if number not in self.shards:
            try:
                self.shards[number] = H.map_arrays(f"{self.vocabulary.folder}/{number}")
            except FileNotFoundError:  # no word has such a hash
                self.shards[number] = None
        return self.shards[number]

    def ids(self, keys: list[bytes] | pa.Array) -> np.ndarray:
        """Ids of different ``keys``, ``ABSENT`` for unknown ones."""
        keys = keys if isinstance(keys, pa.Array) else pa.array(keys, pa.binary())
        if suffix := self.vocabulary.suffix:
            keys = pc.binary_join_element_wise(keys, pa.scalar(suffix, pa.binary()), pa.scalar(b"", pa.binary()))
        hashes = xxh64(keys, SEED)
        order = np.argsort(hashes)
        hashes = hashes[order]  # neighbours are looked up in the same pages
        bits = self.vocabulary.bits
        found = np.full(len(keys), ABSENT, np.int64)
        shards = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        cuts = np.searchsorted(shards, np.arange((1 << bits) + 1))
        for number in np.flatnonzero(np.diff(cuts)).tolist():
            if (arrays := self._shard(number)) is not None:
                own = slice(cuts[number], cuts[number + 1])
                at = H.find_sorted(arrays["hashes"], hashes[own])
                found[order[own]] = np.where(at >= 0, (number << PLACE_BITS) + at, ABSENT)
        return found

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """How often the words of ``ids`` occur; zero for ``ABSENT``."""
        found = np.zeros(len(ids), np.int64)
        shards = ids >> PLACE_BITS
        for number in np.unique(shards[ids >= 0]):
            own = np.flatnonzero(shards == number)
            found[own] = self._shard(int(number))["counts"][ids[own] & (1 << PLACE_BITS) - 1]
        return found


class Encoder:
    """Lists of words to ids, each different word looked up once. ``fixed``: words with an id of their own."""

    def __init__(self, words: Words, tail: bytes = b"", fixed: dict[bytes, int] | None = None):
        self.words, self.tail, self.fixed = words, tail, fixed or {}

    def __call__(self, words: list[bytes] | pa.Array) -> np.ndarray:
        encoded = (words if isinstance(words, pa.Array) else pa.array(words, pa.binary())).dictionary_encode()
        distinct = encoded.dictionary
        keys = pc.binary_join_element_wise(distinct, pa.scalar(self.tail, pa.binary()), pa.scalar(b"", pa.binary())) if self.tail else distinct
        ids = self.words.ids(keys)
        for word, number in self.fixed.items():
            ids[pc.equal(distinct, pa.scalar(word, pa.binary())).to_numpy(zero_copy_only=False)] = number
        return ids[encoded.indices.to_numpy()]
