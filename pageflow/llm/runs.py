"""Sorted runs of counted id triples, and their merge by prefix.

A run is a table ``(a, b, c, n)`` sorted by ``a, b, c``: how often the phrase of these ids was met. Ids are below
2 ** 31. All runs of a slot, a share of the prefixes ``(a, b)``, meet in one task and are merged there. The number of
slots follows the size of the corpus, so that a slot's runs have a bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from pageflow.llm import hash_arrays as H

ID_BITS = 31
SLOT_WORDS = 1 << 20  # words of the corpus for each slot
LEAST_SLOTS = 256
PACKED_AT_ONCE = 1 << 18
RUN_TYPE = "slot int, run binary"
_LOW = (1 << ID_BITS) - 1

Run = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def slots_for(words: int) -> int:
    return max(LEAST_SLOTS, -(-words // SLOT_WORDS))


def slot_of(a: np.ndarray, b: np.ndarray, slots: int) -> np.ndarray:
    return (H.mixed(a, b) % np.uint64(slots)).astype(np.int64)


def merged(a: np.ndarray, b: np.ndarray, c: np.ndarray, n: np.ndarray) -> Run:
    """Triples in order, each once, with the sum of ``n``.

    Prefixes are sorted and numbered first, so that number and ``c`` together are one key to sort by.
    """
    prefix = a << ID_BITS | b
    del a, b
    order = np.argsort(prefix)
    prefix = prefix[order]
    new = np.ones(len(prefix), bool)
    new[1:] = prefix[1:] != prefix[:-1]
    key = np.cumsum(new) - 1 << ID_BITS | c[order]
    prefix = prefix[new]
    if (n == 1).all():
        key = np.sort(key)
    else:
        by_key = np.argsort(key)
        key, n = key[by_key], n[order[by_key]]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    key = key[first]
    total = np.add.reduceat(n, first) if len(first) else n[:0]
    prefix = prefix[key >> ID_BITS]
    return prefix >> ID_BITS, prefix & _LOW, key & _LOW, total


def _bytes(values: np.ndarray, kind: str) -> np.ndarray:
    """The bytes of numbers, a row of all first bytes, then one of all second ones and so on: they compress better."""
    return values.astype(kind).view(np.uint8).reshape(len(values), -1).T


def _rows(run: Run, starts: np.ndarray) -> np.ndarray:
    """The bytes of a run, a column for each triple. Parts begin at ``starts``; each is sorted and can be read alone."""
    a, b, c, n = run
    step, within = a.copy(), b.copy()
    step[1:] -= a[:-1]
    step[starts] = a[starts]
    same = np.flatnonzero(step[1:] == 0) + 1  # second words ascend under one first word
    within[same] -= b[same - 1]
    within[starts] = b[starts]
    width = next(k for k in (1, 2, 4, 8) if k == 8 or not len(n) or n.max() < 1 << 8 * k)
    return np.concatenate([*(_bytes(x, "<u4") for x in (step, within, c)), _bytes(n, f"<u{width}")])


def _packed(rows: np.ndarray) -> bytes:
    return rows.shape[1].to_bytes(7, "little") + bytes([len(rows) - 12]) + _packer().compress(rows.tobytes())


def pack(run: Run) -> bytes:
    return _packed(_rows(run, np.zeros(min(1, len(run[0])), np.int64)))


def unpack(data: bytes) -> Run:
    n, width = int.from_bytes(data[:7], "little"), data[7]
    rows = np.frombuffer(_unpacker().decompress(data[8:]), np.uint8)
    step, within, c = rows[: 12 * n].reshape(3, 4, n).transpose(0, 2, 1).copy().view("<u4")[..., 0].astype(np.int64)
    counts = rows[12 * n :].reshape(width, n).T.copy().view(f"<u{width}").reshape(-1).astype(np.int64)
    # Sums of steps that start anew where the first word changes.
    total = np.cumsum(within)
    first = np.flatnonzero(step)
    first = np.concatenate([[0], first[first > 0]]) if n else first
    before = np.repeat((total - within)[first], np.diff(first, append=n)) if n else total
    return np.cumsum(step), total - before, c, counts


@cache
def _packer() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=3)


@cache
def _unpacker() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def by_slot(run: Run, slots: int) -> Iterator[pa.RecordBatch]:
    """Rows ``slot, run`` of a sorted run: its parts by slot, sorted still."""
    slot = slot_of(run[0], run[1], slots)
    if slots <= 1 << 16:
        slot = slot.astype(np.uint16)  # sorted by counting
    order = np.argsort(slot, kind="stable")
    slot = slot[order]
    new = np.ones(len(slot), bool)
    new[1:] = slot[1:] != slot[:-1]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(slot))
    del new
    at = 0
    while at < len(starts):  # some parts at once
        begin = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, begin + PACKED_AT_ONCE, "right")))
        rows = _rows(tuple(column[order[begin : ends[to - 1]]] for column in run), starts[at:to] - begin)
        bounds = zip((starts[at:to] - begin).tolist(), (ends[at:to] - begin).tolist())
        parts = pa.array([_packed(rows[:, first:last]) for first, last in bounds], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(slot[starts[at:to]], pa.int32()), parts], ["slot", "run"])
        at = to


def merge_slots(rows: DataFrame, done: Callable[[int, Run], Iterator[pa.RecordBatch | Run]], schema: str, slots: int = 0) -> DataFrame:
    """``done(slot, merged run)`` for every slot of ``rows`` (``slot, run``).

    Runs among what it gives are merged with those of the task's other slots, then dealt to ``slots`` slots.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, held, waiting = None, [], 0
        passed: list[Run] = []

        def pass_on():
            yield from by_slot(merged(*map(np.concatenate, zip(*passed))), slots)
            passed.clear()

        def finished():
            for found in done(slot, merged(*map(np.concatenate, zip(*held)))):
                if isinstance(found, pa.RecordBatch):
                    yield found
                    continue
                passed.append(found)
                if sum(len(run[0]) for run in passed) > SLOT_WORDS:
                    yield from pass_on()

        for batch in batches:
            for number, data in zip(batch["slot"].to_pylist(), batch["run"]):
                if number != slot:
                    if held:
                        yield from finished()
                    slot, held, waiting = number, [], 0
                run = unpack(data.as_py())
                held.append(run)
                waiting += len(run[0])
                if waiting > 2 * SLOT_WORDS and len(held) > 1:  # what is alike needs no room
                    held = [merged(*map(np.concatenate, zip(*held)))]
                    waiting = 0
        if held:
            yield from finished()
        if passed:
            yield from pass_on()

    return rows.repartition("slot").sortWithinPartitions("slot").mapInArrow(merge, schema)
