"""Candidate pairs for a Jaccard similarity of sets, complete: the prefix filter with lengths and positions.

The members of all sets are put in one order, rare ones first. Two sets with a similarity of ``t`` or more share one of
the first ``n - ceil(t * n) + 1`` members of each, so sets meet in buckets of these. In a bucket a pair is a candidate
if the lengths allow the similarity and the members from the shared one on suffice for the overlap: that holds at the
first member that an alike pair shares, so no such pair is lost. Pairs that are already connected are left out, and
nothing else is: a bucket has no bound, its pairs are made block by block.

The order comes from counts in a sample. It decides how large buckets get, not which pairs are found: any order that
all sets follow will do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_PAIRS = 1 << 22  # pairs that are looked at at once
SLACK = 1e-6  # against rounding: a bound is never too high


def ordered(members: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Distinct ``members`` (unsigned), those outside the sorted ``common`` first, then by count, then by value."""
    weight = np.zeros(len(members), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, members), len(common) - 1)
        weight = np.where(common[at] == members, counts[at], 0)
    return members[np.lexsort((members, weight))]


def prefix_length(n: int, similarity: float) -> int:
    return n - max(1, int(np.ceil(similarity * n - SLACK))) + 1 if n else 0


def bucket_pairs(node: np.ndarray, size: np.ndarray, pos: np.ndarray, root: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(a, b)`` of a bucket's candidates, ``a > b``, for nodes of different ``root``; each pair once."""
    roots, group, counts = np.unique(root, return_inverse=True, return_counts=True)
    if len(roots) < 2:
        return
    # The largest group's nodes are connected: only the others are compared with all.
    inside = group == np.argmax(counts)
    others = np.flatnonzero(~inside)
    order = np.concatenate([others, np.flatnonzero(inside)])
    node, size, pos, group = node[order], size[order], pos[order], group[order]
    rest = size - pos
    share = similarity / (1 + similarity)
    step = max(1, BLOCK_PAIRS // len(node))
    for at in range(0, len(others), step):
        stop = min(len(others), at + step)
        mine = slice(at, stop)
        after = slice(at, None)  # earlier ones have been compared
        wanted = np.ceil(share * (size[mine, None] + size[after]) - SLACK)
        met = (group[mine, None] != group[after]) & (np.minimum(rest[mine, None], rest[after]) >= wanted)
        met &= np.minimum(size[mine, None], size[after]) >= similarity * np.maximum(size[mine, None], size[after]) - SLACK
        i, j = np.nonzero(met)
        later = j > i  # within the block each pair once
        a, b = node[mine][i[later]], node[after][j[later]]
        if len(a):
            yield np.maximum(a, b), np.minimum(a, b)


def pairs_of_sorted(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Candidates ``a, b`` from rows ``key, node, size, pos, root`` sorted by key; a bucket of one root makes none."""
    names = ("node", "size", "pos", "root")
    key, held = None, []

    def closed():
        parts = [np.concatenate(p) for p in zip(*held)]
        if len(parts[0]) > 1:
            for a, b in bucket_pairs(*parts, similarity):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        keys = batch["key"].to_numpy()
        columns = [batch[c].to_numpy() for c in names]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
        if not len(keys):
            continue
        # A key that neither goes on from the batch before nor may go on in the next one is whole here.
        for n in np.flatnonzero((np.diff(cuts) > 1) | np.isin(np.arange(len(cuts) - 1), (0, len(cuts) - 2))):
            first, last = cuts[n], cuts[n + 1]
            if keys[first] != key:
                if held:
                    yield from closed()
                key, held = keys[first], []
            held.append([c[first:last] for c in columns])
    if held:
        yield from closed()
