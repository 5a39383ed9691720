"""Counting of short phrases of word ids in a HAT-trie of bounded size.

The root has a branch for each first word. A branch is a hash container of ``rest -> count``, where a rest is the
second word and the third (or none) as one number. A container that outgrows ``BURST`` bursts: it becomes a node
with a container for each second word. Deeper levels are not needed for phrases of three words.

When the trie outgrows its limit, the largest branches are taken out whole, as sorted runs, until half of the limit
is left: phrases with a frequent first word, which fill these branches, are combined best when they stay longest, but
they also are what the room goes to.
"""

from __future__ import annotations

from itertools import chain

import numpy as np

from pageflow.llm.runs import ID_BITS, Run

BURST = 1 << 13

Container = dict[int, int]


def rests(second: np.ndarray, third: np.ndarray) -> np.ndarray:
    """One number for second and third words; ``third`` is -1 for none, and stored plus one."""
    return second << ID_BITS | third + 1


def _groups(keys: np.ndarray) -> zip:
    """``(key, begin, end)`` of the runs of equal keys."""
    begins = np.flatnonzero(np.diff(keys, prepend=-1))
    return zip(keys[begins].tolist(), begins.tolist(), [*begins[1:].tolist(), len(keys)])


def _count(container: Container, values: list[int]) -> int:
    """Count ``values``; returns how many are new."""
    before, seen = len(container), container.get
    for value in values:
        container[value] = seen(value, 0) + 1
    return len(container) - before


class HatTrie:
    def __init__(self, limit: int):
        self.limit, self.entries = limit, 0
        self.containers: dict[int, Container] = {}  # by first word
        self.nodes: dict[int, dict[int, Container]] = {}  # of burst containers: by first word, then second

    def add(self, first: np.ndarray, rest: np.ndarray) -> None:
        """Count phrases."""
        order = np.argsort(first)
        first, rest = first[order], rest[order]
        values = rest.tolist()
        for word, begin, end in _groups(first):
            if word in self.nodes:
                self._add_below(self.nodes[word], rest[begin:end])
                continue
            container = self.containers.get(word)
            if container is None:
                container = self.containers[word] = {}
            self.entries += _count(container, values[begin:end])
            if len(container) > BURST:
                self.nodes[word] = self._burst(self.containers.pop(word))

    def _add_below(self, node: dict[int, Container], rest: np.ndarray) -> None:
        rest = np.sort(rest)
        values = rest.tolist()
        for second, begin, end in _groups(rest >> ID_BITS):
            self.entries += _count(node.setdefault(second, {}), values[begin:end])

    @staticmethod
    def _burst(container: Container) -> dict[int, Container]:
        node: dict[int, Container] = {}
        for rest, n in container.items():
            node.setdefault(rest >> ID_BITS, {})[rest] = n
        return node

    def full(self) -> bool:
        return self.entries > self.limit

    def spill(self, keep: int = 0) -> Run:
        """Take out the largest branches until at most ``keep`` entries are left: their sorted run."""
        words = [*self.containers, *self.nodes]
        sizes = np.array([*map(len, self.containers.values()), *(sum(map(len, n.values())) for n in self.nodes.values())], np.int64)
        order = np.argsort(-sizes)
        gone = order[: int(np.searchsorted(np.cumsum(sizes[order]), self.entries - keep)) + 1]
        self.entries -= int(sizes[gone].sum())
        taken, first = [], np.repeat(np.array(words, np.int64)[gone], sizes[gone])
        for at in gone.tolist():
            word = words[at]
            taken += [self.containers.pop(word)] if word in self.containers else self.nodes.pop(word).values()
        rest = np.fromiter(chain.from_iterable(taken), np.int64, len(first))
        count = np.fromiter(chain.from_iterable(c.values() for c in taken), np.int64, len(first))
        order = np.lexsort((rest, first))
        first, rest, count = first[order], rest[order], count[order]
        return first, rest >> ID_BITS, rest & (1 << ID_BITS) - 1, count
