"""Boolean trigram queries from regular expressions, and inverted trigram indexes over segments of texts.

A query is ``True`` (every text may match), or ``("and" | "or", frozenset of queries and trigrams)``. Texts and
literals are folded to lower case (A-Z only), so one index serves rules with and without regard to case.
"""

from __future__ import annotations

import re
from itertools import product

import numpy as np

EXACT_LIMIT = 64  # strings that are followed exactly before a query is made of them
CLASS_LIMIT = 8  # characters of a class that are followed one by one

_sre = re._parser  # the parse tree of the standard library's own regular expressions


def fold(text: bytes) -> bytes:
    """Lower case for A-Z, nothing else."""
    return text.lower()


def _join(kind: str, parts) -> object:
    """Combine queries; ``True`` is neutral for ``and`` and absorbs ``or``."""
    parts = frozenset(parts)
    if kind == "or" and True in parts:
        return True
    parts -= {True}
    if not parts:
        return True
    return next(iter(parts)) if len(parts) == 1 else (kind, parts)


def _strings_query(strings: set[bytes]) -> object:
    """Some of ``strings`` occurs: an ``or`` over strings of an ``and`` over their trigrams."""
    return _join("or", (_join("and", (s[i : i + 3] for i in range(len(s) - 2))) for s in strings))


def _class(items) -> set[bytes] | None:
    found: set[bytes] = set()
    for op, value in items:
        if op is _sre.LITERAL:
            span = (value, value)
        elif op is _sre.RANGE:
            span = value
        else:
            return None
        if span[1] - span[0] >= CLASS_LIMIT * 4:
            return None
        found |= {fold(chr(c).encode()) for c in range(span[0], span[1] + 1)}
    return found if len(found) <= CLASS_LIMIT else None


def _walk(nodes) -> tuple[set[bytes] | None, object]:
    """``(strings, query)`` of a sequence: all that it can match if few (else None), and what must occur."""
    run: set[bytes] | None = {b""}
    queries: list[object] = []
    whole = True

    def end_run() -> None:
        nonlocal run, whole
        if run:
            queries.append(_strings_query(run))
        run, whole = {b""}, False

    for op, value in nodes:
        if op is _sre.LITERAL:
            strings, query = {fold(chr(value).encode())}, True
        elif op is _sre.IN:
            strings, query = _class(value), True
        elif op is _sre.SUBPATTERN:
            strings, query = _walk(value[3])
        elif op is _sre.BRANCH:
            found = [_walk(b) for b in value[1]]
            strings = None if any(s is None for s, _ in found) else set().union(*(s for s, _ in found))
            query = _join("or", (q if s is None else _strings_query(s) for s, q in found))
        elif op in (_sre.MAX_REPEAT, _sre.MIN_REPEAT, _sre.POSSESSIVE_REPEAT):
            low, high, body = value
            strings, query = _walk(body)
            if high == 1 and low == 0 and strings is not None:
                strings = strings | {b""}
            elif low == high and strings is not None and len(strings) ** low <= EXACT_LIMIT:
                strings = {b"".join(p) for p in product(strings, repeat=low)}
            else:
                query = True if low == 0 else (query if strings is None else _strings_query(strings))
                strings = None
        elif op is _sre.AT or op in (_sre.ASSERT, _sre.ASSERT_NOT):
            strings, query = {b""}, True
        else:
            strings, query = None, True
        if strings is not None and len(run) * len(strings) <= EXACT_LIMIT:
            run = {a + b for a in run for b in strings}
            continue
        end_run()
        if strings is not None and len(strings) <= EXACT_LIMIT:
            run = set(strings)
        else:
            queries.append(query)
    if whole:
        return run, _strings_query(run)
    queries.append(_strings_query(run))
    return None, _join("and", queries)


def trigram_query(pattern: str) -> object:
    """What trigrams a text must hold to match ``pattern``; ``True`` if none is mandatory."""
    strings, query = _walk(_sre.parse(pattern))
    return _strings_query(strings) if strings is not None else query


def trigrams_of(query: object) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*(trigrams_of(q) for q in query[1]))


class SegmentIndex:
    """Postings of the given trigrams over a segment of texts: trigram -> sorted numbers of texts."""

    def __init__(self, texts: list[bytes], trigrams: list[bytes]):
        self.size = len(texts)
        slot = np.zeros(1 << 24, np.uint8 if len(trigrams) < 255 else np.uint16)
        for number, trigram in enumerate(trigrams, 1):
            slot[int.from_bytes(trigram, "big")] = number
        found: list[np.ndarray] = []
        for number, text in enumerate(texts):
            data = np.frombuffer(fold(text), np.uint8)
            if len(data) > 2:
                code = data[:-2].astype(np.uint32) << 16
                code |= data[1:-1].astype(np.uint32) << 8
                code |= data[2:]
                held = np.unique(slot[code]).astype(np.int64)
                found.append(held[held > 0] << 32 | number)
        pairs = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
        lists = np.split(pairs & 0xFFFFFFFF, np.searchsorted(pairs >> 32, np.arange(2, len(trigrams) + 1)))
        self.postings = dict(zip(trigrams, lists))

    def search(self, query: object) -> np.ndarray:
        """Numbers of the texts that may match: postings intersected for ``and``, united for ``or``."""
        if query is True:
            return np.arange(self.size)
        if isinstance(query, bytes):
            return self.postings[query]
        lists = sorted((self.search(q) for q in query[1]), key=len)
        if query[0] == "or":
            return np.unique(np.concatenate(lists))
        result = lists[0]
        for other in lists[1:]:
            result = np.intersect1d(result, other, assume_unique=True)
        return result
