"""Secrets in whole texts, found with an inverted trigram index.

Each rule's regular expression is turned into a Boolean query over trigrams. The texts of a task form segments;
a segment's index holds the postings of all trigrams that some query names, postings are intersected and united,
and the rule's expression is run on the texts that are left. Rules without a mandatory trigram (``hex``) run on
every text. Segments live in the task that scans them: the texts are read once and nothing is shuffled.

Rules
* A span is ``kind, start, end``: code points, end exclusive. Matches of a kind are leftmost and do not overlap;
  those that fail the rule's length are dropped. Spans are ordered by start, then by the order of the rules.
* A null or empty text has no span. Every row gives one row; other columns and clashing names play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow.llm.common import whole_text
from pageflow.llm.trigrams import SegmentIndex, trigram_query, trigrams_of

SEGMENT_BYTES = 16 << 20  # texts of a segment; a longer text is a segment of its own


@dataclass(frozen=True)
class Rule:
    """``group`` must have at least ``at_least`` code points; the span is the whole match."""

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 1


# The base rules in their order. Letters of the names match in either case, A-Z only.
BASE = (
    Rule(
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        at_least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", at_least=18),
    Rule("hex", r"[0-9a-f]+", at_least=16),
)

# Further public token formats, after the base rules.
FURTHER = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]+", at_least=40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", at_least=15),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)

RULES = BASE + FURTHER

SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
)


def _finder(rule: Rule):
    """A maximal run of a class is found by its least length at once; other rules test the length afterwards."""
    run = re.fullmatch(r"(\[[^]]+\])\+", rule.pattern)
    compiled = re.compile(f"{run[1]}{{{rule.at_least},}}" if run else rule.pattern)

    def find(text: str) -> Iterator[tuple[int, int]]:
        for match in compiled.finditer(text):
            if len(match[rule.group]) >= rule.at_least:
                yield match.span()

    return find


def segments(texts: list[str]) -> Iterator[tuple[int, list[bytes]]]:
    """``(first number, encoded texts)``, cut by size."""
    start, held, size = 0, [], 0
    for number, text in enumerate(texts):
        data = text.encode()
        if held and size + len(data) > SEGMENT_BYTES:
            yield start, held
            start, held, size = number, [], 0
        held.append(data)
        size += len(data)
    if held:
        yield start, held


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, spans`` (array of ``kind, start, end``) for every row."""
    queries = [trigram_query(rule.pattern) for rule in rules]
    trigrams = sorted(set().union(*(trigrams_of(q) for q in queries)))
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = [_finder(rule) for rule in rules]
        for batch in batches:
            texts = batch["text"].to_pylist()
            found: list[list[tuple[int, int, str, int]]] = [[] for _ in texts]
            for first, segment in segments(texts):
                index = SegmentIndex(segment, trigrams)
                for order, (rule, query, find) in enumerate(zip(rules, queries, finders)):
                    for number in index.search(query):
                        at = first + int(number)
                        found[at] += ((start, order, rule.kind, end) for start, end in find(texts[at]))
            spans = [[{"kind": k, "start": s, "end": e} for s, _, k, e in sorted(row)] for row in found]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(spans, spans_type)], ["id", "spans"])

    slim = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return slim.mapInArrow(scan, T.StructType([slim.schema["id"], T.StructField("spans", T.ArrayType(SPAN))]))
