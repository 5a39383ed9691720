"""Token counts of whole texts by a two-tier lookup of pre-token lengths, without a shuffle of pre-tokens.

Tier one is a hash table ``pre-token -> number of tokens`` of the frequent pre-tokens. It is found with Spark's
mergeable top-k sketch over all documents (bounded summaries move, pre-tokens do not) and broadcast; it has at
most ``FREQUENT`` entries. Tier two is a cache in each worker that encodes what tier one does not hold. Both
tiers hold exact lengths, so what the sketch picks changes the speed only.

Rules
* Counts equal those of the tokenizers library without begin, end or added special tokens; a special string
  inside a text is one token, as is the library's default.
* A null or empty text has 0 bytes and 0 tokens. One row comes out for each row that goes in; other columns
  and clashing names play no part.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow.llm.common import whole_text

FREQUENT = 16_384  # entries of the broadcast table
TRACKED = 32_768  # items that a sketch tracks
MERGES = 512  # sketches that the last step merges
CACHED = 1_000_000  # entries of a worker's cache before it starts anew

# Candidates for tier one. Anything that is no pre-token is simply never looked up.
CANDIDATE = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"

# Characters below this code point are split with a compiled pattern, texts with others by the library itself.
COMMON = 0x250


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def frequent_pieces(docs: DataFrame, text_col: str = "text") -> list[str]:
    """At most ``FREQUENT`` frequent pre-tokens of all texts."""
    words = docs.select(
        F.explode(F.regexp_extract_all(whole_text(text_col), F.lit(CANDIDATE), F.lit(0))).alias("word"),
        (F.spark_partition_id() % MERGES).alias("part"),
    )
    sketches = words.groupBy("part").agg(F.expr(f"approx_top_k_accumulate(word, {TRACKED})").alias("sketch"))
    # Grouped by a constant: a task without rows then makes no empty sketch, which could not be combined.
    merged = sketches.withColumn("all", F.lit(True)).groupBy("all").agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"))
    top = merged.select(F.expr(f"approx_top_k_estimate(sketch, {FREQUENT})").alias("top")).first()
    return [row["item"] for row in top["top"]] if top and top["top"] else []


def character_class(pattern: str) -> str:
    """The characters below ``COMMON`` that a Unicode class holds, as ranges."""
    import regex

    held = [o for o in range(COMMON) if regex.fullmatch(pattern, chr(o))]
    return "".join(f"\\u{o:04x}" for o in held)


def piece_pattern() -> re.Pattern[str]:
    """The pre-token pattern of byte-level BPE for texts below ``COMMON``."""
    letter, number, space = (character_class(p) for p in (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(
        f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{letter}{number}{space}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )


class Lengths(dict):
    """Pre-token -> number of tokens; encodes what it does not hold."""

    def __init__(self, known: dict[str, int], tokenizer):
        super().__init__(known)
        self.known, self.tokenizer = known, tokenizer

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHED + len(self.known):
            self.clear()
            self.update(self.known)
        self[piece] = length = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return length


def text_counter(tokenizer, known: dict[str, int]) -> Callable[[str], int]:
    """``text -> number of tokens`` with ``known`` as first tier."""
    lengths, pieces = Lengths(known, tokenizer), piece_pattern()
    rare = re.compile(f"[^\\x00-\\u{COMMON - 1:04x}]")
    split = tokenizer.pre_tokenizer.pre_tokenize_str
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    cut = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None

    def count(part: str) -> int:
        if rare.search(part):
            return sum(lengths[part[a:b]] for _, (a, b) in split(part))
        return sum(map(lengths.__getitem__, pieces.findall(part)))

    def counted(text: str) -> int:
        parts = cut.split(text) if cut else [text]
        return len(parts) - 1 + sum(map(count, parts))

    return counted


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens`` for every row. ``tokenizer_path`` is a file that every executor has."""
    frequent = frequent_pieces(docs, text_col)
    tokenizer = load_tokenizer(tokenizer_path)
    encoded = tokenizer.encode_batch(frequent, add_special_tokens=False)
    table = docs.sparkSession.sparkContext.broadcast({w: len(e.ids) for w, e in zip(frequent, encoded)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = text_counter(load_tokenizer(tokenizer_path), table.value)
        for batch in batches:
            tokens = pa.array(map(counted, batch["text"].to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch["id"], batch["n_bytes"], tokens], ["id", "n_bytes", "n_tokens"])

    text = whole_text(text_col)
    slim = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    schema = T.StructType([slim.schema["id"], *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_tokens"))])
    return slim.mapInArrow(count, schema)
