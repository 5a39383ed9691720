"""Ranked lexical search: MaxScore over blocks of an inverted index, with bounds on pairs of terms.

The index is a table of blocks. A block holds the postings of some thousand documents, each term's greatest impact,
and intersection lists of pairs of frequent terms: the documents that hold both, and the greatest joint impact there. Frequent terms have the
longest lists and the least weight, so they are what a search wants to skip.

A search meets each block with all queries. A query's terms are put into units: pairs with a list, where that
lowers the bound most, and single terms. A pair's bound is its joint impact or the greater of its two single ones, which is less
than their sum. Units whose bounds add up to less than the kth score so far can't lift a document on their own: only documents
of the other units are looked at, and of these only those whose own bound, with the pair lists telling which of them
hold both terms, still reaches that score. Scores are exact integers. The kth score of a query goes from block to block, and begins with what
a bounded number of blocks gives. Queries come in rounds of bounded size, each broadcast; what a task returns is
``k`` rows a query at most, and the winners of all tasks are ranked by a window.

Rules
* Terms are runs of letters and digits of ASCII and of any other characters beyond it; A-Z are lower-cased, texts whole.
* ``w = floor(1000 ln((2 N + 2) / (2 df + 1)))``, ``m = 50 + (50 n N) div L``, and a score is the sum of
  ``w ((1000000000 tf) div (1000 tf + 20 m))`` over the different terms of a query; documents with score zero are not found.
* A null or empty text has no terms. Ties go to the smaller id, a null id last. Repeated ids are different documents, repeated
  queries are ranked each for itself. Empty tables and queries without known terms give no rows. Other columns and
  clashing names play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow.llm.common import WIDE_ROWS, small_batches, staged, whole_text

BLOCK_DOCS = 4096
BLOCK_TERMS = 400_000  # term occurrences that close a block
PAIR_TERMS = 32  # the most frequent terms, whose pairs have lists
QUERY_BYTES = 4 << 20  # texts of a round of queries
SEED_BLOCKS = 4  # whose results start the thresholds
NO_ID = (1 << 63) - 1

# What stands between terms, and the letters that are lower-cased.
_BETWEEN = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes.maketrans(_BETWEEN + _UPPER, b" " * len(_BETWEEN) + _LOWER)

# The long lists are packed: as lists of numbers they take several times their size in the JVM, beside Parquet's levels of each.
BLOCK_TYPE = "n_docs long, n_terms long, ids array<long>, lengths array<int>, terms binary, starts binary, docs binary, tfs binary"
PAIR_TYPE = "pair_a array<int>, pair_b array<int>, pair_tops array<long>, pair_starts array<int>, pair_docs binary"
PACKED = ("starts", "docs", "tfs", "pair_docs")


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


def _row(columns: dict[str, tuple[object, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in columns.values()], list(columns))


def _ints(values: np.ndarray) -> tuple[np.ndarray, pa.DataType]:
    return values.astype(np.int32), pa.list_(pa.int32())


def _packed(values: np.ndarray) -> tuple[bytes, pa.DataType]:
    """Numbers from 0 in as few bytes each as the greatest needs; the first byte says how many."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return bytes([kind.itemsize]) + values.astype(kind.newbyteorder("<")).tobytes(), pa.binary()


def _unpacked(value: pa.BinaryScalar) -> np.ndarray:
    data = value.as_buffer()
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int32)


def index_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Postings of ``docs`` in blocks: of each term, the documents (by place in the block, ascending) and its counts."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        ids, lengths, held = [], [], []

        def close():
            lengths_of = np.array(lengths, np.int64)
            term = np.concatenate(held)
            pairs, tf = np.unique(term * len(ids) + np.repeat(np.arange(len(ids)), lengths_of), return_counts=True)
            starts = np.searchsorted(pairs, np.arange(len(known) + 1) * len(ids))
            row = {
                "n_docs": (len(ids), pa.int64()),
                "n_terms": (int(lengths_of.sum()), pa.int64()),
                "ids": (ids, pa.list_(pa.int64())),
                "lengths": _ints(lengths_of),
                "terms": (b" ".join(known), pa.binary()),
                "starts": _packed(starts),
                "docs": _packed(pairs % len(ids)),
                "tfs": _packed(tf),
            }
            return _row(row)

        for batch in batches:
            for own, text in zip(batch["id"].to_pylist(), batch["text"]):
                words = terms_of(text.as_py())
                if not words:
                    continue
                for word in words:
                    if word not in known:
                        known[word] = len(known)
                held.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                ids.append(own)
                lengths.append(len(words))
                if len(ids) >= block_docs or sum(lengths) >= BLOCK_TERMS:
                    yield close()
                    known, ids, lengths, held = {}, [], [], []
        if ids:
            yield close()

    return slim.mapInArrow(build, BLOCK_TYPE)


def document_frequencies(blocks: DataFrame) -> DataFrame:
    """``term`` (binary) and ``df``, over all blocks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, starts in zip(batch["terms"].to_pylist(), batch["starts"]):
                n = np.diff(_unpacked(starts)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(terms.split(b" "), pa.binary()), pa.array(n)], ["term", "df"])

    counted = blocks.select("terms", "starts").mapInArrow(count, "term binary, df long")
    return counted.groupBy("term").agg(F.sum("df").alias("df"))


def weight(df: int, n: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Block:
    """A block of the index, with the impacts of the terms that are asked for."""

    def __init__(self, row: dict, weights: dict[bytes, int], n: int, terms: int):
        self.n_docs = row["n_docs"]
        lengths = row["lengths"].astype(np.int64)
        self.norm = 20 * (50 + 50 * lengths * n // terms)
        self.docs, self.tfs, self.starts = row["docs"], row["tfs"], row["starts"]
        self.weights = weights
        self.at = {t: i for i, t in enumerate(row["terms"].split(b" ")) if t in weights}
        self.held: dict[bytes, tuple[np.ndarray, np.ndarray, int]] = {}

    def postings(self, term: bytes) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents with the term, their impacts, and the greatest one."""
        if term not in self.held:
            own = slice(self.starts[self.at[term]], self.starts[self.at[term] + 1])
            docs, tf = self.docs[own], self.tfs[own].astype(np.int64)
            impact = self.weights[term] * (1_000_000_000 * tf // (1000 * tf + self.norm[docs]))
            self.held[term] = docs, impact, int(impact.max())
        return self.held[term]


def _arrays(batch: pa.RecordBatch, row: int) -> dict:
    """Numbers of a row as arrays, single values as they are."""
    found = {}
    for name, column in zip(batch.schema.names, batch.columns):
        value = column[row]
        if name in PACKED:
            found[name] = _unpacked(value)
        else:
            found[name] = value.values.to_numpy(zero_copy_only=False) if isinstance(value, pa.ListScalar) and name != "ids" else value.as_py()
    return found


def add_pair_lists(blocks: DataFrame, frequent: list[tuple[bytes, int]], n: int, terms: int) -> DataFrame:
    """``blocks`` with the intersection lists of all pairs of ``frequent`` terms (``term, df``) and their joint maxima.

    ``pair_a, pair_b`` are places in ``frequent``; ``n`` documents have ``terms`` terms.
    """
    weights = {t: weight(df, n) for t, df in frequent}
    order = [t for t, _ in frequent]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(batch.num_rows):
                block = Block(_arrays(batch, number), weights, n, terms)
                here = [i for i, t in enumerate(order) if t in block.at]
                impacts = np.zeros((len(here), block.n_docs), np.int64)
                held = np.zeros((len(here), block.n_docs), bool)
                for place, i in enumerate(here):
                    docs, impact, _ = block.postings(order[i])
                    impacts[place, docs], held[place, docs] = impact, True
                a, b, tops, lists = [], [], [], []
                for x, i in enumerate(here):
                    for y in range(x + 1, len(here)):
                        both = np.flatnonzero(held[x] & held[y])
                        a.append(i)
                        b.append(here[y])
                        tops.append(int((impacts[x, both] + impacts[y, both]).max()) if len(both) else 0)
                        lists.append(both)
                starts = np.concatenate([[0], np.cumsum([len(d) for d in lists])])
                pairs = {
                    "pair_a": _ints(np.array(a, np.int64)),
                    "pair_b": _ints(np.array(b, np.int64)),
                    "pair_tops": (tops, pa.list_(pa.int64())),
                    "pair_starts": _ints(starts),
                    "pair_docs": _packed(np.concatenate(lists) if lists else np.zeros(0, np.int64)),
                }
                own = batch.slice(number, 1)
                made = _row(pairs)
                yield pa.RecordBatch.from_arrays([*own.columns, *made.columns], [*own.schema.names, *made.schema.names])

    return blocks.mapInArrow(add, f"{BLOCK_TYPE}, {PAIR_TYPE}")


class Best:
    """The k best ``(score, id)`` of a query so far, ties to the smaller id."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, floor
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def threshold(self) -> int:
        """What a document has to reach."""
        return max(self.floor, int(self.scores[-1])) if len(self.scores) == self.k else self.floor

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        top = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[top], ids[top]


@dataclass
class Unit:
    """One term, or a pair of terms with ``both``, the documents that hold both, and ``either``, what one term gives at most."""

    terms: tuple[bytes, ...]
    bound: int
    either: int = 0
    both: np.ndarray | None = None


class Pairs:
    """The pair lists of a block."""

    def __init__(self, row: dict, order: list[bytes]):
        self.starts, self.docs = row["pair_starts"], row["pair_docs"]
        self.place = {t: i for i, t in enumerate(order)}
        self.tops = {
            (a, b): (top, number)
            for number, (a, b, top) in enumerate(zip(row["pair_a"].tolist(), row["pair_b"].tolist(), row["pair_tops"].tolist()))
        }

    def units(self, maxima: dict[bytes, int]) -> list[Unit]:
        """Units of the terms in ``maxima`` (their greatest impacts), by ascending bound."""
        members = sorted((self.place[t], t) for t in maxima if t in self.place)
        savings = []
        for x, (a, s) in enumerate(members):
            for b, t in members[x + 1 :]:
                joint, number = self.tops[a, b]
                either = max(maxima[s], maxima[t])
                bound = max(joint, either)
                if bound < maxima[s] + maxima[t]:
                    savings.append((maxima[s] + maxima[t] - bound, number, s, t, bound, either))
        units, used = [], set()
        for _, number, s, t, bound, either in sorted(savings, reverse=True):
            if s not in used and t not in used:
                used |= {s, t}
                units.append(Unit((s, t), bound, either, self.docs[self.starts[number] : self.starts[number + 1]]))
        units += [Unit((t,), top) for t, top in maxima.items() if t not in used]
        return sorted(units, key=lambda u: u.bound)


def search_block(block: Block, pairs: Pairs, terms: list[bytes], ids: np.ndarray, best: Best) -> int:
    """Add what the block has for a query; returns how many documents were looked at."""
    maxima = {t: block.postings(t)[2] for t in terms if t in block.at}
    maxima = {t: top for t, top in maxima.items() if top > 0}
    threshold = max(1, best.threshold())
    if sum(maxima.values()) < threshold:
        return 0
    units = pairs.units(maxima)
    before = np.cumsum([0, *(u.bound for u in units)])
    skipped = int(np.searchsorted(before, threshold)) - 1  # units that can't lift a document on their own
    score = np.zeros(block.n_docs, np.int64)
    for unit in units[skipped:]:
        for term in unit.terms:
            docs, impact, _ = block.postings(term)
            score[docs] += impact
    found = np.flatnonzero(score)
    looked = len(found)
    left = np.full(block.n_docs, before[skipped])
    for unit in units[:skipped]:
        if unit.both is not None:  # where not both terms are, less is possible
            less = np.full(block.n_docs, unit.bound - unit.either)
            less[unit.both] = 0
            left -= less
    for unit in reversed(units[:skipped]):
        found = found[score[found] + left[found] >= threshold]
        if not len(found):
            return looked
        if unit.both is None:
            left[found] -= unit.bound
        else:
            less = np.full(block.n_docs, unit.either)
            less[unit.both] = unit.bound
            left[found] -= less[found]
        wanted = np.zeros(block.n_docs, bool)
        wanted[found] = True
        for term in unit.terms:
            docs, impact, _ = block.postings(term)
            own = wanted[docs]
            score[docs[own]] += impact[own]
    found = found[score[found] >= threshold]
    if len(found):
        best.add(score[found], ids[found])
    return looked


@dataclass(frozen=True)
class Index:
    """``blocks``: a stored table. ``frequent``: the terms of the pair lists. ``frequencies``: a stored table ``term, df``."""

    blocks: DataFrame
    frequencies: DataFrame
    frequent: list[bytes]
    n_docs: int
    n_terms: int


def build_index(
    docs: DataFrame, work: str, id_col: str = "doc_id", text_col: str = "text", block_docs: int = BLOCK_DOCS, pair_terms: int = PAIR_TERMS
) -> Index:
    """Index all rows of ``docs``. ``work``: a shared folder."""
    with small_batches(docs.sparkSession):
        plain = staged(index_blocks(docs, id_col, text_col, block_docs), f"{work}/plain", WIDE_ROWS)
        n, terms = plain.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        frequencies = staged(document_frequencies(plain), f"{work}/frequencies")
        frequent = [(bytes(r["term"]), r["df"]) for r in frequencies.orderBy(F.desc("df"), "term").limit(pair_terms).collect()]
        blocks = staged(add_pair_lists(plain, frequent, n, terms), f"{work}/blocks", WIDE_ROWS)
    return Index(blocks, frequencies, [t for t, _ in frequent], n, terms)


def _searched(index: Index, queries: list[tuple[int, list[bytes], int]], weights: dict[bytes, int], k: int) -> DataFrame:
    """``query, id, score``: the best ``k`` of each task for each ``(query, terms, floor)``; a null id is ``NO_ID``."""
    n, terms, frequent = index.n_docs, index.n_terms, index.frequent
    shared = index.blocks.sparkSession.sparkContext.broadcast((queries, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        best = [Best(k, floor) for *_, floor in queries]
        for batch in batches:
            for number in range(batch.num_rows):
                row = _arrays(batch, number)
                block, pairs = Block(row, weights, n, terms), Pairs(row, frequent)
                ids = np.array([NO_ID if i is None else i for i in row["ids"]], np.int64)
                for (_, wanted, _), own in zip(queries, best):
                    search_block(block, pairs, wanted, ids, own)
        for (query, _, _), own in zip(queries, best):
            if len(own.ids):
                yield pa.RecordBatch.from_arrays([pa.array([query] * len(own.ids), pa.int64()), pa.array(own.ids), pa.array(own.scores)], ["query", "id", "score"])

    return index.blocks.drop("n_terms").mapInArrow(search, "query long, id long, score long")


def _floors(index: Index, queries: list[tuple[int, list[bytes], int]], weights: dict[bytes, int], k: int) -> dict[int, int]:
    """A lower bound of each query's kth score: its kth score in a few blocks, of the first files that have any.

    A limit over all files would take that many blocks from each task and bring them all to one.
    """
    path = F.col("_metadata.file_path")
    files = {r[0] for r in index.blocks.select(path).limit(SEED_BLOCKS).collect()}
    seeds = index.blocks.where(path.isin(*files)).limit(SEED_BLOCKS)
    part = Index(seeds, index.frequencies, index.frequent, index.n_docs, index.n_terms)
    scores: dict[int, list[int]] = {}
    for row in _searched(part, queries, weights, k).collect():
        scores.setdefault(row["query"], []).append(row["score"])
    return {q: sorted(s, reverse=True)[k - 1] for q, s in scores.items() if len(s) >= k}


def search(
    index: Index, queries: DataFrame, k: int, work: str, id_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """``query, item, rank, id, score``: the ``k`` best documents for each row of ``queries``, which ``query`` numbers."""
    spark = queries.sparkSession
    slim = queries.select(F.col(id_col).alias("item"), whole_text(text_col).alias("text"))
    asked = staged(slim.withColumn("query", F.monotonically_increasing_id()), f"{work}/queries")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    rounds = max(1, -(-(size[0] + 100 * size[1]) // QUERY_BYTES))
    kind = T.StructType([T.StructField("term", T.BinaryType())])
    for turn in range(rounds):
        rows = asked.where(F.pmod(F.xxhash64("query"), F.lit(rounds)) == turn).select("query", "text").collect()
        wanted = {r["query"]: list(dict.fromkeys(terms_of(r["text"]))) for r in rows}
        distinct = sorted({t for terms in wanted.values() for t in terms})
        named = F.broadcast(spark.createDataFrame([(bytearray(t),) for t in distinct], kind))
        known = index.frequencies.join(named, "term").collect()
        weights = {bytes(r["term"]): weight(r["df"], index.n_docs) for r in known}
        mine = [(q, [t for t in terms if t in weights], 0) for q, terms in wanted.items()]
        with small_batches(spark):
            floors = _floors(index, mine, weights, k)
            found = _searched(index, [(q, terms, floors.get(q, 0)) for q, terms, _ in mine], weights, k)
            found.write.mode("overwrite").parquet(f"{work}/found/round={turn}")
    found = spark.read.schema("query long, id long, score long").option("recursiveFileLookup", True).parquet(f"{work}/found")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ranked = ranked.withColumn("id", F.when(F.col("id") != NO_ID, F.col("id")))
    return ranked.join(asked.select("query", "item"), "query").select("query", "item", "rank", "id", "score")
