"""Exact top-k by inner product with Fagin's threshold algorithm over sorted per-dimension lists.

Candidates stay where they are read. Each task sorts blocks of them by every dimension. A query walks all lists
of a block at once, from the end that its sign favours, and scores what it meets. The scores at the walking depth
give the most that an unseen vector can reach; when that is below the query's kth score so far, the block is done.
The kth score is carried from block to block of a task, and every task starts from the kth score that each query
reaches on a bounded set of vectors, so late blocks stop early. Queries come in rounds of bounded size, each
broadcast; what a task returns is ``k`` rows a query, and the winners of all tasks are ranked by a window.

Rules
* Components count as ``floor(scale * x)``, scores are exact integers, ties go to the smaller id.
* Rows without an id or vector, or with a null or non-finite component, take no part; nor do those with a component
  that BIGINT can't hold after scaling, for which the contract's SQL has no result either. Only vectors of the
  query's length are its candidates.
* Vectors with a component beyond ``FINE`` after scaling, whose products may not fit a double, are scored one by one
  in integers. A score that BIGINT can't hold is an error.
* Rows with the query's id are the query's own. Each query row gets its ranks; fewer candidates give fewer rows.
* In dimensions that are many against the block, the bound falls late and most of a block is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageflow.llm.common import staged

BLOCK = 8192  # vectors of a block
QUERY_BYTES = 16 << 20  # of a round's broadcast queries
SEED_ROWS = 4096  # vectors whose scores start the thresholds
LARGEST = (1 << 63) - 1024  # of a scaled component: the largest double that BIGINT holds
FINE = 1 << 20  # of a scaled component: products of up to ``FINE_DIMS`` of them fit a double without rounding
FINE_DIMS = 4096


def integer_vectors(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` (array of long) of the rows that take part."""
    x = F.col(vector_col)
    scaled = F.transform(x, lambda e: F.lit(float(scale)) * e.cast("double"))
    fine = F.forall(scaled, lambda e: F.coalesce(F.abs(e) <= F.lit(float(LARGEST)), F.lit(False)) & ~F.isnan(e))
    return vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("id"), F.transform(scaled, lambda e: F.floor(e)).alias("v")
    )


class Best:
    """The k best ``(score, id)`` of each query so far."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor
        self.scores: list[np.ndarray] = [np.zeros(0, np.int64)] * queries
        self.ids: list[np.ndarray] = [np.zeros(0, np.int64)] * queries

    def kth(self, q: int) -> int | float:
        """An unseen vector below this score can't be among the best."""
        own = int(self.scores[q][-1]) if len(self.scores[q]) == self.k else -np.inf
        return max(own, float(self.floor[q]))

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        kth = self.kth(q)
        good = scores >= (int(kth) if np.isfinite(kth) else kth)
        if good.any():
            scores, ids = np.concatenate([self.scores[q], scores[good]]), np.concatenate([self.ids[q], ids[good]])
            top = np.lexsort((ids, -scores))[: self.k]
            self.scores[q], self.ids[q] = scores[top], ids[top]


def fine(vectors: np.ndarray) -> np.ndarray:
    """Which rows have products with each other that a double adds up without rounding."""
    if vectors.shape[1] > FINE_DIMS:
        return np.zeros(len(vectors), bool)
    return (np.abs(vectors) <= FINE).all(axis=1)


def exact_scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in integers of any size; int64 where their sums provably fit."""
    if not vectors.size:
        return np.zeros(len(vectors), np.int64)
    if float(np.abs(vectors).max()) * np.abs(query.astype(np.float64)).sum() < 2.0**62:
        return vectors @ query
    return np.array([int(s) for s in vectors.astype(object) @ query.astype(object)], np.int64)


class Block:
    """Vectors with one list per dimension, sorted by the component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors.astype(np.float64)
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(self.vectors, self.order, axis=0)

    def search(self, q: int, query_id: int, query: np.ndarray, best: Best) -> None:
        rows, dims = self.vectors.shape
        weight = query.astype(np.float64)
        down, up, seen, depth = weight > 0, weight < 0, np.zeros(rows, bool), 0
        step = max(16, rows // 64)
        while depth < rows:
            reach = min(rows, depth + step)
            walk = np.concatenate([self.order[rows - reach : rows - depth, down].ravel(), self.order[depth:reach, up].ravel()])
            new = np.zeros(rows, bool)
            new[walk] = True
            new &= ~seen
            seen |= new
            if not walk.size:  # a query of zeros favours no list
                new[:] = seen[:] = True
                reach = rows
            found = np.flatnonzero(new)
            found = found[self.ids[found] != query_id]
            if found.size:
                best.add(q, (self.vectors[found] @ weight).astype(np.int64), self.ids[found])
            depth, step = reach, step * 2
            if depth < rows:
                bound = self.sorted[rows - depth - 1, down] @ weight[down] + self.sorted[depth, up] @ weight[up]
                if bound < best.kth(q) or seen.all():
                    return


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(ids, vectors)`` of at most ``rows`` vectors of one length."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        ids, lists = batch["id"].to_numpy(), batch["v"]
        lengths = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy()
        starts = np.concatenate([[0], np.cumsum(lengths)])
        for length in np.unique(lengths):
            here = np.flatnonzero(lengths == length)
            vectors = flat[starts[here][:, None] + np.arange(length)]
            parts = held.setdefault(int(length), [])
            parts.append((ids[here], vectors))
            if sum(len(i) for i, _ in parts) >= rows:
                all_ids, all_vectors = (np.concatenate(p) for p in zip(*held.pop(int(length))))
                for at in range(0, len(all_ids), rows):
                    yield all_ids[at : at + rows], all_vectors[at : at + rows]
    for parts in held.values():
        yield tuple(np.concatenate(p) for p in zip(*parts))


def _search(batches: Iterator[pa.RecordBatch], queries, k: int) -> Iterator[pa.RecordBatch]:
    """Best ``k`` of these candidates for each ``(row, id, vector, floor)`` query."""
    best = Best(len(queries), k, np.array([f for *_, f in queries], float))
    for ids, vectors in _blocks(batches, BLOCK):
        low = fine(vectors)
        block, other = Block(ids[low], vectors[low]), ~low
        for q, (_, query_id, query, _) in enumerate(queries):
            if len(query) == vectors.shape[1]:
                if searched := fine(query[None])[0]:
                    block.search(q, query_id, query, best)
                rest = (other if searched else np.ones(len(ids), bool)) & (ids != query_id)
                if rest.any():
                    best.add(q, exact_scores(vectors[rest], query), ids[rest])
    for q, (row, query_id, _, _) in enumerate(queries):
        if n := len(best.ids[q]):
            columns = [pa.array([row] * n, pa.int64()), pa.array([query_id] * n, pa.int64()), pa.array(best.ids[q]), pa.array(best.scores[q])]
            yield pa.RecordBatch.from_arrays(columns, ["query", "query_id", "id", "score"])


def _seeds(queries, seed: list[tuple[int, np.ndarray]], k: int) -> np.ndarray:
    """A lower bound of each query's kth score: its kth score among the seed vectors."""
    floors = np.full(len(queries), -np.inf)
    by_length: dict[int, list[tuple[int, np.ndarray]]] = {}
    for i, v in seed:
        if fine(v[None])[0]:  # a bound from some of them is one all the same
            by_length.setdefault(len(v), []).append((i, v))
    matrices = {n: (np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)) for n, rows in by_length.items()}
    for q, (_, query_id, query) in enumerate(queries):
        if len(query) in matrices and fine(query[None])[0]:
            ids, vectors = matrices[len(query)]
            scores = (vectors @ query.astype(np.float64))[ids != query_id]
            if len(scores) >= k:
                floors[q] = np.partition(scores, -k)[-k]
    return floors


def top_k(vectors: DataFrame, queries: DataFrame, k: int, work: str, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query, query_id, rank, id, score`` of the ``k`` best of ``vectors`` for every row of ``queries``.

    ``query`` numbers the query rows. ``work`` is a shared folder.
    """
    spark = vectors.sparkSession
    candidates = integer_vectors(vectors, scale, id_col, vector_col)
    numbered = staged(
        integer_vectors(queries, scale, id_col, vector_col).withColumn("query", F.monotonically_increasing_id()),
        f"{work}/queries",
    )
    seed = [(r["id"], np.array(r["v"], np.int64)) for r in candidates.limit(SEED_ROWS).collect()]
    size = numbered.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    rounds = max(1, -(-size[0] * (size[1] * 8 + 200) // QUERY_BYTES))
    found = None
    for turn in range(rounds):
        mine = numbered.where(F.pmod(F.xxhash64("query"), F.lit(rounds)) == turn)
        rows = [(r["query"], r["id"], np.array(r["v"], np.int64)) for r in mine.collect()]
        floors = _seeds(rows, seed, k)
        shared = spark.sparkContext.broadcast([(*row, float(f)) for row, f in zip(rows, floors)])

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            return _search(batches, shared.value, k)

        part = candidates.mapInArrow(search, "query long, query_id long, id long, score long")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
