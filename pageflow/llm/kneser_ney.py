"""Scores of texts under an interpolated modified Kneser-Ney model of three words.

Word triples of the training texts are counted in Spark: every task sends sorted runs of counted triples, and the
runs of a context ``(u, v)`` are merged in one place (``runs``). The task that has merged a slot of contexts writes it
as sorted hash arrays into the shared folder: counts of its triples, and for each context its total and how many
of its words were seen once, twice and more often. It sends on how many different words preceded each pair, and from
these the level of pairs and then that of single words are made in the same way. Workers memory-map the arrays of the
contexts that they meet, so a model may be larger than their memory.

With ``c`` the count of a phrase (at lower levels: of the different words before it; raw for pairs at the start of a text)
and ``D`` the level's discount for 1, 2, 3 and more, from its numbers of phrases seen one to four times::

    p(w | h) = (c(h w) - D(c(h w))) / c(h) + (D1 N1(h) + D2 N2(h) + D3 N3(h)) / c(h) * p(w | h without its first word)

Single words are interpolated with the uniform distribution over the ``V`` known tokens and one unknown token.

Rules
* Tokens: words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end; two beginnings stand before a text. Null text
  is empty and has its end only. Texts are scored whole; rows of one id each count and are scored.
* A row is held out by a hash of its id; a null id is never held out. Other columns play no part, names may clash. An
  empty table gives no rows; without training texts every token has the probability of the unknown one, which is 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow.llm import hash_arrays as H
from pageflow.llm import runs, vocabulary
from pageflow.llm.common import drop_staged, shuffles_dropped, staged, whole_text

ABSENT = vocabulary.ABSENT
BEGIN, END = (1 << runs.ID_BITS) - 1, (1 << runs.ID_BITS) - 2
SLICE_BYTES = 4 << 20  # of texts that are encoded at once
WORDS_AT_ONCE = 250_000
TRIPLES_HELD = 4_400_000
COUNTED_ENTRIES = 1_200_000
MAPPED = 16_384  # files of a level that a worker keeps mapped
STATS = -1  # the slot of figures about levels
MANY = 255  # a count of one byte that stands for a larger one


def held_out(id_col: Column | str, parts: int = 7, part: int = 2) -> Column:
    own = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(own.cast("string").cast("binary")) % parts == part, F.lit(False))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in a row, and the place of the text that each is from."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = parts.flatten().cast(pa.binary())
    real = pc.not_equal(pc.binary_length(words), 0)  # white space at an end leaves an empty part
    text = np.repeat(np.arange(len(texts)), parts.value_lengths().to_numpy())
    return words.filter(real), text[real.to_numpy(zero_copy_only=False)]


def slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """``(first, texts)`` of some megabytes each; a longer text is a slice of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        yield first, texts.slice(first, last - first)
        first = last


def sequence(texts: pa.Array, encode: vocabulary.Encoder) -> np.ndarray:
    """The ids of the texts' tokens in a row, two beginnings before and an end behind each text."""
    words, text = words_of(texts)
    ids = np.full(len(words) + 3 * len(texts), BEGIN, np.int64)
    ids[np.arange(len(words)) + 3 * text + 2] = encode(words)
    ids[np.cumsum(np.bincount(text, minlength=len(texts)) + 3) - 1] = END
    return ids


def windows(ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(u, v, w, text)`` of the tokens in a ``sequence``, so many at a time; ``text`` counts from the first."""
    texts = 0
    for at in range(2, len(ids), WORDS_AT_ONCE):
        part = ids[at - 2 : at + WORDS_AT_ONCE]
        u, v, w = part[:-2], part[1:-1], part[2:]
        text, token = texts + np.cumsum(w == END) - (w == END), w != BEGIN
        texts += int((w == END).sum())
        yield u[token], v[token], w[token], text[token]


def count_words(docs: DataFrame) -> DataFrame:
    """``key, n``: all words of ``docs`` (``text, train``) with their occurrences in training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by("key", use_threads=False).aggregate([("n", "sum")]).select(["key", "n_sum"])

        for batch in batches:
            for train in (True, False):
                for _, texts in slices(batch["text"].filter(pc.equal(batch["train"], train))):
                    values, n = pc.value_counts(words_of(texts)[0]).flatten()
                    held.append(pa.table([values, n if train else pa.array(np.zeros(len(n), np.int64))], ["key", "n"]))
                    if sum(map(len, held)) > COUNTED_ENTRIES:
                        held = [summed().rename_columns(["key", "n"])]
                        if len(held[0]) > COUNTED_ENTRIES // 2:
                            yield from out(held.pop())
        if held:
            yield from out(summed())

    def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, n = (c.combine_chunks() for c in table.columns)
        order = pc.sort_indices(keys)  # neighbours that are alike are packed better
        yield pa.RecordBatch.from_arrays([keys.take(order).cast(pa.string()), n.take(order)], ["key", "n"])

    return docs.mapInArrow(count, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))


def triple_runs(train: DataFrame, words: vocabulary.Vocabulary, slots: int) -> DataFrame:
    """Sorted runs of counted triples of tokens, by slot of the context."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary.Encoder(vocabulary.Words(words))
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def counted():
            columns = [np.concatenate(x) for x in zip(*held)]
            held.clear()
            ones = np.broadcast_to(np.int64(1), len(columns[0]))
            yield from runs.by_slot(runs.merged(*(columns.pop(0).astype(np.int64) for _ in range(3)), ones), slots)

        for batch in batches:
            for _, texts in slices(batch["text"]):
                for u, v, w, _ in windows(sequence(texts, encode)):
                    held.append(tuple(x.astype(np.uint32) for x in (u, v, w)))
                    if sum(len(x) for x, *_ in held) > TRIPLES_HELD:
                        yield from counted()
        if held:
            yield from counted()

    return train.mapInArrow(count, runs.RUN_TYPE)


def _groups(run: runs.Run) -> tuple[np.ndarray, np.ndarray]:
    """Where contexts begin in a sorted run, and ``total, n1, n2, n3`` of each."""
    a, b, _, n = run
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(new)
    kinds = np.stack([n, n == 1, n == 2, n > 2], axis=1).astype(np.int64)
    return first, np.add.reduceat(kinds, first, axis=0)


def _kinds(figures: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows of figures, and for each row which of them it is. Rows of large numbers may come several times."""
    small = (figures < 1 << 15).all(axis=1)
    packed = figures[small] @ (1 << np.array([45, 30, 15, 0]))
    keys, of_small = np.unique(packed, return_inverse=True)
    shared = np.stack([keys >> shift & (1 << 15) - 1 for shift in (45, 30, 15, 0)], axis=1)
    kind = np.empty(len(figures), np.int64)
    kind[small] = of_small
    kind[~small] = len(shared) + np.arange((~small).sum())
    return np.concatenate([shared, figures[~small]]), kind


def _arrays(run: runs.Run, phrases: bool) -> dict[str, np.ndarray]:
    """The arrays of a slot: contexts with figures (shared by contexts alike), and phrases with counts if asked."""
    a, b, c, n = run
    first, figures = _groups(run)
    contexts = H.mixed(a[first], b[first])
    order = np.argsort(contexts)
    shared, kind = _kinds(figures[order])
    starts, low = H.compact(contexts[order])
    kind = kind.astype(np.uint16 if len(shared) <= 1 << 16 else np.uint32)
    held = {"context_starts": starts, "context_low": low, "kind": kind, "figures": shared.reshape(-1)}
    if phrases:
        hashes = H.mixed(np.repeat(contexts, np.diff(first, append=len(a))), c)
        by_hash = np.argsort(hashes)
        starts, low = H.compact(hashes[by_hash])
        counts = n[by_hash]
        large = np.flatnonzero(counts >= MANY)
        held |= {"phrase_starts": starts, "phrase_low": low, "counts": np.minimum(counts, MANY).astype(np.uint8)}
        held |= {"large": large, "large_counts": counts[large]}
    return held


def write_slot(path: str, run: runs.Run, phrases: bool = True) -> None:
    H.write_arrays(path, **_arrays(run, phrases))


def _stats(level: int, n: np.ndarray) -> pa.RecordBatch:
    """How many phrases of a level were seen 1, 2, 3 and 4 times (0-3), over twice (4), and the sum (5)."""
    values = np.array([*((n == k).sum() for k in (1, 2, 3, 4)), (n > 2).sum(), n.sum()], np.int64)
    run = (np.full(6, level), np.arange(6), np.zeros(6, np.int64), values)
    return pa.RecordBatch.from_arrays([pa.array([STATS], pa.int32()), pa.array([runs.pack(run)], pa.binary())], ["slot", "run"])


def write_model(triples: DataFrame, folder: str, slots: int, work: str) -> DataFrame:
    """Write the three levels; returns ``level, k, n``, the figures of ``_stats``, to be read before ``work`` goes."""

    def level(number: int, lower: Callable[[runs.Run], runs.Run]) -> Callable[[int, runs.Run], Iterator[pa.RecordBatch | runs.Run]]:
        def done(slot: int, run: runs.Run) -> Iterator[pa.RecordBatch | runs.Run]:
            if slot == STATS:
                yield pa.RecordBatch.from_arrays([pa.array([STATS], pa.int32()), pa.array([runs.pack(run)], pa.binary())], ["slot", "run"])
                return
            write_slot(f"{folder}/{number}/{slot}", run)
            yield _stats(number, run[3])
            yield runs.merged(*lower(run))

        return done

    def pairs(run: runs.Run) -> runs.Run:
        u, v, w, n = run
        return np.zeros_like(v), v, w, np.where(v == BEGIN, n, 1)

    def singles(run: runs.Run) -> runs.Run:
        _, v, w, _ = run
        return np.zeros_like(v), w, np.zeros_like(v), np.ones_like(v)

    def last(slot: int, run: runs.Run) -> Iterator[pa.RecordBatch]:
        if slot != STATS:
            write_slot(f"{folder}/1/{slot}", run, phrases=False)  # a word is a context of its own, with its count as the total
            run = runs.unpack(_stats(1, run[3])["run"][0].as_py())
        yield pa.RecordBatch.from_arrays([pa.array(run[0]), pa.array(run[1]), pa.array(run[3])], ["level", "k", "n"])

    three = staged(runs.merge_slots(triples, level(3, pairs), runs.RUN_TYPE, slots), f"{work}/pairs")
    two = staged(runs.merge_slots(three, level(2, singles), runs.RUN_TYPE, slots), f"{work}/singles")
    drop_staged(triples.sparkSession, f"{work}/pairs")
    one = runs.merge_slots(two, last, "level long, k long, n long")
    return one.groupBy("level", "k").agg(F.sum("n").alias("n"))


def discounts(n: list[int]) -> np.ndarray:
    """``0, D1, D2, D3`` from the numbers of phrases seen one to four times; plain values where these say nothing."""
    if min(n) == 0:
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return np.array([0.0, *(min(max(d, 0.0), float(k)) for k, d in zip((1, 2, 3), raw))])


@dataclass(frozen=True)
class Model:
    """A fitted model; small, the arrays stay in ``folder``."""

    folder: str
    slots: int
    words: vocabulary.Vocabulary
    train_tokens: int
    train_texts: int
    known: int  # different training tokens
    discounts: tuple[tuple[float, ...], ...]  # by level, from single words on
    singles: tuple[int, ...]  # figures of the level of single words


class Level:
    """A worker's view of one level of a model."""

    def __init__(self, model: Model, number: int):
        self.folder, self.slots = f"{model.folder}/{number}", model.slots
        self.discounts = np.array(model.discounts[number - 1])
        self.files: dict[int, dict[str, np.ndarray]] = {}

    def _file(self, slot: int) -> dict[str, np.ndarray]:
        if slot not in self.files:
            if len(self.files) >= MAPPED:
                self.files.clear()
            try:
                arrays = H.map_arrays(f"{self.folder}/{slot}")
            except FileNotFoundError:  # no training text has such a context
                arrays = _arrays((np.zeros(0, np.int64),) * 4, True)
            self.files[slot] = arrays | {"figures": arrays["figures"].reshape(-1, 4)}
        return self.files[slot]

    def _dealt(self, slot: np.ndarray) -> tuple[list[dict[str, np.ndarray]], list[int]]:
        """The files that sorted ``slot`` numbers ask for, and where each begins; those without a file come to an empty one."""
        numbers = np.flatnonzero(np.bincount(slot, minlength=self.slots))
        return [self._file(n) for n in numbers.tolist()], [*np.searchsorted(slot, numbers).tolist(), len(slot)]

    def _sorted(self, slot: np.ndarray) -> np.ndarray:
        return np.argsort(slot.astype(np.uint16) if self.slots <= 1 << 16 else slot, kind="stable")  # small ones by counting

    def contexts(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The total of contexts and the discounts' sum; zeros where absent."""
        slot = (hashes % np.uint64(self.slots)).astype(np.int64)
        order = self._sorted(slot)
        total, rest = np.empty(len(order)), np.empty(len(order))
        total[order], rest[order] = self._contexts(*self._dealt(slot[order]), hashes[order])
        return total, rest

    def _contexts(self, files: list[dict[str, np.ndarray]], cuts: list[int], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        figures = np.zeros((len(hashes), 4), np.int64)
        at = H.find_dealt([(f["context_starts"], f["context_low"]) for f in files], np.array(cuts), hashes)
        for f, begin, end in zip(files, cuts, cuts[1:]):
            if len(f["kind"]):
                figures[begin:end] = f["figures"][f["kind"][at[begin:end]]]  # of the last context for absent ones
        figures[at < 0] = 0
        return figures[:, 0].astype(np.float64), figures[:, 1:] @ self.discounts[1:]

    def _counts(self, files: list[dict[str, np.ndarray]], cuts: list[int], phrases: np.ndarray) -> np.ndarray:
        counts = np.zeros(len(phrases), np.int64)
        at = H.find_dealt([(f["phrase_starts"], f["phrase_low"]) for f in files], np.array(cuts), phrases)
        for f, begin, end in zip(files, cuts, cuts[1:]):
            if len(f["counts"]):
                counts[begin:end] = f["counts"][at[begin:end]]
        counts[at < 0] = 0
        many = np.flatnonzero(counts == MANY)
        number = np.searchsorted(cuts, many, "right") - 1
        for own in np.split(many, np.flatnonzero(np.diff(number)) + 1) if len(many) else []:
            f = files[np.searchsorted(cuts, own[0], "right") - 1]
            counts[own] = f["large_counts"][np.searchsorted(f["large"], at[own])]
        return counts

    def look_up(self, contexts: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of phrases, and of their contexts (hashes) the total and the discounts' sum; zeros where absent."""
        slot = (contexts % np.uint64(self.slots)).astype(np.int64)
        order = self._sorted(slot)
        slot, sorted_contexts = slot[order], contexts[order]
        total, rest = np.empty(len(order)), np.empty(len(order))
        total[order], rest[order] = self._contexts(*self._dealt(slot), sorted_contexts)
        known = np.flatnonzero(total[order])
        counts = np.zeros(len(order), np.int64)
        own = order[known]
        counts[own] = self._counts(*self._dealt(slot[known]), H.mixed(sorted_contexts[known], c[own]))
        return counts, total, rest

    def phrases(self, contexts: np.ndarray, c: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Counts of the phrases of contexts (hashes) that are ``known``, zeros for others."""
        slot = (contexts % np.uint64(self.slots)).astype(np.int64)
        own = np.flatnonzero(known)
        own = own[self._sorted(slot[own])]
        counts = np.zeros(len(c), np.int64)
        counts[own] = self._counts(*self._dealt(slot[own]), H.mixed(contexts[own], c[own]))
        return counts

    def interpolated(self, n: np.ndarray, total: np.ndarray, rest: np.ndarray, lower: np.ndarray) -> np.ndarray:
        kept = n - self.discounts[np.minimum(n, 3)]
        return np.where(total > 0, (kept + rest * lower) / np.maximum(total, 1), lower)


class Reader:
    """A worker's view of a model."""

    def __init__(self, model: Model):
        self.model, self.words = model, vocabulary.Words(model.words)
        self.one, self.two, self.three = (Level(model, number) for number in (1, 2, 3))

    def probabilities(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """``p(w | u v)``; ``ABSENT`` is the unknown token."""
        return self.scored(u, v, w)[1]

    def scored(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of the tokens ``w`` in training texts, and ``p(w | u v)``. What is alike is looked up once."""
        single, place = np.unique(w, return_inverse=True)
        own = np.where(single == END, self.model.train_texts, self.words.counts(np.where(single == END, ABSENT, single)))
        # Most tokens stand before the next one of ``w`` too.
        odd, before = np.ones(len(w), bool), np.empty_like(place)
        odd[1:], before[1:] = v[1:] != w[:-1], place[:-1]
        more, at = np.unique(v[odd], return_inverse=True)
        before[odd] = len(single) + at
        alone = np.concatenate([single, more])
        alone = H.mixed(np.zeros_like(alone), alone)
        n = self.one.contexts(alone[: len(single)])[0].astype(np.int64)
        d, (once, twice, _, _, many, total) = self.one.discounts, self.model.singles
        uniform = 1 / (self.model.known + 1)
        if total:
            one = (n - d[np.minimum(n, 3)]) / total + (d[1:] @ np.array([once, twice, many])) / total * uniform
        else:
            one = np.full(len(single), uniform)
        total, rest = (x[before] for x in self.two.contexts(alone))
        two = self.two.interpolated(self.two.phrases(alone[before], w, total > 0), total, rest, one[place])
        return own[place], self.three.interpolated(*self.three.look_up(H.mixed(u, v), w), two)


def fit(docs: DataFrame, train: Column, work: str, text_col: str = "text") -> Model:
    """A model of the rows of ``docs`` that ``train`` tells. ``work``: a shared, mounted folder."""
    spark = docs.sparkSession
    slim = docs.select(whole_text(text_col).alias("text"), train.alias("train"))
    with shuffles_dropped(spark):
        counted = staged(count_words(slim), f"{work}/counts")
        figures = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
        texts = docs.where(train).count()
        words, table = vocabulary.build(counted, F.col("n") > 0, [], work)
        table.count()
        drop_staged(spark, f"{work}/counts")
        slots, folder = runs.slots_for(figures[0]), f"{H.local_path(work)}/model"
        triples = triple_runs(slim.where("train").select("text"), words, slots)
        found = {(r["level"], r["k"]): r["n"] for r in write_model(triples, folder, slots, work).collect()}
        drop_staged(spark, f"{work}/singles")
    stats = [[found.get((level, k), 0) for k in range(6)] for level in (1, 2, 3)]
    return Model(
        folder,
        slots,
        words,
        figures[0] + texts,
        texts,
        figures[1] + (1 if texts else 0),
        tuple(tuple(discounts(s[:4]).tolist()) for s in stats),
        tuple(stats[0]),
    )


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, n_known, base_score, score`` of every row: sums of log10 probabilities of a text's tokens."""
    slim = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    names = ["id", "n_tokens", "n_known", "base_score", "score"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        encode = vocabulary.Encoder(reader.words)
        room = model.train_tokens + model.known + 1

        for batch in batches:
            for first, texts in slices(batch["text"]):
                totals = [np.zeros(len(texts)) for _ in range(4)]
                for u, v, w, text in windows(sequence(texts, encode)):
                    c, p = reader.scored(u, v, w)
                    for total, values in zip(totals, (None, c > 0, np.log10((c + 1) / room), np.log10(p))):
                        total += np.bincount(text, values, len(texts))
                whole = [pa.array(t.astype(np.int64)) for t in totals[:2]]
                yield pa.RecordBatch.from_arrays([batch["id"].slice(first, len(texts)), *whole, *map(pa.array, totals[2:])], names)

    kinds = {"n_tokens": T.LongType(), "n_known": T.LongType(), "base_score": T.DoubleType(), "score": T.DoubleType()}
    return slim.mapInArrow(scored, T.StructType([slim.schema["id"], *(T.StructField(n, k) for n, k in kinds.items())]))
