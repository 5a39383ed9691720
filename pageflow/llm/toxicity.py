"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text: one on ordinary text, one on the fragments of toxic text
that ordinary text does not hold. Every text is cut into windows of ``WINDOW_WORDS`` words, each compressed with
the ordinary dictionary alone and with the toxic one before it; a window that gets shorter resembles toxic text.
A text's score is a logistic function, calibrated on texts that its dictionaries have not seen, of how much and how
often its windows get shorter.

Fitting uses a bounded sample: at most ``FIT_TOXIC`` and ``FIT_ORDINARY`` labelled rows in order of a hash, texts of
at most ``FIT_TEXT_BYTES``, one of each id (the first by hash). Scoring covers every row and whole texts, in the tasks that read them.

Rules
* Only the text makes the score. A null or empty text is one empty window: the lowest evidence.
* Labels of a repeated id: toxic if any says so; null labels and ids without a document are left out. Without
  both classes every score is the share of toxic labels (0 without labels).
* One row for each input row; other columns and clashing names play no part.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow.llm.common import whole_text

FIT_TOXIC = 1500
FIT_ORDINARY = 2500
FOLDS = 4
FIT_TEXT_BYTES = 65_536
ORDINARY_BYTES = 64 << 10  # sizes of the dictionaries
TOXIC_BYTES = 8 << 10
WINDOW_WORDS = 8
WINDOW_BYTES = 512
GRAM = 5  # bytes of the grams that tell new fragments from ordinary ones
LEVEL = 12
HELD_OUT_OF = 5


def held_out(id_col: Column | str) -> Column:
    """Rows that labels are never learnt from: ``crc32(id as text) % 5 = 0``."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % HELD_OUT_OF == 0, F.lit(False))


def windows(text: str) -> list[bytes]:
    """The text in lower case, in windows of words with single blanks between and around them."""
    words = text.lower().encode().split()
    found = []
    for at in range(0, len(words), WINDOW_WORDS):
        window = b" %b " % b" ".join(words[at : at + WINDOW_WORDS])
        if len(window) <= WINDOW_BYTES:
            found.append(window)
        else:
            found += (window[i : i + WINDOW_BYTES] for i in range(0, len(window), WINDOW_BYTES))
    return found or [b""]


def _trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """A dictionary of the samples' frequent segments; samples that fit as they are make one unchanged."""
    whole = b"".join(sorted(set(samples)))
    if len(whole) <= size:
        return whole
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes()
    except zstandard.ZstdError:
        return whole[-size:]


def _spaced(text: str) -> bytes:
    return b" %b " % b" ".join(text.lower().encode().split())


def _grams(data: bytes) -> np.ndarray:
    """The grams of ``data`` as numbers, by position."""
    raw = np.frombuffer(data, np.uint8).astype(np.uint64)
    n = max(0, len(raw) - GRAM + 1)
    codes = np.zeros(n, np.uint64)
    for i in range(GRAM):
        codes = codes << np.uint64(8) | raw[i : i + n]
    return codes


def _held(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which ``values`` are in the sorted ``ordered``."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def new_fragments(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Runs of grams that no ordinary text holds and several toxic texts do, once per text."""
    common = np.unique(np.concatenate([np.unique(_grams(_spaced(t))) for t in ordinary]))
    texts = [(data, _grams(data)) for data in map(_spaced, toxic)]
    new = np.concatenate([u[~_held(u, common)] for _, codes in texts for u in [np.unique(codes)]])
    grams, spread = np.unique(new, return_counts=True)
    kept = grams[spread >= max(2, len(texts) // 200)]
    fragments: list[bytes] = []
    for data, codes in texts:
        edge = np.diff(np.concatenate([[0], _held(codes, kept).astype(np.int8), [0]]))
        runs = zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))
        fragments += sorted({data[i : j + GRAM - 1] for i, j in runs})
    return fragments


@dataclass(frozen=True)
class Dictionaries:
    ordinary: bytes
    toxic: bytes

    @classmethod
    def train(cls, toxic: list[str], ordinary: list[str]) -> Dictionaries:
        plain = [b" ".join(w) for t in ordinary for ws in [windows(t)] for w in zip(ws[::2], ws[1::2])]
        return cls(_trained(plain, ORDINARY_BYTES, 24), _trained(new_fragments(toxic, ordinary), TOXIC_BYTES, 16))

    def measure(self) -> Callable[[str], tuple[float, ...]]:
        """``text -> evidence``: how much, how often and how far its windows get shorter."""
        ordinary, toxic = _length(self.ordinary), _length(self.toxic + self.ordinary)

        def evidence(text: str) -> tuple[float, ...]:
            gains = np.array([ordinary(w) - toxic(w) for w in windows(text)])
            gains = np.maximum(gains, 0)
            n = len(gains)
            return math.log1p(20 * gains.sum() / n), math.sqrt((gains > 1).sum() / n), math.log1p(gains.sum()), float(min(gains.max(), 12))

        return evidence


def _length(content: bytes) -> Callable[[bytes], int]:
    """Compressed length of a window after ``content``."""
    held = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(level=LEVEL)
    compress = zstandard.ZstdCompressor(
        level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False
    ).compress
    return lambda window: len(compress(window))


@dataclass(frozen=True)
class Model:
    dictionaries: Dictionaries | None
    weights: tuple[float, ...]  # intercept first
    constant: float = 0.0

    def scorer(self) -> Callable[[str], float]:
        if self.dictionaries is None:
            return lambda text: self.constant
        evidence, bias, weights = self.dictionaries.measure(), self.weights[0], self.weights[1:]

        def score(text: str) -> float:
            z = bias + sum(w * x for w, x in zip(weights, evidence(text)))
            return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))

        return score


def calibrate(evidence: np.ndarray, toxic: np.ndarray, share: float) -> tuple[float, ...]:
    """Weights of a logistic regression in which toxic rows weigh ``share`` of all."""
    x = np.column_stack([np.ones(len(evidence)), evidence])
    y = toxic.astype(float)
    weight = np.where(toxic, share / max(y.sum(), 1), (1 - share) / max((1 - y).sum(), 1)) * len(y)
    ridge = np.diag([1e-6] + [0.1] * evidence.shape[1])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge @ w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def fit_texts(toxic: list[str], ordinary: list[str], share: float) -> Model:
    """Dictionaries of all given texts; weights from evidence by dictionaries that have not seen the text."""
    evidence, labels = [], []
    for fold in range(min(FOLDS, len(toxic), len(ordinary))):
        bad, good = toxic[fold::FOLDS], ordinary[fold::FOLDS]
        rest = ([t for i, t in enumerate(texts) if i % FOLDS != fold] for texts in (toxic, ordinary))
        measure = Dictionaries.train(*rest).measure()
        evidence += [measure(t) for t in bad + good]
        labels += [True] * len(bad) + [False] * len(good)
    return Model(Dictionaries.train(toxic, ordinary), calibrate(np.array(evidence), np.array(labels), share))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from the labelled rows that are not held out."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    counts = {r["toxic"] > 0: r["n"] for r in known.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    bad, good = counts.get(True, 0), counts.get(False, 0)
    if min(bad, good) < 2:
        return Model(None, (), bad / (bad + good) if bad + good else 0.0)
    order = (F.xxhash64("id"), F.col("id"))
    picked = known.where("toxic > 0").orderBy(*order).limit(FIT_TOXIC).unionByName(
        known.where("toxic <= 0").orderBy(*order).limit(FIT_ORDINARY)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.octet_length("text") <= FIT_TEXT_BYTES)
    # One text per id, combined on the map side: the driver gets no more rows than were picked.
    one = F.min(F.struct(F.xxhash64("text").alias("order"), "text"))
    rows = texts.join(F.broadcast(picked), "id").groupBy("id", "toxic").agg(one.alias("one")).select("id", "toxic", "one.text").collect()
    rows = sorted((r["id"], r["toxic"], r["text"]) for r in rows)
    toxic, ordinary = ([t for _, label, t in rows if (label > 0) == wanted] for wanted in (True, False))
    if min(len(toxic), len(ordinary)) < 2:
        return Model(None, (), bad / (bad + good))
    return fit_texts(toxic, ordinary, bad / (bad + good))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``doc`` (the input row as a struct) and ``score`` for every row."""
    names = docs.select(F.struct("*").alias("doc"), whole_text(text_col).alias("text"))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scored = model.scorer()
        for batch in batches:
            values = pa.array((scored(t) for t in batch["text"].to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([batch["doc"], values], ["doc", "score"])

    return names.mapInArrow(scores, T.StructType([names.schema["doc"], T.StructField("score", T.DoubleType())]))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose score reaches ``limit``."""
    return score(docs, model, text_col).where(F.col("score") < limit).select("doc.*")
