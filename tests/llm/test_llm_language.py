"""Collocations, the language model and ranked search against brute force."""

from __future__ import annotations

import math
import os
import random
import re
import time
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from llm_cases import ODD
from pyspark.sql import functions as F

from pageflow.llm import collocations, common, hash_arrays, hat_trie, kneser_ney, lexical_search, runs, vocabulary

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def prose(rng, n, words=30):
    known = [w + e for w in ("a", "The", "of", "ä", "q1", "x-y", "Zz") for e in ("", "s", "é")][:words]
    out = []
    for i in range(n):
        text = " ".join(rng.choice(known[:4] if rng.random() < 0.5 else known) for _ in range(rng.choice([0, 1, 2, 7, 40])))
        out.append(re.sub(r" (?=\S+ \S+ \S)", lambda m: rng.choice([" ", "  ", ". ", ",", "\n", "\t"]) if rng.random() < 0.2 else " ", text))
    return out


def docs_with_langs(make_docs, rows):
    """``(doc_id, text, lang)``; ``make_docs`` stores the language as source."""
    docs = make_docs([(i, t, lang) for i, t, lang in rows], files=3)
    return docs.withColumn("lang", F.col("source"))


# -- shared parts ---------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 9, 1000, 50_000])
def test_hash_arrays_find_what_they_hold(tmp_path, n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1))
    starts, low = hash_arrays.compact(keys)
    path = str(tmp_path / "deep" / "file")
    hash_arrays.write_arrays(path, starts=starts, low=low, keys=keys)
    arrays = hash_arrays.map_arrays(path)
    order = rng.permutation(len(keys))
    assert (hash_arrays.find_compact(arrays["starts"], arrays["low"], keys[order]) == order).all()
    assert (hash_arrays.find_sorted(arrays["keys"], keys[order]) == order).all()
    absent = rng.integers(0, 1 << 63, 500, np.uint64) * np.uint64(2)
    assert (hash_arrays.find_compact(arrays["starts"], arrays["low"], absent) == -1).all()
    assert (hash_arrays.find_sorted(arrays["keys"], absent) == -1).all()


def test_only_mounted_folders_are_taken():
    assert hash_arrays.local_path("file:///a/b") == "/a/b" and hash_arrays.local_path("/a/b") == "/a/b"
    with pytest.raises(ValueError):
        hash_arrays.local_path("hdfs://host/a")


def test_runs_are_packed_and_merged():
    rng = np.random.default_rng(3)
    top = (1 << runs.ID_BITS) - 1
    a, b, c = (rng.choice([0, 1, 5, top], 2000) for _ in range(3))
    n = rng.integers(1, 1 << 40, 2000)
    want = Counter()
    for key, value in zip(zip(a.tolist(), b.tolist(), c.tolist()), n.tolist()):
        want[key] += value
    run = runs.merged(a, b, c, n)
    assert list(zip(zip(*(x.tolist() for x in run[:3])), run[3].tolist())) == sorted(want.items())
    assert all((x == y).all() for x, y in zip(runs.unpack(runs.pack(run)), run))
    parts = [(batch["slot"][i].as_py(), runs.unpack(batch["run"][i].as_py())) for batch in runs.by_slot(run, 7) for i in range(batch.num_rows)]
    again = runs.merged(*(np.concatenate(x) for x in zip(*(r for _, r in parts))))
    assert all((x == y).all() for x, y in zip(again, run))
    assert all((runs.slot_of(r[0], r[1], 7) == slot).all() for slot, r in parts)


def test_counts_of_a_run_take_the_bytes_they_need():
    ids = np.arange(3000)
    for most, width in [(1, 1), (255, 1), (256, 2), (1 << 16, 4), (1 << 40, 8)]:
        packed = runs.pack((ids, ids, ids, np.where(ids == 7, most, 1)))
        assert packed[7] == width and runs.unpack(packed)[3].tolist() == [most if i == 7 else 1 for i in ids]


def test_runs_of_a_task_are_sent_on_together(spark, work):
    rng, slots = np.random.default_rng(6), 64
    run = runs.merged(*(rng.integers(0, 400, 20_000) for _ in range(3)), np.ones(20_000, np.int64))
    triples = spark.createDataFrame(pa.Table.from_batches(runs.by_slot(run, slots))).coalesce(1)
    folder = work()
    kneser_ney.write_model(triples, f"{folder}/model", slots, folder).collect()
    sent = [runs.unpack(r.run) for r in spark.read.parquet(f"{folder}/singles").where("slot >= 0").collect()]
    assert len(sent) <= 8 * slots  # one for each task and slot, not for each pair of slots
    assert sum(r[3].sum() for r in sent) == len(set(zip(run[1].tolist(), run[2].tolist())))


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for top in disk.localDirsString() for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def test_fitting_leaves_no_shuffle_files(spark, make_docs, work):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(name)
    folder = work()
    kneser_ney.fit(make_docs(list(enumerate(prose(random.Random(3), 50)))), F.lit(True), folder)
    for _ in range(50):  # they go in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(name) == setting
    assert sorted(os.listdir(folder)) == ["model", "vocabulary"]


def test_words_are_hashed_as_spark_does(spark):
    rng = random.Random(7)
    keys = [bytes(rng.randrange(256) for _ in range(n)) for n in range(70) for _ in range(5)]
    for held in (pa.array(keys, pa.binary()), pa.array([b"ab", *keys], pa.binary()).slice(1), pa.array([], pa.binary())):
        assert vocabulary.xxh64(held, vocabulary.SEED).tolist() == [xxhash.xxh64_intdigest(k, vocabulary.SEED) for k in held.to_pylist()]
    rows = spark.createDataFrame([(k,) for k in keys], "key binary").select("key", F.xxhash64("key").alias("h")).collect()
    assert vocabulary.xxh64(pa.array([r.key for r in rows], pa.binary()), 42).view(np.int64).tolist() == [r.h for r in rows]


def test_files_are_searched_together():
    rng = np.random.default_rng(11)
    held = [np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2)) for n in (5000, 0, 1, 300)]
    asked = [np.concatenate([rng.permutation(h), rng.integers(0, 1 << 63, k, np.uint64) * np.uint64(2) + np.uint64(1)]) for h, k in zip(held, (10, 9, 0, 40))]
    got = hash_arrays.find_dealt([hash_arrays.compact(h) for h in held], np.cumsum([0, *map(len, asked)]), np.concatenate(asked))
    assert got.tolist() == np.concatenate([hash_arrays.find_sorted(h, a) for h, a in zip(held, asked)]).tolist()
    skewed = np.arange(100_000, dtype=np.uint64)  # all in the first bucket, further from its share than two bytes tell
    starts, low = hash_arrays.compact(skewed << np.uint64(20))
    assert starts.dtype == np.int64 and starts[1] + (len(skewed) >> (len(starts) - 1).bit_length() - 1) == len(skewed)


def test_the_trie_counts_through_bursts_and_spills(monkeypatch):
    monkeypatch.setattr(hat_trie, "BURST", 5)
    rng, want, held = np.random.default_rng(1), Counter(), []
    trie = hat_trie.HatTrie(60)
    for _ in range(40):
        a, b, c = rng.integers(0, 3, 50), rng.integers(0, 6, 50), rng.integers(-1, 4, 50)
        want.update(zip(a.tolist(), b.tolist(), (c + 1).tolist()))
        trie.add(a, hat_trie.rests(b, c))
        while trie.full():
            held.append(trie.spill(30))
            assert trie.entries <= 30
    held.append(trie.spill())
    assert trie.entries == 0 and not trie.containers and not trie.nodes
    for a, b, c, _ in held:
        keys = list(zip(a.tolist(), b.tolist(), c.tolist()))
        assert keys == sorted(set(keys))
    run = runs.merged(*(np.concatenate(x) for x in zip(*held)))
    assert dict(zip(zip(*(x.tolist() for x in run[:3])), run[3].tolist())) == want


# -- collocations -----------------------------------------------------------------------------------


def collocations_brute(rows, least, top):
    grams, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            total[lang] += len(words)
            for k in (1, 2, 3):
                grams[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in grams.items():
        found = []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            score, k, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            longer = [n for q, n in candidates.items() if len(q) > len(p) and p in (q[:2], q[1:])]
            if not any(100 * n >= 50 * a for n in longer):
                found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("entries", [50, 100_000])
def test_collocations(spark, make_docs, work, entries):
    rng = random.Random(4)
    rows = [(i, t, rng.choice(["en", "en", "de", None, "und", ""])) for i, t in enumerate(prose(rng, 400))]
    rows += [(i, t, "odd") for i, t in ODD if i not in (6, 7)] + [(9, "one two three. One two three, one two", "odd")] * 3
    got = collocations.collocations(docs_with_langs(make_docs, rows), work(), least=3, top=25, trie_entries=entries)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == collocations_brute(rows, 3, 25)


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 3_000_000_019, 3_000_000_021, 3_100_000_003
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(collocations._score("a", "l", "r").alias("s")).first()
    assert row.s == 10**6 * a * a // (l * r)


def test_collocations_of_nothing(spark, make_docs, work):
    assert collocations.collocations(docs_with_langs(make_docs, []), work()).collect() == []
    assert collocations.collocations(docs_with_langs(make_docs, [(1, None, None), (2, "", "en")]), work(), least=1).collect() == []


# -- language model -----------------------------------------------------------------------------------


class BruteModel:
    """Interpolated modified Kneser-Ney of order three over dictionaries."""

    def __init__(self, texts):
        three = Counter()
        self.tokens = Counter()
        for text in texts:
            t = ["<s>", "<s>", *text, "</s>"]
            self.tokens.update(t[2:])
            three.update(zip(t, t[1:], t[2:]))
        two, one = Counter(), Counter()
        for (u, v, w), n in three.items():
            two[v, w] += n if v == "<s>" else 1
        for v, w in two:
            one[w] += 1
        self.levels = [one, two, three]
        self.d = []
        for counts in self.levels:
            n = [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
            if min(n) == 0:
                self.d.append((0.5, 1.0, 1.5))
                continue
            y = n[0] / (n[0] + 2 * n[1])
            raw = (1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2])
            self.d.append(tuple(min(max(x, 0.0), k) for k, x in zip((1, 2, 3), raw)))
        self.contexts = [defaultdict(dict), defaultdict(dict), defaultdict(dict)]
        for w, n in one.items():
            self.contexts[0][()][w] = n
        for (v, w), n in two.items():
            self.contexts[1][v,][w] = n
        for (u, v, w), n in three.items():
            self.contexts[2][u, v][w] = n

    def p(self, history, w):
        if history is None:
            return 1 / (len(self.tokens) + 1)
        level = len(history)
        lower = self.p(history[1:] if level else None, w)
        seen = self.contexts[level].get(history)
        if not seen:
            return lower
        discount = lambda n: self.d[level][min(n, 3) - 1]
        total, n = sum(seen.values()), seen.get(w, 0)
        rest = sum(discount(m) for m in seen.values())
        return ((n - discount(n) if n else 0) + rest * lower) / total

    def score(self, text):
        t = ["<s>", "<s>", *text, "</s>"]
        return sum(math.log10(self.p((t[i - 2], t[i - 1]), t[i])) for i in range(2, len(t)))


def lm_words(text):
    return re.findall(r"[^ \t\n\x0b\x0c\r]+", (text or "").translate(UPPER))


def test_scores_follow_the_model(spark, make_docs, work):
    rng = random.Random(8)
    rows = list(enumerate(prose(rng, 300))) + [r for r in ODD if r[0] not in (6, 7)] + [(700, "never seen before")]
    docs = make_docs(rows)
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    assert any(out(i) for i, _ in rows) and not out(None)
    model = kneser_ney.fit(docs, ~kneser_ney.held_out("doc_id"), work())
    brute = BruteModel([lm_words(t) for i, t in rows if not out(i)])
    n, v = sum(brute.tokens.values()), len(brute.tokens)
    assert (model.train_tokens, model.known) == (n, v)
    want = []
    for i, t in rows:
        tokens = [*lm_words(t), "</s>"]
        base = sum(math.log10((brute.tokens[w] + 1) / (n + v + 1)) for w in tokens)
        want.append((str(i), len(tokens), sum(brute.tokens[w] > 0 for w in tokens), base, brute.score(lm_words(t))))
    got = [(str(r.id), r.n_tokens, r.n_known, r.base_score, r.score) for r in kneser_ney.score(docs, model).collect()]
    assert len(got) == len(want)
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-9)
    held = {str(r.doc_id): r.h for r in docs.select("doc_id", kneser_ney.held_out("doc_id").alias("h")).collect()}
    assert held == {str(i): out(i) for i, _ in rows}


def test_probabilities_sum_to_one(spark, make_docs, work):
    texts = prose(random.Random(2), 200)
    model = kneser_ney.fit(make_docs(list(enumerate(texts))), F.lit(True), work())
    reader = kneser_ney.Reader(model)
    words = sorted({w for t in texts for w in lm_words(t)})
    ids = reader.words.ids([w.encode() for w in words])
    every = np.concatenate([ids, [kneser_ney.END, kneser_ney.ABSENT]])
    assert len(every) == model.known + 1
    for u, v in [(kneser_ney.BEGIN, kneser_ney.BEGIN), (kneser_ney.BEGIN, ids[0]), (ids[1], ids[2]), (ids[3], kneser_ney.ABSENT), (kneser_ney.ABSENT, ids[4])]:
        p = reader.probabilities(np.full(len(every), u), np.full(len(every), v), every)
        assert p.sum() == pytest.approx(1) and (p > 0).all()


def test_words_are_those_of_the_contract():
    texts = [" a  B\x0b\x1cc\u3000D ", "", "x", "\t\n\x0c\r", "\xc9 \xc0b"]
    words, text = kneser_ney.words_of(pa.array(texts))
    assert list(zip(text.tolist(), words.to_pylist())) == [(i, w) for i, t in enumerate(texts) for w in t.encode().lower().split()]
    assert [(first, part.to_pylist()) for first, part in kneser_ney.slices(pa.array(texts))] == [(0, texts)]


def test_windows_cut_long_texts(monkeypatch):
    texts = pa.array(["a b c d e f g", "", " ", "h", "i j"])
    ids = {w: i for i, w in enumerate(b"a b c d e f g h i j".split())}
    encode = lambda words: np.array([ids[w] for w in words.to_pylist()], np.int64)
    B, E = kneser_ney.BEGIN, kneser_ney.END
    whole = kneser_ney.sequence(texts, encode)
    assert whole.tolist() == [B, B, 0, 1, 2, 3, 4, 5, 6, E, B, B, E, B, B, E, B, B, 7, E, B, B, 8, 9, E]
    want = [np.concatenate(x).tolist() for x in zip(*kneser_ney.windows(whole))]
    assert want[2] == [0, 1, 2, 3, 4, 5, 6, E, E, E, 7, E, 8, 9, E] and want[3] == [0] * 8 + [1, 2, 3, 3, 4, 4, 4]
    assert want[0][:3] == [B, B, 0] and want[1][:3] == [B, 0, 1]
    for n in (1, 2, 3, 5, 8):
        monkeypatch.setattr(kneser_ney, "WORDS_AT_ONCE", n)
        assert [np.concatenate(x).tolist() for x in zip(*kneser_ney.windows(whole))] == want
    for n in (1, 6, 9):
        monkeypatch.setattr(kneser_ney, "SLICE_BYTES", n)
        assert [t for _, part in kneser_ney.slices(texts) for t in part.to_pylist()] == texts.to_pylist()


def test_contexts_share_kinds():
    rng = np.random.default_rng(5)
    figures = rng.choice([0, 1, 2, 1 << 14, 1 << 15, 1 << 40], (500, 4))
    shared, kind = kneser_ney._kinds(figures)
    assert (shared[kind] == figures).all() and kneser_ney._kinds(figures[:0])[0].shape == (0, 4)


@pytest.mark.parametrize("train", [True, False])
def test_models_of_few_texts(spark, make_docs, work, train):
    for rows in ([], [(1, None)], [(1, "a b"), (2, "c")]):
        docs = make_docs(rows)
        model = kneser_ney.fit(docs, F.lit(train), work())
        got = kneser_ney.score(docs, model).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r.score <= 0 and math.isfinite(r.score) and (train or r.score == r.base_score == 0)


# -- ranked search --------------------------------------------------------------------------------------


def search_brute(rows, queries, k):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(UPPER))
    docs = [(i, Counter(terms(t))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in queries:
        found = []
        for i, c in docs:
            m = 50 + 50 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(str(item), rank, str(i), -s) for rank, (s, _, _, i) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1)]
    return sorted(out)


def test_search(spark, make_docs, work):
    rng = random.Random(6)
    rows = list(enumerate(prose(rng, 500))) + ODD + [(500 + i, "the of a q1 rare%d" % (i % 9)) for i in range(60)]
    rng.shuffle(rows)
    queries = [(i, t) for i, t in enumerate(prose(rng, 40))] + [(3, "same text here"), (3, "same text here"), (None, "rare1 THE"), (50, None), (51, "unheard-of!")]
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in queries], "item_id long, text string, query string, rank int")
    docs = make_docs(rows, files=3)
    for block_docs, pair_terms in ((16, 8), (4096, 0), (64, 32)):
        index = lexical_search.build_index(docs, work(), block_docs=block_docs, pair_terms=pair_terms)
        got = lexical_search.search(index, asked, 10, work()).collect()
        assert sorted((str(r.item), r["rank"], str(r.id), r.score) for r in got) == search_brute(rows, queries, 10)


def test_pair_bounds_skip_more_than_single_ones(spark, make_docs, work):
    """Two frequent terms that never meet: together they are bounded by one of them."""
    rows = [(i, ("left " if i % 2 else "right ") + ("rare " if i % 50 == 0 else "") + "pad " * (i % 7)) for i in range(2000)]
    index = lexical_search.build_index(make_docs(rows, files=1), work(), pair_terms=3)
    row = index.blocks.toArrow().to_batches()[0]
    arrays = lexical_search._arrays(row, 0)
    weights = {bytes(r.term): lexical_search.weight(r.df, index.n_docs) for r in index.frequencies.collect()}
    block = lexical_search.Block(arrays, weights, index.n_docs, index.n_terms)
    terms = [b"left", b"right"]
    maxima = {t: block.postings(t)[2] for t in terms}
    (unit,) = lexical_search.Pairs(arrays, index.frequent).units(maxima)
    assert len(unit.both) == 0 and unit.bound == max(maxima.values()) < sum(maxima.values())
    ids = np.array(arrays["ids"], np.int64)
    floor = max(maxima.values()) + 1
    looked = [
        lexical_search.search_block(block, pairs, [*terms, b"rare"], ids, lexical_search.Best(5, floor))
        for pairs in (lexical_search.Pairs(arrays, index.frequent), lexical_search.Pairs(arrays, []))
    ]
    assert looked[0] == 40 < looked[1]


def test_search_of_nothing(spark, make_docs, work):
    asked = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for rows in ([], [(1, None), (2, " .,")]):
        index = lexical_search.build_index(make_docs(rows), work())
        assert lexical_search.search(index, asked, 5, work()).collect() == []
    index = lexical_search.build_index(make_docs([(1, "a")]), work())
    assert lexical_search.search(index, asked.limit(0), 5, work()).collect() == []


@pytest.mark.parametrize("values", [[], [0], [3, 0, 255], [256], [65_535, 1], [65_536, 7], [2**31 - 1]])
def test_lists_of_blocks_are_packed(values):
    data, kind = lexical_search._packed(np.array(values, np.int64))
    assert lexical_search._unpacked(pa.scalar(data, kind)).tolist() == values
    assert len(data) - 1 == len(values) * (1 if max(values, default=0) < 256 else 2 if max(values) < 65_536 else 4)


def test_blocks_are_held_a_few_at_once(spark, make_docs, work, monkeypatch):
    """A task's memory doesn't follow how many blocks its file has: small row groups, and small batches in all steps."""
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) + " the of") for i in range(480)]
    names = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before, wide = {n: spark.conf.get(n) for n in names}, {n: v for n, v in zip(names, ("4096", "10000", "64m"))}
    seen = []

    def staged(df, folder, *more):
        seen.append(tuple(spark.conf.get(n) for n in names))
        return common.staged(df, folder, *more)

    monkeypatch.setattr(lexical_search, "staged", staged)
    try:
        for n, v in wide.items():
            spark.conf.set(n, v)
        folder = work()
        monkeypatch.setitem(getattr(common, "WIDE_ROWS", {}), "parquet.block.size", 30_000)
        lexical_search.build_index(make_docs(rows, files=1), folder, block_docs=4)
        assert len(seen) == 3 and set(seen) == {("256", "256", "8m")}
        assert {n: spark.conf.get(n) for n in names} == wide
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    for name in ("plain", "blocks"):
        (file,) = [f"{folder}/{name}/{f}" for f in os.listdir(f"{folder}/{name}") if f.endswith(".parquet")]
        found = pq.ParquetFile(file).metadata
        assert found.num_rows == 120 and max(found.row_group(i).num_rows for i in range(found.num_row_groups)) < 40


def test_floors_come_from_a_few_files(spark, make_docs, work):
    rows = [(i, "the of a " + "rare " * (i % 5)) for i in range(400)]
    queries = [(0, [b"rare", b"of"], 0), (1, [b"the"], 0)]
    group, cost = uuid.uuid4().hex, spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1g")  # a task for each file
    try:
        index = lexical_search.build_index(make_docs(rows, files=40), work())
        weights = {bytes(r.term): lexical_search.weight(r.df, index.n_docs) for r in index.frequencies.collect()}
        assert index.blocks.rdd.getNumPartitions() == 40
        spark.sparkContext.setJobGroup(group, "floors")
        floors = lexical_search._floors(index, queries, weights, 5)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    status = spark.sparkContext.statusTracker()
    stages = {s for job in status.getJobIdsForGroup(group) for s in status.getJobInfo(job).stageIds}
    assert 0 < sum(status.getStageInfo(s).numTasks for s in stages) < 25
    scores = lexical_search._searched(index, queries, weights, 400).toPandas()
    assert 0 in floors
    for query, floor in floors.items():
        assert 0 < floor <= sorted(scores[scores["query"] == query]["score"], reverse=True)[4]
