"""Top-k search, mixing and packing against brute force."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import ODD
from pyspark.sql import functions as F

from pageflow.llm import mixing, packing, topk
from pageflow.llm.common import WORD, numbered


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, query string, v string")


def top_brute(rows, queries, k, scale=256):
    whole = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) and abs(scale * x) <= topk.LARGEST for x in v):
            whole.append((i, [math.floor(scale * float(np.float32(x))) for x in v]))
    out = []
    for q, v in whole:
        if q in queries:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(spark, rows, queries, k, work):
    vectors = table(spark, rows)
    best = topk.top_k(vectors, vectors.where(F.col("vec_id").isin(list(queries))), k, work, scale=256)
    return sorted((r.query_id, r.rank, r.id, r.score) for r in best.collect())


@pytest.mark.parametrize("dims,block", [(3, 64), (32, 8192)])
def test_top_k(spark, work, monkeypatch, dims, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "SEED_ROWS", 40)
    rng = np.random.default_rng(dims)
    rows = [(i, [float(x) for x in rng.normal(size=dims)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)]  # ties
    queries = set(range(0, 400, 50)) | {1003}
    assert found(spark, rows, queries, 5, work()) == top_brute(rows, queries, 5)


def test_top_k_of_odd_vectors(spark, work):
    rows = [(0, [1.0, 2.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
            (None, [9.0, 9.0]), (6, [1.0, 2.0, 3.0]), (7, []), (8, [-1.0, 0.004]), (9, [1e30, 1.0]), (10, [0.5, 0.25])]
    queries = {0, 1, 2, 3, 6, 7}
    assert found(spark, rows, queries, 5, work()) == top_brute(rows, queries, 5)


def test_large_components_take_part(spark, work):
    rng = np.random.default_rng(11)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(60)]
    rows += [(100, [5000.0, 1.0, 0.0, 0.0]), (101, [-5000.0, 2.0, 1.0, 0.0]), (102, [3e6, -2e6, 1e5, 7.0]), (103, [3e6, -2e6, 1e5, 7.0])]
    queries = {0, 1, 100, 102}
    got = found(spark, rows, queries, 5, work())
    assert got == top_brute(rows, queries, 5)
    assert {q for q, *_ in got} == queries and {i for q, _, i, _ in got if q != 100} >= {100, 102, 103}


def test_large_scores_are_exact():
    vectors = np.array([[1 << 40, 3], [-(1 << 40), 5], [7, (1 << 62) + 1]])
    assert topk.exact_scores(vectors, np.array([1 << 22, 1])).tolist() == [(1 << 62) + 3, 5 - (1 << 62), (7 << 22) + (1 << 62) + 1]
    with pytest.raises(OverflowError):
        topk.exact_scores(vectors, np.array([1 << 40, 0]))


def test_top_k_of_nothing(spark, work):
    assert found(spark, [], {0}, 5, work()) == []


def test_blocks_stop_before_their_end():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-100, 100, (4096, 2))
    block, best = topk.Block(np.arange(4096), vectors), topk.Best(1, 5, np.array([-np.inf]))
    scored = []
    add = best.add
    best.add = lambda q, scores, ids: (scored.append(len(ids)), add(q, scores, ids))
    block.search(0, -1, np.array([3, -2]), best)
    assert sum(scored) < 2048
    assert best.scores[0].tolist() == sorted((vectors @ [3, -2]).tolist(), reverse=True)[:5]


def targets_brute(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(order)}
    budget, free, capped = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        level = (budget - sum(capped.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            return capped | {s: level * weight[s] for s in free}
        capped |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    return capped


def corpus(rng, n):
    sources = ["src0"] * 6 + ["src1", "src10", "src2", "Ä", "a b", None, ""]
    return [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.choice([0, 3, 40, 300, 900]))), rng.choice(sources)) for i in range(n)]


def test_mix_meets_targets_and_caps(spark, make_docs, work):
    rows = corpus(random.Random(2), 300) + [(i, t, "odd") for i, t in ODD if i not in (6, 7)]
    docs = make_docs(rows)
    mixed = mixing.mix(docs, work())
    got = mixing.taken_words(mixed).join(numbered(docs, F.col("source")), "row").collect()
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = targets_brute(size)
    assert len(got) == len(rows)
    for s, t in want.items():
        assert target[s] == pytest.approx(t) and abs(taken[s] - t) <= 0.5
    again = mixing.taken_words(mixing.mix(docs, work())).collect()
    assert sorted((str(r.id), r.taken) for r in again) == sorted((str(r.id), r.taken) for r in got)


def test_shards_are_full_and_no_word_is_taken_twice_in_a_pass(spark, make_docs, work, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 16)
    mixed = mixing.mix(make_docs(corpus(random.Random(5), 200)), work())
    spans, shards = defaultdict(list), defaultdict(set)
    for u in mixed.uses.collect():
        spans[u.row, u.turn].append((u.first, u.last))
        shards[u.shard].add(u.place)
    assert all(a[1] <= b[0] for found in spans.values() for a, b in zip(sorted(found), sorted(found)[1:]))
    assert all(places == set(range(16)) for shard, places in shards.items() if shard < max(shards))


def test_mixed_texts_are_the_taken_words(spark, make_docs, work):
    rows = corpus(random.Random(8), 120)
    docs = make_docs(rows)
    mixed = mixing.mix(docs, work())
    words = Counter()
    texts = {i: t for i, t, _ in rows}
    for r in mixing.mixed_texts(docs, mixed).collect():
        words[r.doc.doc_id] += len(r.text.split())
        assert r.text in texts[r.doc.doc_id] or len(r.text.split()) < len(texts[r.doc.doc_id].split())
    assert words == Counter({r.id: r.taken for r in mixing.taken_words(mixed).collect() if r.taken})


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000])
def test_permutations(spark, n):
    one_way = mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(7))
    back = mixing.permuted(F.col("to"), F.lit(n).cast("long"), F.lit(7), inverse=True)
    got = spark.range(n).withColumn("to", one_way).withColumn("back", back).collect()
    assert sorted(r.to for r in got) == list(range(n)) and all(r.back == r.id for r in got)


def test_mix_of_nothing(spark, make_docs, work):
    assert mixing.taken_words(mixing.mix(make_docs([]), work())).count() == 0
    assert mixing.taken_words(mixing.mix(make_docs([(1, None), (2, " ")]), work())).count() == 2


def pack_brute(lengths, sources, clusters, capacity, per_source):
    """Best fit by looking at every bin."""
    bins, out = [], []
    for length, source, cluster in zip(lengths, sources, clusters):
        fit = [
            (capacity - sum(p[0] for p in held), n)
            for n, held in enumerate(bins)
            if 0 < capacity - sum(p[0] for p in held) >= length
            and sum(p[1] == source for p in held) < per_source
            and (cluster < 0 or all(p[2] != cluster for p in held))
        ]
        number = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append([])
        out.append((number, sum(p[0] for p in bins[number])))
        bins[number].append((length, source, cluster))
    return out


@pytest.mark.parametrize("seed", range(5))
def test_best_fit(seed):
    rng = random.Random(seed)
    n = 300
    lengths = sorted((rng.randint(1, 100) for _ in range(n)), reverse=True)
    sources = [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
    clusters = [rng.choice([-1, -1, -1, 0, 1, 2, 3]) for _ in range(n)]
    for per_source in (1, 2):
        assert packing.pack(lengths, sources, clusters, 128, per_source) == pack_brute(lengths, sources, clusters, 128, per_source)


def test_packed_documents(spark, make_docs, work):
    rows = [r for r in ODD if r[0] not in (4,)] + [(i + 100, *r) for i, *r in corpus(random.Random(3), 200)] + [(900 + i, "copy of one text", f"s{i}") for i in range(20)]
    docs = make_docs(rows)
    sizes = Counter()
    for r in docs.select("doc_id", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).alias("n")).collect():
        sizes[r.doc_id] += r.n
    got = packing.pack_documents(docs, work(), capacity=1000, per_source=2).collect()
    held, words, spans = defaultdict(list), Counter(), defaultdict(list)
    for r in got:
        words[r.id] += r.n_words
        assert (r.bin is None) == (r.n_words == 0)
        if r.bin:
            spans[r.bin].append((r.offset, r.offset + r.n_words))
            held[r.bin].append(r.id)
    assert words == sizes
    for parts in spans.values():
        parts.sort()
        assert parts[0][0] == 0 and parts[-1][1] <= 1000 and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    source = {i: s[0] if s else "s" for i, _, *s in rows}
    copies = {i for i, t, *_ in rows if t == "copy of one text"}
    for ids in held.values():
        assert max(Counter(source[i] for i in ids).values()) <= 2 or len(ids) == 1
        assert sum(i in copies for i in ids) <= 1
    assert packing.pack_documents(make_docs([]), work()).count() == 0
