"""Exact, line and near duplicates against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from llm_cases import ODD
from pyspark.sql import functions as F

from pageflow.llm import exact_dedup, golay, line_dedup, mixing, prefix_join, simhash, simhash_groups
from pageflow.llm.components import components

WS = re.compile(r"[\x20\x09-\x0D]+")


def exact_brute(rows):
    groups = {}
    for n, (i, t, *_) in enumerate(rows):
        groups.setdefault(WS.sub("", t or ""), []).append((-len(t or ""), i is None, i or 0, n))
    out = []
    for text, members in groups.items():
        best = min(members)
        keep = None if best[1] else best[2]
        for m in members:
            out.append((None if m[1] else m[2], keep, len(members), m == best, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_copies(spark, make_docs, work):
    rows = ODD + [(100 + i, f"hot {'  ' * (i % 3)} copy") for i in range(60)] + [(200 + i, f"single {i}") for i in range(50)]
    got = exact_dedup.mark_copies(make_docs(rows), work()).collect()
    assert sorted(((r.id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in got), key=str) == exact_brute(rows)


def test_exact_copies_are_dropped_with_all_columns(spark, make_docs, work):
    docs = make_docs(ODD)
    left = exact_dedup.drop_copies(docs, work())
    assert left.columns == docs.columns
    assert left.count() == len({WS.sub("", t or "") for _, t in ODD})


def test_only_suspects_are_shuffled(spark, make_docs, work):
    rows = [(i, f"single {i}") for i in range(200)] + [(1000, "twice"), (1001, "twice")]
    slim = make_docs(rows).select(exact_dedup.text_digest("text").alias("digest"))
    bits = exact_dedup.filter_bits(len(rows))
    flagged = exact_dedup.flag_repeats(slim, exact_dedup.repeat_filter(slim, bits), bits)
    suspects = flagged.where("suspect").count()
    assert 2 <= suspects < 30


@pytest.mark.parametrize("operator", [lambda d, w: exact_dedup.mark_copies(d, w), lambda d, w: line_dedup.dedup_lines(d, w), lambda d, w: simhash.near_duplicates(d, w), lambda d, w: simhash_groups.similar_groups(d, w)])
def test_empty_tables(spark, make_docs, work, operator):
    assert operator(make_docs([]), work()).count() == 0


def lines_brute(rows, window=3):
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0, n))
    seen, out = set(), {}
    for n in order:
        text = rows[n][1]
        lines = text.split("\n") if text is not None else []
        gone = set()
        for p in range(len(lines) - window + 1):
            key = tuple(lines[p : p + window])
            if key in seen:
                gone |= set(range(p, p + window))
            seen.add(key)
        out[n] = None if text is None else "\n".join(x for p, x in enumerate(lines) if p not in gone)
    return out


def test_repeated_lines(spark, make_docs, work):
    rng = random.Random(3)
    rows = [r for r in ODD if r[0] != 4]  # the order of rows with one id is that of the table
    rows += [(20 + i, "\n".join(rng.choice("abcd") for _ in range(rng.randint(0, 30)))) for i in range(40)]
    rows += [(90, "x\nx\nx\nx\nx")]
    want = lines_brute(rows)
    got = line_dedup.dedup_lines(make_docs(rows), work()).collect()
    texts = {r.doc.doc_id: r.text for r in got}
    assert len(got) == len(rows)
    assert texts == {rows[n][0]: t for n, t in want.items()}
    assert all(r.n_lines - r.n_removed == len(r.text.split("\n")) for r in got if r.text)


def test_every_word_decodes_within_three_bits():
    words = np.random.default_rng(1).integers(0, 1 << golay.LENGTH, 2000)
    codes = words ^ golay.ERRORS[golay.syndromes(words)]
    assert (np.bitwise_count(codes ^ words) <= 3).all() and not golay.syndromes(codes).any()


def test_neighbours_share_a_codeword_index():
    words = np.random.default_rng(2).integers(0, 1 << 21, 500)
    for bit in range(21):
        mine, other = golay.nearby(words, 21), golay.nearby(words ^ (1 << bit), 21)
        assert all(set(a) & set(b) for a, b in zip(mine, other))
        assert all(len(set(a)) in (1, 6) or len(set(a)) <= 6 for a in mine)


def fingerprint_brute(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark, make_docs):
    rows = [r for r in ODD if r[1] is None or len(r[1]) < 1000] + [(50, "ÀB Çd Éf gh"), (51, "a"), (52, "a b"), (53, "A b c\td")]
    got = {(r.id, r.fp % (1 << 64)) for r in simhash.fingerprints(make_docs(rows)).collect()}
    assert got == {(i, fingerprint_brute(t)) for i, t, *_ in rows}


def brute_components(values, radius=2):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a in values:
        for b in values:
            if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def planted_prints(rng, groups, size, flips):
    out = set()
    for _ in range(groups):
        seed = rng.getrandbits(64)
        out.add(seed)
        for _ in range(size):
            v = seed
            for bit in rng.sample(range(64), rng.randint(1, flips)):
                v ^= 1 << bit
            out.add(v)
    return sorted(v - (1 << 64) if v >= 1 << 63 else v for v in out)


@pytest.mark.parametrize("groups,size,flips", [(30, 4, 4), (1, 250, 3)])
def test_links_connect_all_within_two_bits(spark, work, groups, size, flips):
    values = planted_prints(random.Random(groups), groups, size, flips)
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    folder = work()
    links = simhash.bucket_links(simhash.bucket_keys(nodes), folder)
    assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 2 for r in links.collect())
    roots = {r.node: r.root for r in components(links, folder).collect()}
    assert {v: roots.get(v, v) for v in values} == brute_components(values)


def test_near_duplicates_of_odd_rows(spark, make_docs, work):
    got = simhash.near_duplicates(make_docs(ODD), work()).collect()
    assert len(got) == len(ODD)
    component = {r.id: r.component for r in got}
    assert component[1] == component[2] == component[3] == 1  # no words: fingerprint zero, linked
    assert component[4] == component[5] == 4 and component[6] == component[7] == 6


def test_long_paths_are_one_component(spark, work):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(200, 100), (100, 300)], "a long, b long")
    roots = {r.node: r.root for r in components(links, work()).collect()}
    assert all(roots[i] == 0 for i in range(1, 61)) and roots[200] == roots[300] == 100 and 0 not in roots


def similarity(a, b):
    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def test_similar_groups(spark, make_docs, work):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(800)]
    rows = []
    for g in range(12):
        base = rng.choices(vocabulary, k=rng.randint(80, 200))
        rows.append((1000 * g, " ".join(base)))
        for c in range(1, 4):
            copy = base[:]
            for at in rng.sample(range(len(base)), c - 1):
                copy[at] = "changed"
            rows.append((1000 * g + c, " ".join(copy).upper() if c == 1 else " ".join(copy)))
    hot = rng.choices(vocabulary, k=150)
    for c in range(150):  # one large group of near copies, all close to the first
        copy = hot[:]
        if c:
            copy[rng.randrange(150)] += f"x{c}"
        rows.append((50_000 + c, " ".join(copy)))
    got = {r.id: r.group_id for r in simhash_groups.similar_groups(make_docs(rows), work()).collect()}
    links = [(a, b) for n, (a, s) in enumerate(rows) for b, t in rows[:n] if a // 1000 == b // 1000 and similarity(s, t) >= 0.8]
    missed = sum(got[a] != got[b] for a, b in links)
    assert missed <= 0.02 * len(links)
    assert {got[50_000 + c] for c in range(150)} == {50_000}
    assert all(a // 1000 == g // 1000 for a, g in got.items())


def test_one_document_of_each_group_stays(spark, make_docs, work):
    docs = make_docs(ODD)
    left = simhash_groups.drop_similar(docs, work())
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.where(F.col("doc_id").isNotNull()).collect()) == [1, 4, 6, 8, 9]
    assert left.where(F.col("doc_id").isNull()).count() == 1


def grouped(make_docs, work, texts):
    got = simhash_groups.similar_groups(make_docs(list(enumerate(texts))), work()).collect()
    return {r.id: r.group_id for r in got}


def groups_brute(texts):
    root = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            if root[a] != root[b] and similarity(texts[a], texts[b]) >= 0.8:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return dict(enumerate(root))


def test_no_link_is_lost_in_large_buckets(spark, make_docs, work):
    # Texts over one set of words meet in all buckets: groups of copies that differ in order, and many decoys between.
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(12):
        base = rng.sample(words, 60)
        for cut in (0, 1, 2, 3):
            texts.append(" ".join(base[: 60 - cut] + base[60 - cut :][::-1]))
    rng.shuffle(texts)
    assert grouped(make_docs, work, texts) == groups_brute(texts)


def test_no_pair_of_a_bucket_is_left_out():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 40).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, 38, replace=False), rng.integers(0, 1 << 63, 1).astype(np.uint64)])) for _ in range(150)]
    rows = []
    for node, members in enumerate(sets):
        n = prefix_join.prefix_length(len(members), 0.8)
        keys = prefix_join.ordered(members, np.sort(base), np.full(len(base), 3))[:n]
        rows += [(int(k.view(np.int64)), node, len(members), at, node % 7) for at, k in enumerate(keys)]
    rows.sort()
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + 50])], ["key", "node", "size", "pos", "root"]) for i in range(0, len(rows), 50)]
    met = {(a, b) for batch in prefix_join.pairs_of_sorted(iter(batches), 0.8) for a, b in zip(*(c.to_pylist() for c in batch.columns))}
    alike = {(a, b) for a in range(150) for b in range(a) if a % 7 != b % 7 and len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))}
    assert alike and alike <= met
    assert all(a % 7 != b % 7 for a, b in met)

def test_texts_of_one_fingerprint_meet_each_other(spark, make_docs, work):
    rng = random.Random(9)
    sentences = [" ".join(f"s{i}w{j}" for j in range(12)) for i in range(20)]
    swapped = sentences[:]
    swapped[3], swapped[4] = swapped[4], swapped[3]
    first = " ".join(sentences).split()
    rng.shuffle(first)
    texts = [" ".join(first), " ".join(sentences), " ".join(swapped)]
    assert similarity(texts[1], texts[2]) > 0.8
    assert grouped(make_docs, work, texts) == {0: 0, 1: 1, 2: 1}

@pytest.mark.parametrize("cut", [0.8, 0.85, 0.9])
def test_block_edits(spark, make_docs, work, cut):
    rng = random.Random(int(100 * cut))
    texts = []
    for g in range(25):
        base = [f"g{g}w{rng.randrange(100_000)}" for _ in range(204)]
        kept = 4 + math.ceil(cut * 200)
        added = [f"n{g}w{i}" for i in range(math.floor(200 / cut) - 200)]
        texts += [" ".join(base), " ".join(base[:kept]) if g % 2 else " ".join(base + added)]
    got = grouped(make_docs, work, texts)
    assert all(cut <= similarity(*texts[2 * g : 2 * g + 2]) < cut + 0.02 for g in range(25))
    assert all(got[2 * g + 1] == got[2 * g] == 2 * g for g in range(25))


@pytest.mark.parametrize("operator", ["lines", "exact", "similar", "mix"])
def test_rows_keep_their_numbers_when_the_scan_is_split_anew(spark, make_docs, work, operator):
    rng = random.Random(6)
    passage = "p one\np two\np three"
    rows = [(i, "\n".join(" ".join(rng.choices("abcdefghijklmnop", k=8)) for _ in range(6)) + (f"\n{passage}" if i % 3 == 0 else ""), f"s{i % 2}") for i in range(80)]
    rows += [(100 + i, rows[i][1]) for i in range(10)]
    docs, setting = make_docs(rows, files=8), "spark.sql.files.minPartitionNum"

    def result(later):
        spark.conf.set(setting, "1")
        if operator == "lines":
            done = line_dedup.dedup_lines(docs, work()).select("doc.doc_id", "text")
        elif operator == "exact":
            done = exact_dedup.drop_copies(docs, work()).select("doc_id", "text")
        elif operator == "similar":
            done = simhash_groups.drop_similar(docs, work()).select("doc_id", "text")
        else:
            done = mixing.mixed_texts(docs, mixing.mix(docs, work())).select("doc.doc_id", "turn", "text")
        spark.conf.set(setting, later)
        return sorted(map(tuple, done.collect()))

    try:
        assert result("64") == result("1")
    finally:
        spark.conf.unset(setting)


def test_bucket_pairs_come_once_and_leave_no_node_out():
    """Nodes of one fingerprint meet in one bucket of it; in a bucket no pair comes twice."""
    rng = np.random.default_rng(4)
    base = rng.integers(-(1 << 62), 1 << 62, 30)
    prints = np.concatenate([np.repeat(base[:5], 20), base ^ 1, base ^ (1 << 40)]).reshape(-1, 1)
    row, keys, held = simhash_groups.print_keys(prints)
    met, links = Counter(), set()
    for key in np.unique(keys):
        own = keys == key
        a, b, _ = simhash_groups.block_pairs(row[own], held[own], int(key))
        pairs = list(zip(np.maximum(a, b).tolist(), np.minimum(a, b).tolist()))
        assert len(pairs) == len(set(pairs))
        met.update(p for p in pairs if prints[p[0], 0] == prints[p[1], 0])
        links |= set(pairs)
    assert set(met.values()) == {1} and len(met) == 5 * 19
    # Each of the 30 neighbourhoods is connected.
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    assert len({root(x) for x in range(len(prints))}) == 30
