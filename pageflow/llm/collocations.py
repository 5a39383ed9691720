"""Phrases of two and three words that hold together, by language.

Words are counted first. The frequent ones of each language get ids in a memory-mapped vocabulary; a phrase with a
rarer word cannot be frequent. Each task then counts the phrases of its texts in a HAT-trie of word ids
(``hat_trie``). What the trie has no room for leaves it as sorted runs of whole subtrees; the runs of a prefix, of
all tasks, are merged in one place (``runs``). Frequent phrases are few; they are scored, compared with the longer ones
that hold them, and ranked with DataFrame operations.

Rules
* A-Z are lower-cased. Texts are cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into words ``[^\\x20\\x09]+``; phrases
  stay within a piece, overlapping occurrences count. Null text is empty; null language is ``und``.
* ``a`` is the phrase's count; cutting it into a first part and a rest with counts ``l`` and ``r`` gives
  ``floor(1000000 * a * a / (l * r))`` in exact integers; the lowest cut counts, ties to the shorter first part.
* A phrase goes if a longer candidate (that goes itself or not) holds it and is at least half as frequent.
* Ties in rank: higher ``a``, then the phrase by its bytes. Repeated ids, other columns and clashing names play no part;
  every row's text counts. Languages without candidates and empty tables give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageflow.llm import runs, vocabulary
from pageflow.llm.common import staged, whole_text
from pageflow.llm.hat_trie import HatTrie, rests

LEAST = 10  # occurrences of a candidate
TOP = 2000  # phrases of a language in a report
COVER = 50  # per cent of a phrase's occurrences inside a longer one
TRIE_ENTRIES = 800_000
WORDS_AT_ONCE = 500_000
COUNTER_ENTRIES = 500_000

# What ends a piece, and the letters that are lower-cased.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
END = PIECE_ENDS[:1]
_TABLE = bytes.maketrans(UPPER + PIECE_ENDS, LOWER + END * len(PIECE_ENDS))


def words_and_ends(text: str) -> list[bytes]:
    """The words of a text, and ``END`` where a piece ends."""
    return text.encode().translate(_TABLE).replace(END, b" " + END + b" ").split()


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), whole_text(text_col).alias("text"))


def count_words(texts: DataFrame) -> DataFrame:
    """``key, lang, word, n``; ``key`` is the word, a space and the language."""
    names = ["lang", "word", "n"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, Counter] = {}

        def out():
            for lang, counter in counters.items():
                counter.pop(END, None)
                words = pa.array(list(counter), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words)), words, pa.array(list(counter.values()), pa.int64())], names)
            counters.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                counters.setdefault(lang, Counter()).update(words_and_ends(text.as_py()))
                if sum(map(len, counters.values())) > COUNTER_ENTRIES:
                    yield from out()
        yield from out()

    counted = texts.mapInArrow(count, "lang string, word string, n long")
    summed = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return summed.select(F.concat("word", F.lit(" "), "lang").alias("key"), "lang", "word", "n")


def phrase_runs(texts: DataFrame, words: vocabulary.Vocabulary, slots: int, entries: int = TRIE_ENTRIES) -> DataFrame:
    """Sorted runs of the phrases of two and three words, by slot of their prefix. ``entries``: of a trie at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.Words(words)
        encoders: dict[str, vocabulary.Encoder] = {}
        trie = HatTrie(entries)
        waiting: dict[str, list[bytes]] = {}

        def take(lang: str):
            if lang not in encoders:
                if len(encoders) >= 4:  # languages with a memory of their words
                    encoders.clear()
                encoders[lang] = vocabulary.Encoder(known, b" " + lang.encode(), {END: vocabulary.ABSENT})
            held = waiting.pop(lang)
            for at in range(0, len(held), WORDS_AT_ONCE):  # phrases that begin here reach two words further
                ids = encoders[lang](held[at : at + WORDS_AT_ONCE + 2])
                n = min(WORDS_AT_ONCE, len(ids))
                ids = np.concatenate([ids, np.full(2, vocabulary.ABSENT)])
                a, b, c = ids[:n], ids[1 : n + 1], ids[2 : n + 2]
                two = (a >= 0) & (b >= 0)
                three = two & (c >= 0)
                first = np.concatenate([a[two], a[three]])
                trie.add(first, np.concatenate([rests(b[two], np.full(two.sum(), -1)), rests(b[three], c[three])]))
                while trie.full():
                    yield from runs.by_slot(trie.spill(entries // 2), slots)

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                held = waiting.setdefault(lang, [])
                held += words_and_ends(text.as_py())
                held.append(END)
                if sum(map(len, waiting.values())) > WORDS_AT_ONCE:
                    yield from take(max(waiting, key=lambda k: len(waiting[k])))
        for lang in list(waiting):
            yield from take(lang)
        yield from runs.by_slot(trie.spill(), slots)

    return texts.mapInArrow(count, runs.RUN_TYPE)


def frequent_phrases(found: DataFrame, least: int) -> DataFrame:
    """``w1, w2, w3, a`` of the merged runs; ``w3`` is null in phrases of two words."""
    names = ["w1", "w2", "w3", "a"]

    def keep(slot: int, run: runs.Run) -> Iterator[pa.RecordBatch]:
        often = run[3] >= least
        a, b, c, n = (column[often] for column in run)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c - 1, mask=c == 0), pa.array(n)], names)

    return runs.merge_slots(found, keep, "w1 long, w2 long, w3 long, a long")


def _score(a: str, first: str, rest: str) -> Column:
    big = [f"cast({c} as decimal(20,0))" for c in (a, first, rest)]
    return F.expr(f"(cast(1000000 as decimal(7,0)) * cast({big[0]} * {big[0]} as decimal(31,0))) div ({big[1]} * {big[2]})")


def score_phrases(frequent: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score, w1, w2, w3`` of all candidates; ``words`` has ``id, lang, word, n``."""
    def named(number: int) -> DataFrame:
        columns = [F.col("id").alias(f"w{number}"), F.col("word").alias(f"word{number}"), F.col("n").alias(f"n{number}")]
        return words.select(*columns, *(["lang"] if number == 1 else []))

    pairs = frequent.where("w3 is null").select("w1", "w2", "a")
    two = pairs.join(named(1), "w1").join(named(2), "w2")
    two = two.select(
        "lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"),
        _score("a", "n1", "n2").alias("score"), "w1", "w2", F.lit(None).cast("long").alias("w3"),
    )
    three = frequent.where("w3 is not null")
    three = three.join(pairs.select("w1", "w2", F.col("a").alias("front")), ["w1", "w2"])
    three = three.join(pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("back")), ["w2", "w3"])
    three = three.join(named(1), "w1").join(named(2), "w2").join(named(3), "w3")
    cuts = [F.struct(_score("a", l, r).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r")) for k, l, r in ((1, "n1", "back"), (2, "front", "n3"))]
    three = three.withColumn("cut", F.least(*cuts))
    three = three.select(
        "lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", "cut.l", "cut.r", "cut.score", "w1", "w2", "w3"
    )
    return two.unionByName(three)


def uncovered(scored: DataFrame, cover: int = COVER) -> DataFrame:
    """``scored`` without the phrases that longer candidates cover."""
    longer = scored.where("w3 is not null")
    inside = longer.select("w1", "w2", "a").unionByName(longer.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    most = inside.groupBy("w1", "w2").agg(F.max("a").alias("longest"))
    covered = (F.col("longest") * 100 >= F.col("a") * cover) & F.col("w3").isNull()
    return scored.join(most, ["w1", "w2"], "left").where(~F.coalesce(covered, F.lit(False))).drop("longest")


def collocations(
    docs: DataFrame,
    work: str,
    least: int = LEAST,
    top: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
    trie_entries: int = TRIE_ENTRIES,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language. ``work``: a shared folder."""
    texts = _texts(docs, text_col, lang_col)
    counted = staged(count_words(texts), f"{work}/counts")
    totals = staged(counted.groupBy("lang").agg(F.sum("n").alias("n")), f"{work}/totals")
    known, words = vocabulary.build(counted, F.col("n") >= least, ["lang", "word"], work)
    words = staged(words, f"{work}/words")
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = phrase_runs(texts, known, runs.slots_for(total), trie_entries)
    frequent = staged(frequent_phrases(found, least), f"{work}/frequent")
    scored = staged(score_phrases(frequent, words), f"{work}/scored")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = uncovered(scored).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
