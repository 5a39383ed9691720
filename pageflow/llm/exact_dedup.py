"""Exact duplicates by two passes over a Bloom filter.

Pass one hashes every text and counts how many rows fall on each bit of a filter. The bits that two rows or
more fall on form the filter of possible repeats. Pass two tests every row against it: a row with one bit
outside has no copy and passes straight through. Only the rest are shuffled by their hash and compared exactly,
so a false positive costs a shuffled row, never a wrong result.

Rules
* Texts are equal when identical without white space ``[\\x20\\x09-\\x0D]``. A null text counts as empty.
* The row with most code points stays, then the smallest id (null last), then one of the identical rows.
* A repeated id is another row. An empty table gives an empty result. Other columns play no part; names may clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.llm.common import SPACE, bounded, numbered, staged, whole_text

BITS_PER_ROW = 16
PROBES = 2


def text_digest(text: Column | str) -> Column:
    """SHA-256 (32 bytes) of the text without white space."""
    return F.unhex(F.sha2(F.regexp_replace(whole_text(text), f"{SPACE}+", "").cast("binary"), 256))


def _positions(bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.col("digest"), F.lit(seed)), F.lit(bits)) + 1 for seed in range(PROBES)]


def repeat_filter(rows: DataFrame, bits: int) -> DataFrame:
    """Bitmaps ``(bucket, bitmap)`` of the filter bits that at least two of the ``digest`` rows fall on.

    Counts are combined on the map side, so a digest of many rows is no hot key. A bitmap has 4 KiB and there
    are at most ``bits / 32768 + 1`` of them.
    """
    hit = rows.select(F.explode(F.array(*_positions(bits))).alias("bit")).groupBy("bit").count().where("count > 1")
    return hit.groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bitmap")
    )


def flag_repeats(rows: DataFrame, bitmaps: DataFrame, bits: int) -> DataFrame:
    """``rows`` with ``suspect``: every bit of the row's digest lies in the filter."""
    size = (bits // 32768 + 1) * 4200
    suspect = F.lit(True)
    for probe, position in enumerate(_positions(bits)):
        bucket, bitmap, at = f"bucket{probe}", f"bitmap{probe}", f"at{probe}"
        rows = rows.withColumn(at, position).withColumn(bucket, F.expr(f"bitmap_bucket_number({at})"))
        rows = rows.join(bounded(bitmaps.toDF(bucket, bitmap), size), bucket, "left")
        byte = f"conv(hex(substring({bitmap}, cast(bitmap_bit_position({at}) div 8 + 1 as int), 1)), 16, 10)"
        bit = F.expr(f"getbit(cast({byte} as bigint), cast(bitmap_bit_position({at}) % 8 as int)) = 1")
        suspect = suspect & F.coalesce(bit, F.lit(False))
        rows = rows.withColumn(f"hit{probe}", suspect)
        suspect = F.col(f"hit{probe}")
    helpers = [f"{name}{probe}" for probe in range(PROBES) for name in ("bucket", "bitmap", "at")]
    return rows.withColumn("suspect", suspect).drop(*helpers, *(f"hit{probe}" for probe in range(PROBES)))


def filter_bits(rows: int) -> int:
    """A power of two with at least 16 bits a row: about one row in 70 is then shuffled in vain."""
    return 1 << max(15, (BITS_PER_ROW * max(rows, 1) - 1).bit_length())


def _survivors(suspects: DataFrame) -> DataFrame:
    """One row per digest: how many rows, and the one that stays."""
    best = F.min(F.struct(-F.col("size"), F.col("id").isNull(), F.col("id"), F.col("row")))
    groups = suspects.groupBy("digest").agg(F.count("*").alias("group_size"), best.alias("best"))
    return groups.select("digest", "group_size", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"))


def mark_copies(docs: DataFrame, work: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``id, keep_id, group_size, kept, digest`` (32 bytes). ``work``: a shared folder."""
    rows = staged(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            F.length(whole_text(text_col)).cast("long").alias("size"),
            text_digest(text_col).alias("digest"),
        ),
        f"{work}/digests",
    )
    bits = filter_bits(rows.count())
    flagged = flag_repeats(rows, staged(repeat_filter(rows, bits), f"{work}/filter"), bits)
    suspects = flagged.where("suspect")
    alone = flagged.where("not suspect").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    # A table of its own, so that the join reads both sides anew and a digest of many rows can be split.
    survivors = staged(_survivors(suspects), f"{work}/survivors")
    grouped = suspects.join(survivors, "digest").select(
        "id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest"
    )
    return alone.unionByName(grouped)


def drop_copies(docs: DataFrame, work: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (a stored table) without the copies. Rows without a copy are not shuffled; of the others only keys are."""
    rows = numbered(
        docs,
        F.struct("*").alias("doc"),
        F.col(id_col).alias("id"),
        F.length(whole_text(text_col)).cast("long").alias("size"),
        text_digest(text_col).alias("digest"),
    )
    slim = staged(rows.select("row", "id", "size", "digest"), f"{work}/digests")
    bits = filter_bits(slim.count())
    bitmaps = staged(repeat_filter(slim, bits), f"{work}/filter")
    suspects = flag_repeats(slim, bitmaps, bits).where("suspect")
    stay = _survivors(suspects).select(F.col("keep_row").alias("row"))
    flagged = flag_repeats(rows, bitmaps, bits)
    return flagged.where("not suspect").select("doc.*").unionByName(
        flagged.where("suspect").join(stay, "row", "left_semi").select("doc.*")
    )
