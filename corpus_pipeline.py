"""The corpus pipeline: toxicity, repeated lines, near duplicates, source mix, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.llm import line_dedup, mixing, packing, simhash_groups, toxicity
from pageflow.llm.common import staged
from pageflow.session import work_folder


def _documents_with(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The fields of ``doc`` with the row's own ``text``, and ``n_chars`` to match where the text has changed."""
    changed = ~F.col("doc.text").eqNullSafe(F.col("text"))
    new = {
        "text": F.col("text"),
        "n_chars": F.when(changed, F.length("text").cast("long")).otherwise(F.col("doc.n_chars")),
    }
    return rows.select(*(new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier doesn't call toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of three lines or more that occur earlier."""
    return _documents_with(line_dedup.dedup_lines(docs, work_folder(spark)), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: the one with the smallest id."""
    return simhash_groups.drop_similar(docs, work_folder(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a document once per pass over its source, whole or in part."""
    mixed = mixing.mix(docs, work_folder(spark))
    return _documents_with(mixing.mixed_texts(docs, mixed), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of fixed length; passes of one document never share a sequence."""
    packed = packing.pack_documents(docs, work_folder(spark), cluster=F.col("doc_id"))
    return packed.withColumnRenamed("id", "doc_id")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# Compression lengths and seeded permutations have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written below the shared folder and read again."""
    work, docs = work_folder(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = staged(docs, f"{work}/{name}")
    return docs
