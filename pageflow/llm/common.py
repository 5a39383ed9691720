"""Shared pieces: white space and words, staged tables, bounded broadcasts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space and words as all operators of this package understand them (Java and Python syntax).
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

# A side of a join is broadcast only when its proven size is at most this.
BROADCAST_BYTES = 64 << 20

FILE_ROW_BITS = 38  # of a row's number: rows of a file


# Of a table whose rows are megabytes: Parquet looks at the size after each row, else it holds a hundred first, and keeps no dictionary of such values.
WIDE_ROWS = {"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": "false"}

# What a task holds at once of wide rows: rows of a scan's batch, rows and bytes of a batch for Python.
SMALL_BATCHES = {
    "spark.sql.parquet.columnarReaderBatchSize": "256",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def staged(df: DataFrame, folder: str, options: dict[str, int | str] | None = None) -> DataFrame:
    """Write ``df`` below the shared work folder and read it back, so that no later step repeats its work."""
    df.write.mode("overwrite").options(**(options or {})).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def drop_staged(spark: SparkSession, *folders: str) -> None:
    """Delete tables that ``staged`` wrote and no later step reads."""
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, an action's shuffle files go when it ends; else they stay until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Inside, an action's scans and Python tasks take ``SMALL_BATCHES``; else a batch is thousands of rows, however wide."""
    before = {name: spark.conf.get(name) for name in SMALL_BATCHES}
    try:
        for name, value in SMALL_BATCHES.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def whole_text(column: Column | str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def bounded(df: DataFrame, size_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if its proven size allows it, else as it is: Spark then picks the join."""
    return F.broadcast(df) if size_bytes <= BROADCAST_BYTES else df


def numbered(docs: DataFrame, *columns: Column, name: str = "row") -> DataFrame:
    """``columns`` of ``docs`` (a stored table) and the row's number: the place of its file by name, then that in the file.

    The number comes from the data, so a later job finds the same one however the scan is split.
    """
    paths = sorted(r[0] for r in docs.select(F.col("_metadata.file_path")).distinct().collect())
    files = docs.sparkSession.createDataFrame([(p, n << FILE_ROW_BITS) for n, p in enumerate(paths)], "_file string, _first long")
    placed = docs.select(*columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    joined = placed.join(F.broadcast(files), "_file")
    return joined.withColumn(name, F.col("_first") + F.col("_at")).drop("_file", "_first", "_at")
