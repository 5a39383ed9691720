"""Reading and writing the pipeline's parquet tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow.operators.tables import empty
from pageflow.schemas import ROW_REF

ROW_REF_COLUMNS = (
    ("row_file", "_metadata.file_path"),
    ("row_index", "_metadata.row_index"),
)


def with_row_ref(files: DataFrame) -> DataFrame:
    """Add the reader's own row identity to a frame read from parquet files (batch or streaming)."""
    return files.select("*", *[F.col(source).alias(name) for name, source in ROW_REF_COLUMNS])


def read_pages(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """A page table with row identity, from a folder or from files."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return with_row_ref(reader.parquet(*([path] if isinstance(path, str) else path)))


@dataclass(frozen=True)
class PageFolder:
    """A folder of page files that is listed only when all pages are asked for.

    What a plan names is opened by name, so work on a few files costs the same however many lie beside them.
    ``earlier`` holds pages that never were in the folder.
    """

    spark: SparkSession
    folder: str
    schema: T.StructType
    earlier: DataFrame | None = None

    def of(self, files: list[str]) -> DataFrame:
        """Pages of the named files (``row_file``)."""
        root = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        root = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toUri().getPath().rstrip("/") + "/"
        mine = [f for f in files if root in f]
        pages = read_pages(self.spark, mine, self.schema) if mine else self._none()
        return self._with_earlier(pages).where(F.col("row_file").isin(files))

    def all(self) -> DataFrame:
        return self._with_earlier(read_pages(self.spark, self.folder, self.schema))

    def _none(self) -> DataFrame:
        return empty(self.spark, T.StructType([*self.schema.fields, *ROW_REF.fields]))

    def _with_earlier(self, pages: DataFrame) -> DataFrame:
        return pages if self.earlier is None else pages.unionByName(self.earlier.select(*pages.columns))


def added_pages(pages: DataFrame, last_ingest_id: int) -> DataFrame:
    return pages.where(F.col("ingest_id") > last_ingest_id)


def previous_pages(pages: DataFrame, last_ingest_id: int) -> DataFrame:
    return pages.where(F.col("ingest_id") <= last_ingest_id)


def read_or_empty(spark: SparkSession, schema: T.StructType, *paths: str, base: str | None = None) -> DataFrame:
    """A parquet table with a declared schema; an empty one if nothing was written yet.

    Only a missing path counts as "nothing yet": any other failure is raised.
    """
    if not paths:
        return empty(spark, schema)
    reader = spark.read.schema(schema)
    if base:
        reader = reader.option("basePath", base)
    try:
        return reader.parquet(*paths)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)
