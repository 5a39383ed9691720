from __future__ import annotations

import uuid

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use inside.
        *(T.StructField(c, T.StringType()) for c in ("row", "id", "doc", "key", "size", "digest", "bin", "words", "number")),
    ]
)


@pytest.fixture()
def make_docs(spark, tmp_path):
    """A stored table of ``(doc_id, text[, source])`` rows with clashing extra columns."""

    def make(rows, files=2):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), *"abcdefghi") for r in rows]
        path = str(tmp_path / uuid.uuid4().hex)
        spark.createDataFrame(full, DOCS).repartition(files).write.parquet(path)
        return spark.read.schema(DOCS).parquet(path)

    return make


@pytest.fixture()
def work(tmp_path):
    return lambda: str(tmp_path / uuid.uuid4().hex)

