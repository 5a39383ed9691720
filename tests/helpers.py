"""Page files and a service whose answer is written in the payload."""

from __future__ import annotations

import base64
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow import schemas
from pageflow.operators.convert import python_converter
from pageflow.sources.tables import read_pages

PAGES = T.StructType([*schemas.PAGE.fields, T.StructField("ingest_id", T.IntegerType())])


def at(text):
    return F.lit(text).cast("timestamp")


def payload(text):
    """Base64, padded with white space to pass the length check."""
    return base64.b64encode(text.ljust(180).encode()).decode()


def page(key, text="ok", ingest=1, image=None, doc=None, number=1):
    encoded = None if text is None else payload(text)
    return (key, doc or f"doc-{key}", f"/{key}.pdf", None, number, 1, encoded, image and payload(image), "split", '{"split": "S"}', ingest)


def write_pages(spark, folder, *rows, files=2):
    spark.createDataFrame(list(rows), PAGES).repartition(files, "page_key").write.mode("append").parquet(folder)
    return read_pages(spark, folder)


def service(spark, recover=False, at_once=1):
    """``(converter, calls)``: texts starting with ``fail`` or ``raise`` fail unless ``recover``."""
    calls = spark.sparkContext.accumulator(0)

    def open_service():
        def call(payload, page_number, mode):
            calls.add(1)
            text = base64.b64decode(payload).decode().rstrip()
            if not recover and text.startswith("fail"):
                return 503, "down"
            if not recover and text.startswith("raise"):
                raise ConnectionError("refused")
            if not recover and text.startswith("crash"):
                raise ValueError("no good")
            content = f"{mode} {page_number}: {text}"
            return 200, json.dumps({"value": json.dumps({"content": content, "confidence": {"ocr_score": 0.5}})})

        return call

    return python_converter(open_service, at_once), calls


def flags(spark, *docs):
    return spark.createDataFrame([(d, True) for d in docs], schemas.FLAGS)


def catalog_rows(store):
    return sorted(
        (r.record_id, r.attempt_count, r.error_category, str(r.last_attempt_at)) for r in store.catalog().collect()
    )
