"""Declared schemas of the pipeline's tables."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def schema(columns: str) -> T.StructType:
    """Schema from ``name type [not null], ...``; unlike the built-in parser it needs no session."""
    fields = []
    for column in columns.split(","):
        name, kind, *constraint = column.split()
        fields.append(T.StructField(name, TYPES[kind], nullable=not constraint))
    return T.StructType(fields)


PAGE = schema(
    "page_key string, doc_id string, doc_path string, media_ref string, page_number int, "
    "total_pages int, page_payload string, page_image string, status string, stage_times string"
)

RESULT = schema(
    "content string, layout_score double, parse_score double, ocr_score double, table_score double"
)

ANALYSIS = schema("has_table boolean, has_image boolean, word_count int")

SUCCESS = T.StructType(
    PAGE.fields
    + schema(
        "markdown string, layout_score double, parse_score double, ocr_score double, table_score double"
    ).fields
    + ANALYSIS.fields
)

CATALOG = schema(
    "record_id string not null, content_hash string not null, attempt_count int not null, "
    "last_error string, error_category string, last_attempt_at timestamp, error_date date, page_key string"
)

# A row of a page file. Both columns come from the file reader, so they are free and stable.
ROW_REF = schema("row_file string, row_index bigint")

# What planning needs to know about a page; the payloads themselves stay in the page table.
PAGE_KEYS = T.StructType(
    schema(
        "page_key string, doc_id string, page_number int, record_id string, content_hash string, "
        "page_length int, image_length int, page_blank boolean, image_blank boolean"
    ).fields
    + ROW_REF.fields
)

SUCCESS_KEYS = schema("page_key string")

FLAGS = schema("doc_id string, use_image boolean")

RESPONSES = schema("page_key string, status_code int, body string")

# What a run does with a page; ``chunk`` is a partition of the table, ``slice`` a part of what a task reads there.
PLAN = T.StructType(
    schema("page_key string, record_id string, content_hash string").fields
    + ROW_REF.fields
    + schema("origin string, done boolean, attempt_count int, use_image boolean, error string, slice int, chunk int").fields
)

# One row per page converted in a run: the success row plus what the catalog and metrics need.
CONVERTED = T.StructType(
    SUCCESS.fields
    + ROW_REF.fields
    + schema("attempt_count int, record_id string, content_hash string, error string, error_category string").fields
)

METRICS = schema(
    "run_id string, as_of timestamp, planned_count bigint, added_count bigint, retry_count bigint, "
    "valid_count bigint, invalid_count bigint, success_count bigint, error_count bigint, "
    "conversion_error_count bigint, table_count bigint, image_count bigint, null_content_count bigint, "
    "success_rate double, error_rate double, "
    # Of planning: added pages that were copies of a key, had succeeded, or whose content is given up or waiting; and the
    # catalog's contents by state before the run.
    "duplicate_count bigint, succeeded_before_count bigint, held_count bigint, due_count bigint, waiting_count bigint, permanent_count bigint"
)

MANIFEST = schema(
    "run_id string, seq bigint, last_ingest_id bigint, catalog_version string, as_of timestamp"
)

# Failures of a run by category.
REPORT = schema(
    "run_id string, error_category string, error_count bigint, avg_attempts double, exhausted_count bigint, "
    "permanent_count bigint"
)

# A failure and when its page is to be sent again; never, if ``due_at`` is null.
WAITING = schema(
    "record_id string, content_hash string, page_key string, attempt_count int, at timestamp, due_at timestamp"
)
