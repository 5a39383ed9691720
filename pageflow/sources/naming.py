"""Column names of existing page and success tables, to and from the names used here."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Column names of existing tables and their names in this engine.
LEGACY_NAMES = {
    "primaryKey": "page_key",
    "originalMediaItemRid": "doc_id",
    "originalPath": "doc_path",
    "originalMediaReference": "media_ref",
    "pageNumber": "page_number",
    "totalPages": "total_pages",
    "pageBase64": "page_payload",
    "pageImageBase64": "page_image",
    "timestamp": "stage_times",
    "converted_markdown": "markdown",
    "markdown_layout_score": "layout_score",
    "markdown_parse_score": "parse_score",
    "markdown_ocr_score": "ocr_score",
    "markdown_table_score": "table_score",
    "is_blackline": "use_image",
}


def from_legacy(df: DataFrame) -> DataFrame:
    """Rename the columns that are present; others keep their names."""
    return df.withColumnsRenamed(LEGACY_NAMES)


def to_legacy(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({ours: theirs for theirs, ours in LEGACY_NAMES.items()})
