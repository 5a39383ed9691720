"""Content analysis of converted markdown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageflow.functions.text import is_error_text, words


def has_table(text: Column) -> Column:
    return text.contains("|--") & text.contains("--|")


def has_image(text: Column) -> Column:
    return text.contains("[Image]") | text.contains("![")


def word_count(text: Column) -> Column:
    """Words in the whole text, however long it is."""
    return words(text)


def analyse(text: Column, failed: Column | None = None) -> Column:
    """Struct of ``has_table``, ``has_image`` and ``word_count``; false and 0 for empty or failed text.

    ``failed`` is the outcome of the conversion where it is known. Without it a text that starts with
    the error prefix counts as failed.
    """
    failed = is_error_text(text) if failed is None else failed
    skip = F.coalesce(F.length(text) == 0, F.lit(True)) | failed
    return F.struct(
        F.when(skip, F.lit(False)).otherwise(has_table(text)).alias("has_table"),
        F.when(skip, F.lit(False)).otherwise(has_image(text)).alias("has_image"),
        F.when(skip, F.lit(0)).otherwise(word_count(text)).alias("word_count"),
    )
