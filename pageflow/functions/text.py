"""Text rules shared by the other functions: what counts as white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageflow.settings import ERROR_PREFIX

# Fixed value: the 29 characters Python's str.split() and str.strip() treat as white space, as the inside
# of a character class: Unicode white space (flag U) and the four information separators.
WHITESPACE = r"\s\x1C-\x1F"
UNICODE = "(?U)"


def words(text: Column) -> Column:
    """Number of white-space separated words."""
    return F.regexp_count(text, F.lit(f"{UNICODE}[^{WHITESPACE}]+"))


def is_blank(text: Column) -> Column:
    """Null, empty or only white space. The search stops at the first other character."""
    return F.coalesce(~text.rlike(f"{UNICODE}[^{WHITESPACE}]"), F.lit(True))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"{UNICODE}^[{WHITESPACE}]+|[{WHITESPACE}]+$", "")


def is_error_text(text: Column) -> Column:
    """True where a failure is signalled inside the text; null text is not a failure."""
    return F.coalesce(text, F.lit("")).startswith(ERROR_PREFIX)
