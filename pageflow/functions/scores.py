"""Quality scores as finite doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageflow.functions.text import strip

# Fixed value: decimal literal; rules out NaN, infinities, hexadecimal and type-suffixed literals.
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def clean_score(text: Column) -> Column:
    """The number written in ``text``, null where there is none or it is not finite."""
    plain = F.regexp_replace(strip(text), r"(?<=[0-9])_(?=[0-9])", "")
    number = F.when(plain.rlike(DECIMAL), plain.try_cast("double"))
    # Through a one-element list, so that the number is computed once and the generated code stays small.
    finite = F.filter(F.array(number), lambda x: F.abs(x) < float("inf"))
    return F.get(finite, F.lit(0))


def variant_scores(values: Column) -> Column:
    """``clean_score`` for a list of JSON values; booleans count as 1 and 0."""
    return F.transform(values, _variant_score)


def _variant_score(value: Column) -> Column:
    as_flag = F.when(F.schema_of_variant(value) == "BOOLEAN", F.try_variant_get(value, "$", "double"))
    return F.coalesce(as_flag, clean_score(F.try_variant_get(value, "$", "string")))
