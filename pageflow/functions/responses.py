"""Reading the conversion service's answer: JSON that holds a JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.functions.scores import variant_scores

SCORES = ("layout_score", "parse_score", "ocr_score", "table_score")

def _kind(value: Column, *kinds: str) -> Column:
    """Whether a JSON value is of one of the kinds; null where there is no value."""
    return F.schema_of_variant(value).rlike(f"^({'|'.join(kinds)})")


# What stands behind a text to tell whether it was one JSON document; no document of its own ends like this.
_END = "\\u0000end"
# Bare not-a-numbers as some services write them, where a value stands.
_BARE = r"([\[:,]\s*)(NaN|-?Infinity)(?=\s*[,\]}])"


def _listed(text: Column) -> Column:
    """The variant reader stops after a document, so it is given a list: the text and a mark."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))


def _mended(text: Column) -> Column:
    """``_listed`` for texts with bare not-a-numbers, which become texts: as scores they are not finite either way."""
    bare = text.contains("NaN") | text.contains("Infinity")
    return F.when(bare, _listed(F.regexp_replace(text, _BARE, '$1"$2"')))


def _alone(listed: str) -> Column:
    """The document of a list; null unless the mark follows it, for only then the text was one document."""
    marked = F.try_variant_get(listed, "$[1]", "string") == F.lit("\0end")
    return F.when(marked, F.try_variant_get(listed, "$[0]", "variant"))


def _json_stages(text: str, name: str) -> list[Column]:
    """Columns that lead to ``name``, the JSON document in column ``text`` as a variant; null where the text is not JSON.

    As the services' own language reads it: text after the document is an error, bare ``NaN`` and ``Infinity`` are taken. A repeated
    key counts as not JSON unless ``spark.sql.variant.allowDuplicateKeys`` is set, with which the last one counts.
    """
    plain, strict, mended = (f"{name}_{step}" for step in ("plain", "strict", "mended"))
    return [
        _listed(F.col(text)).alias(plain),
        _alone(plain).alias(strict),
        F.when(F.col(strict).isNull(), _mended(F.col(text))).alias(mended),
        F.coalesce(strict, _alone(mended)).alias(name),
    ]


def _without_field(value: Column, field: Column, name: str, absent: Column, unusable: Column) -> Column:
    """What is wrong with a JSON value whose field ``name`` is to be read as ``field``; null if nothing.

    Lists and texts lack the field, unless they happen to contain its name; those, numbers, booleans and
    null offer nothing to read a field from.
    """
    in_list = F.array_contains(F.try_variant_get(value, "$", "array<string>"), name)
    in_text = F.try_variant_get(value, "$", "string").contains(name)
    return (
        F.when(field.isNotNull(), F.lit(None).cast("string"))
        .when(_kind(value, "OBJECT"), absent)
        .when(_kind(value, "ARRAY"), F.when(in_list, unusable).otherwise(absent))
        .when(_kind(value, "STRING"), F.when(in_text, unusable).otherwise(absent))
        .otherwise(unusable)
    )


def parse_responses(df: DataFrame) -> DataFrame:
    """Turn ``status_code``, ``body``, ``call_error`` and ``mode`` into content, scores and ``error``.

    ``error`` is null exactly where the conversion succeeded; ``content`` is null where it failed.
    A missing ``call_error`` column means that every call was answered. An HTTP failure quotes the whole body.
    """
    call_error = F.col("call_error") if "call_error" in df.columns else F.lit(None).cast("string")
    body, value, text, inner = (F.col(c) for c in ("body", "_value", "_text", "_inner"))
    content, confidence = F.col("_content"), F.col("_confidence")
    # Each name is an input of the next ones.
    staged = df.select(
        "*",
        *_json_stages("body", "_doc"),
        F.try_variant_get("_doc", "$.value", "variant").alias("_value"),
        F.when(_kind(value, "STRING"), F.try_variant_get("_value", "$", "string")).alias("_text"),
        *_json_stages("_text", "_inner"),
        F.try_variant_get("_inner", "$.content", "variant").alias("_content"),
        F.try_variant_get("_inner", "$.confidence", "variant").alias("_confidence"),
        F.try_variant_get("_content", "$", "string").alias("_bare"),
    )
    unexpected = lambda what: F.lit(f"ERROR: Unexpected error - {what}")
    status = F.col("status_code").cast("string")
    http_error = F.when(
        F.col("status_code") >= 400,
        F.concat(F.lit("ERROR: "), F.col("mode"), F.lit(" API failed "), status, F.lit(": "), F.coalesce(body, F.lit(""))),
    )
    outer_error = F.when(F.col("_doc").isNull(), F.lit("ERROR: Network error - response is not JSON")).otherwise(
        _without_field(
            F.col("_doc"),
            value,
            "value",
            F.concat(F.lit("ERROR: No 'value' field in response: "), body),
            unexpected("response is not an object"),
        )
    )
    # A value that is text but not JSON is the content itself.
    inner_error = F.when(text.isNull(), unexpected("value is not text")).when(
        inner.isNotNull(),
        F.coalesce(
            _without_field(
                inner,
                content,
                "content",
                F.concat(F.lit("ERROR: No 'content' field in value: "), text),
                unexpected("value is not an object"),
            ),
            F.when(~_kind(confidence, "OBJECT"), unexpected("confidence is not an object")),
            F.when(
                ~_kind(content, "STRING", "VOID", "ARRAY", "OBJECT") & ~F.col("_bare").isin("false", "0"),
                unexpected("content is not text"),
            ),
        ),
    )
    checked = staged.withColumn("error", F.coalesce(call_error, http_error, outer_error, inner_error))
    ok = F.col("error").isNull()
    scores = variant_scores(F.array(*[F.try_variant_get(confidence, f"$.{s}", "variant") for s in SCORES]))
    scored = checked.withColumn("_scores", F.when(ok & confidence.isNotNull(), scores))
    parsed = F.struct(
        F.when(ok, F.when(inner.isNull(), text).otherwise(F.col("_bare"))).alias("content"),
        *[F.get("_scores", F.lit(i)).alias(s) for i, s in enumerate(SCORES)],
        "error",
    )
    # A generator of one row, so that a later filter on the outcome is not pushed below the parsing, which
    # would parse every answer twice.
    return scored.select(
        *[c for c in df.columns if c not in ("body", "call_error", "error")], F.inline(F.array(parsed))
    )
