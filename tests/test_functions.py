"""Scalar rules against hand-written expectations and against plain Python."""

from __future__ import annotations

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from pageflow.functions.content import analyse, word_count
from pageflow.functions.errors import classify_error
from pageflow.functions.keys import content_hash, record_id
from pageflow.functions.requests import request_document
from pageflow.functions.scores import clean_score
from pageflow.functions.stages import merge_stage
from pageflow.functions.text import is_blank, words
from pageflow.settings import Settings

# Python's white space, asked from Python itself.
SPACES = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isspace()]


def apply(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_there_are_29_white_space_characters():
    assert len(SPACES) == 29


def test_word_count_matches_split_on_every_character(spark):
    """Each code point of the basic plane between two letters."""
    texts = [f"a{chr(c)}b" for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    assert apply(spark, texts, words) == [len(t.split()) for t in texts]


def test_word_count_matches_split_on_random_texts(spark):
    rng = random.Random(7)
    alphabet = SPACES + list("abcé漢😀|-[]!") * 4
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(0, 80))) for _ in range(2000)] + [None, ""]
    counts = apply(spark, texts, lambda c: analyse(c)["word_count"])
    assert counts == [len(t.split()) if t else 0 for t in texts]


def test_long_text_is_counted_whole(spark):
    texts = ["dense " * 20_000 + "x" * 1_000_000, "a b " * 400_000]
    assert apply(spark, texts, word_count) == [len(t.split()) for t in texts]


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, (False, False, 0)),
        ("", (False, False, 0)),
        ("ERROR: |--|--| ![x]", (False, False, 0)),
        ("|--|", (True, False, 1)),
        ("|--", (False, False, 1)),
        ("a --| b |-- c", (True, False, 5)),
        ("| --- | --- |", (False, False, 5)),
        ("[Image] x", (False, True, 2)),
        ("![a](b)", (False, True, 1)),
        ("[image]", (False, False, 1)),
    ],
)
def test_analysis(spark, text, expected):
    assert tuple(apply(spark, [text], analyse)[0]) == expected


def test_analysis_by_outcome_reads_text_that_looks_like_an_error(spark):
    rows = apply(spark, ["ERROR: is a word"], lambda c: analyse(c, F.lit(False)))
    assert rows[0].word_count == 4


def test_clean_scores(spark):
    def python_rule(text):
        try:
            value = float(text)
        except (TypeError, ValueError):
            return None
        return None if math.isnan(value) or math.isinf(value) else value

    texts = [None, "", "nan", "NaN", "inf", "-inf", "Infinity", "abc", " 0.5 ", "1e400", "-1e400", "1", "+.5", "5."]
    texts += ["1_000", "1__0", "_1", "1d", "1.5f", "0x10", "0x1p3", "1e5", "1E-5", "--1", " 1.5 ", "true", "1 2"]
    assert apply(spark, texts, clean_score) == [python_rule(t) for t in texts]


CATEGORIES = [
    (None, "UNKNOWN"),
    ("", "UNKNOWN"),
    ("ERROR: Invalid or missing encoding", "PERMANENT_INVALID_ENCODING"),
    ("invalid OR missing ENCODING after timeout", "PERMANENT_INVALID_ENCODING"),
    ("ERROR: Encoding exceeds size limit", "PERMANENT_SIZE_LIMIT"),
    ("Read timed out", "TIMEOUT"),
    ("TIMEOUT after 429", "TIMEOUT"),
    ("429", "RATE_LIMIT"),
    ("Too Many Requests", "RATE_LIMIT"),
    ("rate limit and 500", "RATE_LIMIT"),
    ("failed 404: 1500 pages", "SERVER_ERROR"),
    ("failed 502", "SERVER_ERROR"),
    ("failed 401", "AUTH_ERROR"),
    ("Forbidden", "AUTH_ERROR"),
    ("connection refused", "NETWORK_ERROR"),
    ("ERROR: Network error - x", "NETWORK_ERROR"),
    ("failed 400", "BAD_REQUEST"),
    ("Bad Request", "BAD_REQUEST"),
    ("failed 404", "UNKNOWN"),
    ("ERROR: Empty or null encoding provided", "UNKNOWN"),
    ("ERROR: Missing authentication configuration", "UNKNOWN"),
]


def test_error_categories(spark):
    assert apply(spark, [m for m, _ in CATEGORIES], classify_error) == [c for _, c in CATEGORIES]


def test_status_code_goes_first(spark):
    message = "ERROR: Page API failed 404: 1500 pages"
    by_status = lambda code: apply(spark, [message], lambda c: classify_error(c, F.lit(code).cast("int")))[0]
    assert by_status(404) == "UNKNOWN"
    assert by_status(503) == "SERVER_ERROR"
    assert by_status(200) == "SERVER_ERROR"
    assert by_status(None) == "SERVER_ERROR"


STAGES = [
    (None, {"done": "T"}),
    ("", {"done": "T"}),
    ("  ", {"done": "T"}),
    ("bad", {"done": "T"}),
    ("[1]", {"done": "T"}),
    ("3", {"done": "T"}),
    ("null", {"done": "T"}),
    ("{}", {"done": "T"}),
    ('{"split": "S"}', {"split": "S", "done": "T"}),
    ('{"done": "old", "split": "S"}', {"done": "T", "split": "S"}),
    ('{"n": 1, "l": [1, "x"], "o": {"k": null}, "z": null}', {"n": 1, "l": [1, "x"], "o": {"k": None}, "z": None, "done": "T"}),
    ('{"a": 1, "a": 2}', {"a": 2, "done": "T"}),
]


def test_stage_times(spark):
    merged = apply(spark, [t for t, _ in STAGES], lambda c: merge_stage(c, F.lit("done"), F.lit("T")))
    assert [list(json.loads(m).items()) for m in merged] == [list(e.items()) for _, e in STAGES]


def test_keys(spark):
    import hashlib

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = [("d", 3, "p", "i"), ("d", None, None, ""), (None, 3, "", None), (None, None, "p", None)]
    df = spark.createDataFrame(rows, "doc_id string, page_number int, page_payload string, page_image string")
    got = [tuple(r) for r in df.select(record_id(), content_hash()).collect()]
    assert [g[0] for g in got] == ["d::3", "d::-1", "::3", "::-1"]
    assert [g[1] for g in got] == [sha(f"{sha(p or '')}||{sha(i or '')}") for _, _, p, i in rows]
    # Without the fill-in the record id of a page of an unnamed document would be its bare number.
    assert df.where("doc_id is null").select(F.concat_ws("::", "doc_id", "page_number")).first()[0] == "3"


def test_requests(spark):
    rows = [(True, "img", 1), (False, 'p"\n', 2), (False, "p", None), (None, "p", 4)]
    df = spark.createDataFrame(rows, "u boolean, p string, n int")
    sent = [json.loads(r[0])["parameters"] for r in df.select(request_document(F.col("u"), F.col("p"), F.col("n"))).collect()]
    assert sent == [
        {"page_image_base64_encoding": "img"},
        {"pdf_encoding": 'p"\n', "include_images": True, "include_ocr": True, "page_number": 2},
        {"pdf_encoding": "p", "include_images": True, "include_ocr": True},
        {"pdf_encoding": "p", "include_images": True, "include_ocr": True, "page_number": 4},
    ]


def test_blank_text(spark):
    texts = [None, "", " ", "".join(SPACES), "x", " x ", "​"]
    assert apply(spark, texts, is_blank) == [not t or not t.strip() for t in texts]
