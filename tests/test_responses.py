"""What becomes of each shape of service answer."""

from __future__ import annotations

import json

import pytest

from pageflow.functions.responses import parse_responses

UNEXPECTED = "ERROR: Unexpected error"


def answer(inner) -> str:
    return json.dumps({"value": inner if isinstance(inner, str) else json.dumps(inner)})


CASES = [
    # status, body, content, (layout, parse, ocr, table), start of the error text
    (200, answer({"content": "x", "confidence": {"layout_score": 0.25, "parse_score": "nan", "ocr_score": " 1 "}}), "x", (0.25, None, 1.0, None), None),
    (200, answer({"content": "x", "confidence": {"layout_score": True, "parse_score": "true", "ocr_score": {}, "table_score": 3}}), "x", (1.0, None, None, 3.0), None),
    (200, answer({"content": "x"}), "x", (None,) * 4, None),
    (200, answer({"content": "ERROR: genuine"}), "ERROR: genuine", (None,) * 4, None),
    (200, answer({"content": ""}), "", (None,) * 4, None),
    (200, answer({"content": None}), None, (None,) * 4, None),
    (200, answer("plain text"), "plain text", (None,) * 4, None),
    (200, answer(""), "", (None,) * 4, None),
    (200, answer({"content": 0}), "0", (None,) * 4, None),
    (200, answer({"content": 5}), None, (None,) * 4, UNEXPECTED),
    (200, answer({"content": True}), None, (None,) * 4, UNEXPECTED),
    (200, answer({"note": 1}), None, (None,) * 4, "ERROR: No 'content' field in value: {\"note\": 1}"),
    (200, answer([1]), None, (None,) * 4, "ERROR: No 'content' field in value"),
    (200, answer(["content"]), None, (None,) * 4, UNEXPECTED),
    (200, answer('"some text"'), None, (None,) * 4, "ERROR: No 'content' field in value"),
    (200, answer('"the content"'), None, (None,) * 4, UNEXPECTED),
    (200, answer("7"), None, (None,) * 4, UNEXPECTED),
    (200, answer("null"), None, (None,) * 4, UNEXPECTED),
    (200, answer({"content": "x", "confidence": None}), None, (None,) * 4, UNEXPECTED),
    (200, answer({"content": "x", "confidence": [1]}), None, (None,) * 4, UNEXPECTED),
    (200, '{"value": null}', None, (None,) * 4, UNEXPECTED),
    (200, '{"value": 3}', None, (None,) * 4, UNEXPECTED),
    (200, '{"value": {"content": "x"}}', None, (None,) * 4, UNEXPECTED),
    (200, '{"other": 1}', None, (None,) * 4, "ERROR: No 'value' field in response: {\"other\": 1}"),
    (200, "[1]", None, (None,) * 4, "ERROR: No 'value' field in response"),
    (200, '["value"]', None, (None,) * 4, UNEXPECTED),
    (200, '"text"', None, (None,) * 4, "ERROR: No 'value' field in response"),
    (200, '"a value"', None, (None,) * 4, UNEXPECTED),
    (200, "3", None, (None,) * 4, UNEXPECTED),
    (200, "null", None, (None,) * 4, UNEXPECTED),
    (200, "not json", None, (None,) * 4, "ERROR: Network error"),
    (200, None, None, (None,) * 4, "ERROR: Network error"),
    # One document and nothing else.
    (200, answer('{"content": "x"} and more'), '{"content": "x"} and more', (None,) * 4, None),
    (200, answer('{"content": "x"}, 1'), '{"content": "x"}, 1', (None,) * 4, None),
    (200, answer('{"content": "x"}] ['), '{"content": "x"}] [', (None,) * 4, None),
    (200, answer('{"content": "x"} \n'), "x", (None,) * 4, None),
    (200, answer({"content": "x"}) + " {}", None, (None,) * 4, "ERROR: Network error"),
    (200, answer({"content": "x"}) + "]", None, (None,) * 4, "ERROR: Network error"),
    # Bare not-a-numbers, and such words inside texts.
    (200, answer('{"content": "a NaN, b", "confidence": {"layout_score": NaN, "ocr_score": 0.5, "table_score": -Infinity}}'), "a NaN, b", (None, None, 0.5, None), None),
    (200, answer({"content": "x: NaN, Infinity"}), "x: NaN, Infinity", (None,) * 4, None),
    # Of a repeated key the last one counts.
    (200, answer('{"content": "x", "content": "y"}'), "y", (None,) * 4, None),
    (429, "slow down", None, (None,) * 4, "ERROR: Page API failed 429: slow down"),
    (500, "x" * 900, None, (None,) * 4, "ERROR: Page API failed 500: " + "x" * 500),
    (404, None, None, (None,) * 4, "ERROR: Page API failed 404: "),
    (503, answer({"content": "x"}), None, (None,) * 4, "ERROR: Page API failed 503: "),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(i, s, b, "Page") for i, (s, b, *_) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, status_code int, body string, mode string")
    return {r.i: r for r in parse_responses(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_answer(parsed, i):
    _, _, content, scores, error = CASES[i]
    row = parsed[i]
    assert row.content == content
    assert (row.layout_score, row.parse_score, row.ocr_score, row.table_score) == scores
    assert (row.error is None) if error is None else row.error.startswith(error)


def test_http_failure_quotes_the_whole_body(parsed):
    failed = [i for i, (status, *_) in enumerate(CASES) if status == 500]
    assert failed and all(parsed[i].error == f"ERROR: Page API failed 500: {CASES[i][1]}" for i in failed)


def test_call_error_comes_first(spark):
    df = spark.createDataFrame(
        [("ERROR: Network error - refused", None, None, "Page"), (None, 200, '{"value": "x"}', "Page")],
        "call_error string, status_code int, body string, mode string",
    )
    rows = parse_responses(df).collect()
    assert [(r.error, r.content) for r in rows] == [("ERROR: Network error - refused", None), (None, "x")]
