"""Error categories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error categories and the phrases that select them. The first match wins.
CATEGORY_PHRASES = (
    ("PERMANENT_INVALID_ENCODING", ("invalid or missing encoding",)),
    ("PERMANENT_SIZE_LIMIT", ("encoding exceeds size limit",)),
    ("TIMEOUT", ("timeout", "timed out")),
    ("RATE_LIMIT", ("429", "rate limit", "too many requests")),
    ("SERVER_ERROR", ("500", "502", "503", "504")),
    ("AUTH_ERROR", ("401", "403", "unauthorized", "forbidden")),
    ("NETWORK_ERROR", ("connection", "network")),
    ("BAD_REQUEST", ("400", "bad request")),
)

# Categories of the HTTP status codes that have one.
STATUS_CATEGORIES = (
    ("RATE_LIMIT", (429,)),
    ("SERVER_ERROR", (500, 502, 503, 504)),
    ("AUTH_ERROR", (401, 403)),
    ("BAD_REQUEST", (400,)),
)

UNKNOWN = "UNKNOWN"


# Categories whose phrases count before a status code: the first two are final, a timeout may come as a 504.
BEFORE_STATUS = 3


def _by_phrases(message: Column, rules: tuple, chain: Column) -> Column:
    lowered = F.lower(message)
    for category, phrases in rules:
        chain = chain.when(reduce(lambda a, b: a | b, [lowered.contains(p) for p in phrases]), F.lit(category))
    return chain


def classify_error(message: Column, status_code: Column | None = None) -> Column:
    """Category of an error text.

    With ``status_code`` an HTTP failure is classified by its code, since the text may quote digits from the
    answer's body; only the permanent phrases and timeouts go before the code. Everything else is classified
    by the text.
    """
    blank = F.when(F.coalesce(F.length(message) == 0, F.lit(True)), F.lit(UNKNOWN))
    by_text = _by_phrases(message, CATEGORY_PHRASES, blank).otherwise(F.lit(UNKNOWN))
    if status_code is None:
        return by_text
    chain = F.when(status_code.isNull() | (status_code < 400), by_text)
    chain = _by_phrases(message, CATEGORY_PHRASES[:BEFORE_STATUS], chain)
    for category, codes in STATUS_CATEGORIES:
        chain = chain.when(status_code.isin(*codes), F.lit(category))
    return chain.otherwise(F.lit(UNKNOWN))
