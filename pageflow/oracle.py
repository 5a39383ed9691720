"""The queries as SQL over the shared test tables, for the check against a second engine (DuckDB).

Written from the rules, not from the Spark code: the two sides share fixture definitions and nothing else.
"""

from __future__ import annotations

from pageflow.sources.html_service import MARKDOWN_RULES
from pageflow.sources.testdata import MESSAGES

AS_OF = "TIMESTAMP '2024-01-30 12:00:00'"
STAGE_AT = "2024-01-01T00:00:00"

# Python's white space as the inside of a character class of this engine's regular expressions.
WS = (
    r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)


def b64(x: str) -> str:
    return f"to_base64(encode({x}))"


PAGE_COLUMNS = f"""
    concat(conv_id::VARCHAR, '-', turn::VARCHAR) AS page_key,
    concat('conv-', conv_id::VARCHAR) AS doc_id,
    concat('/docs/', conv_id::VARCHAR, '.pdf') AS doc_path,
    CAST(NULL AS VARCHAR) AS media_ref,
    turn::INTEGER AS page_number,
    (count(*) OVER (PARTITION BY conv_id))::INTEGER AS total_pages,
    {b64('text')} AS page_payload,
    CASE WHEN conv_id % 5 = 0 AND turn % 2 = 0 THEN {b64('text || text')} END AS page_image,
    'page split completed' AS status,
    CASE conv_id % 6 WHEN 1 THEN ''
        WHEN 2 THEN '{{"page split completed": "{STAGE_AT}"}}'
        WHEN 3 THEN 'bad' WHEN 4 THEN '[1]'
        WHEN 5 THEN '{{"page split completed": "{STAGE_AT}", "markdown conversion completed": "2024-01-01T01:00:00"}}'
    END AS stage_times,
    CASE WHEN conv_id % 3 = 0 THEN 2 ELSE 1 END AS ingest_id,
    conv_id, turn
"""


def keyed(source: str) -> str:
    return f"""SELECT *, concat(coalesce(doc_id, ''), '::', coalesce(page_number::VARCHAR, '-1')) AS record_id,
        sha256(concat(sha256(coalesce(page_payload, '')), '||', sha256(coalesce(page_image, '')))) AS content_hash
        FROM {source}"""


CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "fx1": ((), f"SELECT {PAGE_COLUMNS} FROM conversations"),
    "k1": (("fx1",), keyed("fx1")),
    "fx1d": (
        ("fx1",),
        f"""SELECT * FROM fx1 UNION ALL
        SELECT * REPLACE ({b64("concat('dup ', page_key)")} AS page_payload) FROM fx1 WHERE conv_id % 10 = 0""",
    ),
    "k1d": (("fx1d",), keyed("fx1d")),
    "fx1c": (
        ("fx1",),
        f"""SELECT * FROM fx1 UNION ALL
        SELECT * REPLACE ({b64("concat('new ', page_key)")} AS page_payload, 2 AS ingest_id) FROM fx1
        WHERE ingest_id = 1 AND conv_id % 8 = 1""",
    ),
    "k1c": (("fx1c",), keyed("fx1c")),
    "fx2": (
        (),
        """SELECT DISTINCT concat('conv-', conv_id::VARCHAR) AS doc_id, conv_id % 5 = 0 AS use_image
        FROM conversations WHERE conv_id % 4 <> 3""",
    ),
    "flagged": (
        ("k1", "fx2"),
        """SELECT k1.*, coalesce(fx2.use_image, false) AS use_image,
            CASE WHEN coalesce(fx2.use_image, false) THEN page_image ELSE page_payload END AS payload
        FROM k1 LEFT JOIN fx2 USING (doc_id)""",
    ),
    "rejected": (
        ("flagged",),
        f"""SELECT *, CASE WHEN coalesce(length(payload), 0) <= 200 THEN 'ERROR: Invalid or missing encoding'
            WHEN NOT regexp_matches(payload, '[^{WS}]') THEN 'ERROR: Empty or null encoding provided' END AS rejection
        FROM flagged""",
    ),
    "fx3": (
        (),
        """SELECT concat(conv_id::VARCHAR, '-', turn::VARCHAR) AS page_key FROM conversations
        WHERE conv_id % 6 = 0 OR conv_id % 7 = 0""",
    ),
    "fx4e": (
        (),
        """SELECT concat('u', user_id::VARCHAR) AS record_id, concat('h', user_id::VARCHAR) AS content_hash,
            (count(*) % 5)::INTEGER AS attempt_count,
            CASE user_id % 6 WHEN 0 THEN 'PERMANENT_INVALID_ENCODING' WHEN 1 THEN 'PERMANENT_SIZE_LIMIT'
                WHEN 2 THEN NULL ELSE 'TIMEOUT' END AS error_category,
            CASE WHEN user_id % 10 <> 9 THEN max(ts) END AS last_attempt_at
        FROM events WHERE event_type = 'error' GROUP BY user_id""",
    ),
    "fx4p": (
        ("k1",),
        """SELECT record_id, CASE WHEN turn = 5 THEN sha256('changed') ELSE content_hash END AS content_hash,
            (turn % 4)::INTEGER AS attempt_count, 'ERROR: earlier' AS last_error,
            CASE turn WHEN 6 THEN 'PERMANENT_SIZE_LIMIT' WHEN 4 THEN NULL ELSE 'SERVER_ERROR' END AS error_category,
            CASE WHEN turn = 2 THEN TIMESTAMP '2024-01-30 11:59:00' ELSE TIMESTAMP '2024-01-30 06:00:00' END
                AS last_attempt_at, page_key
        FROM k1 WHERE conv_id % 4 = 1""",
    ),
    "states": (
        ("fx4p",),
        f"""SELECT *, CASE
            WHEN coalesce(error_category, 'UNKNOWN') IN ('PERMANENT_INVALID_ENCODING', 'PERMANENT_SIZE_LIMIT')
                OR attempt_count >= 3 THEN 'permanent'
            WHEN last_attempt_at IS NULL
                OR last_attempt_at + to_minutes(CAST(pow(2, attempt_count) AS INTEGER)) <= {AS_OF} THEN 'due'
            ELSE 'waiting' END AS state FROM fx4p""",
    ),
    "fx5": (
        (),
        """SELECT concat(conv_id::VARCHAR, '-', turn::VARCHAR) AS page_key,
            (CASE (conv_id * 8 + turn) % 12 WHEN 9 THEN 429 WHEN 10 THEN 503 ELSE 200 END)::INTEGER AS status_code,
            CASE (conv_id * 8 + turn) % 12
            WHEN 0 THEN json_object('value', json_object('content', concat('|--|--|', chr(10), text), 'confidence',
                json_object('layout_score', turn / 10.0::DOUBLE, 'parse_score', 'nan', 'ocr_score', 0.5::DOUBLE))::VARCHAR)::VARCHAR
            WHEN 1 THEN json_object('value', CASE WHEN conv_id % 3 = 0
                THEN '{"content":"bare","confidence":{"table_score": NaN,"ocr_score":0.25,"parse_score":-Infinity}}'
                ELSE json_object('content', concat('![i](u) ', text), 'confidence', json_object('table_score', 1))::VARCHAR END)::VARCHAR
            WHEN 2 THEN json_object('value', CASE WHEN conv_id % 3 = 0 THEN concat('{"content":"x"} ', text) ELSE text END)::VARCHAR
            WHEN 3 THEN CASE WHEN conv_id % 2 = 0 THEN '{"value":"x"} {"more":1}' ELSE '{"other":1}' END
            WHEN 4 THEN json_object('value', '{"note":"none"}')::VARCHAR
            WHEN 5 THEN json_object('value', '{"content":null}')::VARCHAR
            WHEN 6 THEN 'not json'
            WHEN 7 THEN json_object('value', '{"content":"x","confidence":null}')::VARCHAR
            WHEN 8 THEN '{"value":null}'
            WHEN 9 THEN CASE WHEN conv_id % 2 = 1 THEN 'Encoding exceeds size limit' ELSE 'slow down' END
            WHEN 10 THEN CASE WHEN conv_id % 2 = 1 THEN 'gateway timed out' ELSE 'unavailable' END
            WHEN 11 THEN json_object('value', json_object('content', concat('ERROR: ', text))::VARCHAR)::VARCHAR
            END AS body
        FROM conversations""",
    ),
    "outer5": (
        ("fx5",),
        """SELECT *, CASE WHEN json_valid(body) THEN json_type(body) END AS doc_type,
            CASE WHEN json_valid(body) THEN json_type(body, '$.value') END AS value_type,
            CASE WHEN json_valid(body) THEN body ->> '$.value' END AS value_text FROM fx5""",
    ),
    "inner5": (
        ("outer5",),
        """SELECT *, CASE WHEN value_type = 'VARCHAR' AND json_valid(value_text) THEN value_text END AS inner_text
        FROM outer5""",
    ),
}


def parsed(mode: str) -> str:
    score = lambda name: f"""CASE WHEN error IS NULL AND isfinite(TRY_CAST(inner_text ->> '$.confidence.{name}' AS DOUBLE))
        THEN TRY_CAST(inner_text ->> '$.confidence.{name}' AS DOUBLE) END AS {name}"""
    return f"""SELECT *,
        CASE WHEN error IS NULL THEN CASE WHEN inner_text IS NULL THEN value_text ELSE inner_text ->> '$.content' END END AS content,
        {', '.join(score(s) for s in ('layout_score', 'parse_score', 'ocr_score', 'table_score'))}
    FROM (SELECT *, CASE
        WHEN {mode} IS NULL THEN NULL
        WHEN status_code >= 400 THEN concat('ERROR: ', {mode}, ' API failed ', status_code::VARCHAR, ': ', coalesce(body, ''))
        WHEN doc_type IS NULL THEN 'ERROR: Network error - response is not JSON'
        WHEN doc_type <> 'OBJECT' THEN 'ERROR: Unexpected error - response is not an object'
        WHEN value_type IS NULL THEN concat('ERROR: No ''value'' field in response: ', body)
        WHEN value_type <> 'VARCHAR' THEN 'ERROR: Unexpected error - value is not text'
        WHEN inner_text IS NULL THEN NULL
        WHEN json_type(inner_text) <> 'OBJECT' THEN 'ERROR: Unexpected error - value is not an object'
        WHEN json_type(inner_text, '$.content') IS NULL THEN concat('ERROR: No ''content'' field in value: ', inner_text)
        WHEN json_type(inner_text, '$.confidence') <> 'OBJECT' THEN 'ERROR: Unexpected error - confidence is not an object'
        END AS error FROM inner5)"""


CTE["parsed5"] = (("inner5",), parsed("'Page'"))


def category(text: str) -> str:
    return f"""CASE WHEN coalesce({text}, '') = '' THEN 'UNKNOWN'
        WHEN lower({text}) LIKE '%invalid or missing encoding%' THEN 'PERMANENT_INVALID_ENCODING'
        WHEN lower({text}) LIKE '%encoding exceeds size limit%' THEN 'PERMANENT_SIZE_LIMIT'
        WHEN regexp_matches(lower({text}), 'timeout|timed out') THEN 'TIMEOUT'
        WHEN regexp_matches(lower({text}), '429|rate limit|too many requests') THEN 'RATE_LIMIT'
        WHEN regexp_matches({text}, '500|502|503|504') THEN 'SERVER_ERROR'
        WHEN regexp_matches(lower({text}), '401|403|unauthorized|forbidden') THEN 'AUTH_ERROR'
        WHEN regexp_matches(lower({text}), 'connection|network') THEN 'NETWORK_ERROR'
        WHEN regexp_matches(lower({text}), '400|bad request') THEN 'BAD_REQUEST'
        ELSE 'UNKNOWN' END"""


def category_by_status(text: str, status: str) -> str:
    return f"""CASE WHEN {status} IS NULL OR {status} < 400 THEN {category(text)}
        WHEN lower({text}) LIKE '%invalid or missing encoding%' THEN 'PERMANENT_INVALID_ENCODING'
        WHEN lower({text}) LIKE '%encoding exceeds size limit%' THEN 'PERMANENT_SIZE_LIMIT'
        WHEN regexp_matches(lower({text}), 'timeout|timed out') THEN 'TIMEOUT'
        WHEN {status} = 429 THEN 'RATE_LIMIT' WHEN {status} IN (500, 502, 503, 504) THEN 'SERVER_ERROR'
        WHEN {status} IN (401, 403) THEN 'AUTH_ERROR' WHEN {status} = 400 THEN 'BAD_REQUEST' ELSE 'UNKNOWN' END"""


def words(text: str) -> str:
    return f"len(regexp_extract_all({text}, '[^{WS}]+'))::INTEGER"


def analysis(text: str, skip: str) -> str:
    return f"""CASE WHEN {skip} THEN false ELSE contains({text}, '|--') AND contains({text}, '--|') END AS has_table,
        CASE WHEN {skip} THEN false ELSE contains({text}, '[Image]') OR contains({text}, '![') END AS has_image,
        CASE WHEN {skip} THEN 0 ELSE {words(text)} END AS word_count"""


def merged_stage(text: str, stage: str, at: str) -> str:
    return f"""CASE WHEN json_valid({text}) AND CASE WHEN json_valid({text}) THEN json_type({text}) END = 'OBJECT'
        THEN json_merge_patch({text}, json_object({stage}, '{at}'))::VARCHAR
        ELSE json_object({stage}, '{at}')::VARCHAR END"""


NOW = "2024-01-30T12:00:00"
CTE["messages"] = (
    (),
    "SELECT event_id, CASE event_id % %d %s END AS message FROM events"
    .replace("event_id % %d", f"event_id % {len(MESSAGES)}")
    .replace("%s", " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MESSAGES) if m is not None)),
)
CTE["fx8"] = (
    (),
    """SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN ''
        WHEN doc_id % 13 = 0 THEN concat('ERROR: ', text)
        WHEN doc_id % 7 = 0 THEN concat('|--|--|', chr(10), text)
        WHEN doc_id % 7 = 1 THEN concat('| --- | --- |', chr(10), text)
        WHEN doc_id % 11 = 0 THEN concat('![i](u) ', text)
        WHEN doc_id % 11 = 1 THEN concat('[Image] ', text) ELSE text END AS markdown FROM documents""",
)
CTE["fx9"] = (
    (),
    """SELECT event_id, CASE event_id % 11 WHEN 0 THEN (event_id / 16.0::DOUBLE)::VARCHAR
        WHEN 1 THEN 'nan' WHEN 2 THEN 'NaN' WHEN 3 THEN '-inf' WHEN 4 THEN 'Infinity' WHEN 5 THEN 'abc'
        WHEN 6 THEN '' WHEN 8 THEN ' 0.5 ' WHEN 9 THEN '1e400' WHEN 10 THEN '1' END AS raw FROM events""",
)

# Planning. ``pages`` is the keyed page table the plan is made for.


def plan(pages: str) -> dict[str, tuple[tuple[str, ...], str]]:
    return {
        "fresh": (
            (pages, "fx3", "states"),
            f"""SELECT a.page_key, a.record_id, a.content_hash, coalesce(s.attempt_count, 0)::INTEGER AS attempt_count
            FROM {pages} a LEFT JOIN states s ON a.record_id = s.record_id AND a.content_hash = s.content_hash
            WHERE a.ingest_id = 2 AND a.page_key NOT IN (SELECT page_key FROM fx3)
                AND coalesce(s.state, 'due') = 'due'""",
        ),
        "candidates": (
            (pages, "fx3", "states"),
            f"""SELECT p.page_key, p.record_id, p.content_hash, s.attempt_count,
                p.page_key IN (SELECT page_key FROM fx3) AS done
            FROM {pages} p JOIN states s ON p.record_id = s.record_id AND p.content_hash = s.content_hash
            WHERE p.ingest_id = 1 AND s.state = 'due'""",
        ),
        "retries": (
            ("candidates", "fresh"),
            """SELECT * FROM candidates c WHERE done OR NOT EXISTS (SELECT 1 FROM fresh f
                WHERE f.page_key = c.page_key
                    AND (f.record_id <> c.record_id OR f.content_hash <> c.content_hash))""",
        ),
        "work": (
            ("fresh", "retries"),
            """SELECT page_key, record_id, content_hash, 'retry' AS origin, attempt_count, done FROM retries
            UNION ALL
            SELECT page_key, record_id, content_hash, 'added', attempt_count, false FROM fresh f
            WHERE NOT EXISTS (SELECT 1 FROM retries r WHERE NOT r.done AND r.page_key = f.page_key
                AND r.record_id = f.record_id AND r.content_hash = f.content_hash)""",
        ),
    }


def with_ctes(body: str, *needed: str, extra: dict[str, tuple[tuple[str, ...], str]] | None = None) -> str:
    """A statement with the common table expressions it needs, in order."""
    defined = {**CTE, **(extra or {})}
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for inner in defined[name][0]:
                visit(inner)
            order.append(name)

    for name in needed:
        visit(name)
    ctes = ",\n".join(f"{n} AS ({defined[n][1]})" for n in order)
    return f"WITH {ctes}\n{body}" if ctes else body


PAGE_NAMES = (
    "page_key, doc_id, doc_path, media_ref, page_number, total_pages, page_payload, page_image"
)
SCORE_NAMES = "layout_score, parse_score, ocr_score, table_score"

# One page through the checks, the service and the analysis, by outcome.
CTE["answered"] = (
    ("rejected", "inner5"),
    """SELECT r.*, CASE WHEN r.use_image THEN 'Image' ELSE 'Page' END AS mode, i.* EXCLUDE (page_key)
    FROM rejected r JOIN inner5 i USING (page_key)""",
)
CTE["outcome"] = (
    ("answered",),
    "SELECT * REPLACE (coalesce(rejection, error) AS error, CASE WHEN rejection IS NULL THEN content END AS content,"
    + ", ".join(f"CASE WHEN rejection IS NULL THEN {s} END AS {s}" for s in SCORE_NAMES.split(", "))
    + ", CASE WHEN rejection IS NULL THEN status_code END AS status_code) FROM ("
    + parsed("mode").replace("FROM inner5", "FROM answered")
    + ")",
)
STAGE = "CASE WHEN error IS NULL THEN 'markdown conversion completed' ELSE 'markdown conversion failed' END"
CTE["finished"] = (
    ("outcome",),
    f"""SELECT {PAGE_NAMES}, {STAGE} AS status,
        {merged_stage('stage_times', STAGE, NOW)} AS stage_times,
        content AS markdown, {SCORE_NAMES},
        {analysis('content', "error IS NOT NULL OR coalesce(content, '') = ''")},
        error, status_code, record_id, content_hash, ingest_id FROM outcome""",
)
SUCCESS_NAMES = f"{PAGE_NAMES}, status, stage_times, markdown, {SCORE_NAMES}, has_table, has_image, word_count"

OUTCOME_COUNTS = """count(*) AS processed_count,
    count(*) FILTER (error IS NULL) AS success_count,
    count(*) FILTER (error IS NOT NULL) AS error_count,
    count(*) FILTER (error = 'ERROR: Invalid or missing encoding') AS invalid_count,
    count(*) FILTER (has_table) AS table_count,
    count(*) FILTER (has_image) AS image_count,
    count(*) FILTER (error IS NULL AND markdown IS NULL) AS null_content_count,
    count(*) FILTER (error IS NULL) / count(*)::DOUBLE * 100.0::DOUBLE AS success_rate,
    count(*) FILTER (error IS NOT NULL) / count(*)::DOUBLE AS error_rate"""

BATCH = plan("k1")
BATCH["done_pages"] = (
    ("work", "finished"),
    """SELECT f.*, w.origin, w.attempt_count FROM finished f JOIN work w
        ON f.page_key = w.page_key AND f.record_id = w.record_id AND f.content_hash = w.content_hash
    WHERE NOT w.done""",
)
BATCH["new_errors"] = (
    ("done_pages",),
    f"""SELECT record_id, content_hash, (attempt_count + 1)::INTEGER AS attempt_count, error AS last_error,
        {category_by_status('error', 'status_code')} AS error_category, {AS_OF} AS last_attempt_at,
        page_key
    FROM done_pages WHERE error IS NOT NULL""",
)
TIMES = """strftime(last_attempt_at, '%Y-%m-%d %H:%M:%S') AS last_attempt_at,
    CAST(last_attempt_at AS DATE) AS error_date"""


def catalog_after(settled: str, replaced: str) -> str:
    return f"""SELECT record_id, content_hash, attempt_count, last_error, error_category, {TIMES}, page_key
    FROM (
        SELECT record_id, content_hash, attempt_count, last_error, error_category, last_attempt_at, page_key FROM fx4p c
        WHERE NOT EXISTS (SELECT 1 FROM {settled} s WHERE s.record_id = c.record_id AND s.content_hash = c.content_hash)
            AND NOT EXISTS (SELECT 1 FROM {replaced} r WHERE r.page_key = c.page_key
                AND (r.record_id <> c.record_id OR r.content_hash <> c.content_hash))
        UNION ALL SELECT record_id, content_hash, attempt_count, last_error, error_category, last_attempt_at, page_key
        FROM new_errors)"""


TRIED = {
    "tried": (("k1",), "SELECT * FROM k1 WHERE ingest_id = 2"),
    "new_errors": (
        ("tried", "fx4p", "parsed5"),
        f"""SELECT t.record_id, t.content_hash, (coalesce(c.attempt_count, 0) + 1)::INTEGER AS attempt_count,
            p.error AS last_error, {category_by_status('p.error', 'p.status_code')} AS error_category,
            {AS_OF} AS last_attempt_at, t.page_key
        FROM tried t JOIN parsed5 p USING (page_key)
        LEFT JOIN fx4p c ON c.record_id = t.record_id AND c.content_hash = t.content_hash
        WHERE p.error IS NOT NULL""",
    ),
}


def html_to_markdown(html: str) -> str:
    text = html
    for pattern, replacement in MARKDOWN_RULES:
        escape = lambda s: s.replace("'", "''").replace("\n", "' || chr(10) || '")
        text = f"regexp_replace({text}, '{escape(pattern)}', '{escape(replacement)}', 'g')"
    return text


def is_permanent(c: str = "") -> str:
    return f"""(coalesce({c}error_category, 'UNKNOWN') IN ('PERMANENT_INVALID_ENCODING', 'PERMANENT_SIZE_LIMIT')
        OR {c}attempt_count >= 3)"""


ONE_SHOT = with_ctes(
    f"""SELECT {SUCCESS_NAMES.replace(' markdown,', ' coalesce(error, markdown) AS markdown,')} FROM finished""",
    "finished",
)
BATCH_RUN = with_ctes(f"SELECT {SUCCESS_NAMES} FROM done_pages WHERE error IS NULL", "done_pages", extra=BATCH)

SQL: dict[str, str] = {
    "page_keys": with_ctes(
        f"""SELECT page_key, doc_id, page_number, record_id, content_hash, length(page_payload)::INTEGER AS page_length,
        length(page_image)::INTEGER AS image_length,
        NOT coalesce(regexp_matches(page_payload, '[^{WS}]'), false) AS page_blank,
        NOT coalesce(regexp_matches(page_image, '[^{WS}]'), false) AS image_blank FROM k1""",
        "k1",
    ),
    "page_flags": with_ctes("SELECT page_key, doc_id, use_image FROM flagged", "flagged"),
    "payload_choice": with_ctes(
        """SELECT page_key, CASE WHEN use_image THEN 'Image' ELSE 'Page' END AS mode,
        sha256(payload) AS payload_hash, length(payload)::INTEGER AS payload_length FROM flagged""",
        "flagged",
    ),
    "payload_validity": with_ctes(
        """SELECT page_key, coalesce(length(page_payload) > 200, false) AS page_valid,
        coalesce(length(payload) > 200, false) AS payload_valid,
        CASE WHEN coalesce(length(payload), 0) <= 200 THEN 'ERROR: Invalid or missing encoding' END AS error FROM flagged""",
        "flagged",
    ),
    "payload_guard": with_ctes(
        """SELECT page_key, CASE WHEN page_number = 3 THEN 'ERROR: Empty or null encoding provided'
        WHEN length(page_payload) > 500 THEN 'ERROR: Encoding exceeds size limit' END AS error FROM fx1""",
        "fx1",
    ),
    "request_docs": with_ctes(
        """SELECT page_key, CASE WHEN use_image THEN 'Image' ELSE 'Page' END AS mode,
        CASE WHEN NOT use_image THEN sha256(payload) END AS page_hash,
        CASE WHEN use_image THEN sha256(payload) END AS image_hash,
        CASE WHEN NOT use_image THEN 'true' END AS include_images,
        CASE WHEN NOT use_image THEN 'true' END AS include_ocr,
        CASE WHEN NOT use_image AND page_number <> 2 THEN page_number::VARCHAR END AS page_number FROM flagged""",
        "flagged",
    ),
    "parse_response": with_ctes(f"SELECT page_key, content, {SCORE_NAMES}, error FROM parsed5", "parsed5"),
    "clean_scores": with_ctes(
        """SELECT event_id, CASE WHEN isfinite(TRY_CAST(trim(raw) AS DOUBLE)) THEN TRY_CAST(trim(raw) AS DOUBLE) END
        AS score FROM fx9""",
        "fx9",
    ),
    "content_analysis": with_ctes(
        f"""SELECT doc_id, {analysis('markdown', "coalesce(markdown, '') = '' OR starts_with(markdown, 'ERROR:')")}
        FROM fx8""",
        "fx8",
    ),
    "word_count_whole": f"SELECT doc_id, {words('text')} AS word_count FROM documents",
    "classify_error": with_ctes(f"SELECT event_id, {category('message')} AS error_category FROM messages", "messages"),
    "stage_times": with_ctes(
        f"""SELECT page_key, unnest(json_keys(m)) AS stage,
            unnest(list_transform(json_keys(m), lambda k: json_extract_string(m, concat('$."', k, '"')))) AS at
        FROM (SELECT page_key, {merged_stage('stage_times', "'markdown conversion completed'", NOW)}::JSON AS m
            FROM fx1)""",
        "fx1",
    ),
    "conform_schema": with_ctes(
        f"""SELECT {PAGE_NAMES.replace('page_number', 'CAST(NULL AS INTEGER) AS page_number')}, status, stage_times
        FROM fx1""",
        "fx1",
    ),
    "fail_batch": with_ctes(
        f"""SELECT {PAGE_NAMES}, 'OAuth2 authentication failed' AS status,
            '{{"markdown conversion failed":"{NOW}"}}' AS stage_times,
            'ERROR: OAuth2 authentication failed' AS markdown,
            {', '.join(f'CAST(NULL AS DOUBLE) AS {s}' for s in SCORE_NAMES.split(', '))},
            false AS has_table, false AS has_image, 0 AS word_count FROM fx1""",
        "fx1",
    ),
    "dedup_added": with_ctes(
        """SELECT page_key, record_id, content_hash FROM k1d
        QUALIFY row_number() OVER (PARTITION BY page_key ORDER BY content_hash, record_id) = 1""",
        "k1d",
    ),
    "key_audit": with_ctes(
        """SELECT count(*) AS row_count, count(DISTINCT page_key) AS distinct_count,
        count(*) - count(DISTINCT page_key) AS duplicate_count FROM fx1d""",
        "fx1d",
    ),
    "unseen_pages": with_ctes(
        "SELECT page_key, record_id FROM k1 WHERE ingest_id = 2 AND page_key NOT IN (SELECT page_key FROM fx3)",
        "k1",
        "fx3",
    ),
    "error_split": with_ctes(
        f"""SELECT record_id, attempt_count, error_category,
        CASE WHEN {is_permanent()} THEN 'permanent' ELSE 'retriable' END AS split FROM fx4e""",
        "fx4e",
    ),
    "due_retries": with_ctes(
        f"""SELECT record_id, content_hash, attempt_count,
            strftime(last_attempt_at, '%Y-%m-%d %H:%M:%S') AS last_attempt_at FROM fx4e
        WHERE NOT {is_permanent()} AND (last_attempt_at IS NULL OR
            last_attempt_at + to_minutes(CAST(pow(2, attempt_count) AS INTEGER)) <= TIMESTAMP '2024-01-30 00:00:00')""",
        "fx4e",
    ),
    "retry_candidates": with_ctes(
        "SELECT page_key, record_id, content_hash, attempt_count, done FROM candidates", "candidates", extra=BATCH
    ),
    "work_plan": with_ctes("SELECT * FROM work", "work", extra=plan("k1c")),
    "result_split": with_ctes(
        """SELECT page_key, starts_with(coalesce(error, content, ''), 'ERROR:') AS failed_by_text,
        error IS NOT NULL AS failed FROM parsed5""",
        "parsed5",
    ),
    "error_catalog": with_ctes(catalog_after("tried", "tried"), "tried", "new_errors", "fx4p", extra=TRIED),
    "dedup_success": with_ctes(
        """SELECT k.page_key, k.record_id, k.content_hash, p.content, p.parse_score
        FROM k1d k JOIN parsed5 p USING (page_key) WHERE p.error IS NULL
        QUALIFY row_number() OVER (PARTITION BY k.page_key ORDER BY k.content_hash, k.record_id) = 1""",
        "k1d",
        "parsed5",
    ),
    "run_metrics": with_ctes(f"SELECT {OUTCOME_COUNTS} FROM finished", "finished"),
    "error_summary": with_ctes(
        """SELECT coalesce(error_category, 'UNKNOWN') AS error_category, count(*) AS error_count,
            avg(attempt_count) AS avg_attempts, count(*) FILTER (attempt_count >= 3) AS exhausted_count,
            count(*) FILTER (error_category IN ('PERMANENT_INVALID_ENCODING', 'PERMANENT_SIZE_LIMIT'))
                AS permanent_count
        FROM fx4e GROUP BY 1""",
        "fx4e",
    ),
    "error_counts": with_ctes(
        f"SELECT {category('message')} AS error_category, count(*) AS error_count FROM messages GROUP BY 1", "messages"
    ),
    "error_top5": with_ctes(
        f"""SELECT {category('message')} AS error_category, count(*) AS error_count FROM messages GROUP BY 1
        ORDER BY error_count DESC, error_category LIMIT 5""",
        "messages",
    ),
    "sample_rows": with_ctes("SELECT page_key, stage_times FROM fx1 ORDER BY page_key LIMIT 5", "fx1"),
    "breaker_check": with_ctes(
        f"""SELECT processed_count, error_count, error_rate,
            processed_count >= 100 AND error_count >= 100 AND error_rate >= 0.9 AS tripped
        FROM (SELECT {OUTCOME_COUNTS} FROM finished)""",
        "finished",
    ),
    "one_shot": ONE_SHOT,
    "one_shot_chunked": ONE_SHOT,
    "convert_pages": f"""SELECT page_key, markdown, parse_score, ocr_score, has_table, has_image, word_count, error
        FROM (SELECT *, {analysis('markdown', "error IS NOT NULL OR coalesce(markdown, '') = ''")} FROM (
            SELECT page_key, error, CASE WHEN error IS NULL THEN {html_to_markdown('html')} END AS markdown,
                CASE WHEN error IS NULL THEN 1.0::DOUBLE END AS parse_score, CAST(NULL AS DOUBLE) AS ocr_score
            FROM (SELECT concat('page-', page_id::VARCHAR) AS page_key, html,
                CASE WHEN length({b64('html')}) <= 200 THEN 'ERROR: Invalid or missing encoding' END AS error
                FROM pages)))""",
    "batch_run": BATCH_RUN,
    "batch_run_catalog": with_ctes(
        catalog_after("work", "(SELECT * FROM work WHERE origin = 'added')"), "work", "new_errors", "fx4p", extra=BATCH
    ),
    "batch_run_metrics": with_ctes(
        """SELECT 'run-2' AS run_id, count(*) AS planned_count,
            count(*) FILTER (origin = 'added') AS added_count, count(*) FILTER (origin = 'retry') AS retry_count,
            count(*) FILTER (NOT invalid) AS valid_count, count(*) FILTER (invalid) AS invalid_count,
            count(*) FILTER (error IS NULL) AS success_count, count(*) FILTER (error IS NOT NULL) AS error_count,
            count(*) FILTER (error IS NOT NULL AND NOT invalid) AS conversion_error_count,
            count(*) FILTER (has_table) AS table_count, count(*) FILTER (has_image) AS image_count,
            count(*) FILTER (error IS NULL AND markdown IS NULL) AS null_content_count,
            count(*) FILTER (error IS NULL) / count(*)::DOUBLE * 100.0::DOUBLE AS success_rate,
            count(*) FILTER (error IS NOT NULL) / count(*)::DOUBLE AS error_rate,
            (SELECT count(*) - count(DISTINCT page_key) FROM k1 WHERE ingest_id = 2) AS duplicate_count,
            (SELECT count(*) FROM k1 WHERE ingest_id = 2 AND page_key IN (SELECT page_key FROM fx3)) AS succeeded_before_count,
            (SELECT count(*) FROM k1 JOIN states s USING (record_id, content_hash)
                WHERE ingest_id = 2 AND k1.page_key NOT IN (SELECT page_key FROM fx3) AND s.state <> 'due') AS held_count,
            (SELECT count(*) FROM states WHERE state = 'due') AS due_count,
            (SELECT count(*) FROM states WHERE state = 'waiting') AS waiting_count,
            (SELECT count(*) FROM states WHERE state = 'permanent') AS permanent_count
        FROM (SELECT *, coalesce(error = 'ERROR: Invalid or missing encoding', false) AS invalid FROM done_pages)""",
        "done_pages",
        "states",
        extra=BATCH,
    ),
    "batch_run_report": with_ctes(
        """SELECT 'run-2' AS run_id, error_category, count(*) AS error_count, avg(attempt_count) AS avg_attempts,
            count(*) FILTER (attempt_count >= 3) AS exhausted_count,
            count(*) FILTER (error_category IN ('PERMANENT_INVALID_ENCODING', 'PERMANENT_SIZE_LIMIT')) AS permanent_count
        FROM new_errors GROUP BY error_category""",
        "new_errors",
        extra=BATCH,
    ),
    "stream_run": BATCH_RUN,
    "stream_retries": with_ctes(
        f"""SELECT record_id, content_hash, CASE WHEN given_up THEN 1 ELSE 3 END::INTEGER AS attempt_count, error AS last_error,
            error_category, CASE WHEN given_up THEN '2024-01-30 12:00:00' ELSE '2024-01-30 12:06:45' END AS last_attempt_at,
            DATE '2024-01-30' AS error_date, page_key
        FROM (SELECT *, error_category IN ('PERMANENT_INVALID_ENCODING', 'PERMANENT_SIZE_LIMIT') AS given_up
            FROM (SELECT *, {category_by_status('error', 'status_code')} AS error_category FROM finished WHERE error IS NOT NULL))""",
        "finished",
    ),
}
