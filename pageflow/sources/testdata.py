"""The pipeline's tables, derived by expression from the shared test tables.

Every row of the tables used takes part. Remainders of ids stand for the state a pipeline would be in
(which pages arrived earlier, which failed, what the service answered); they never cut a table down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow import schemas
from pageflow.functions.keys import content_hash, record_id
from pageflow.operators.joins import PLAIN_ROWS, probe_in_place
from pageflow.operators.tables import conform_schema
from pageflow.sources.tables import read_pages, with_row_ref

AS_OF = "2024-01-30 12:00:00"
STAGE_AT = "2024-01-01T00:00:00"
# Pages of a stored file at most.
FILE_ROWS = 10_000


def as_of(text: str = AS_OF) -> Column:
    return F.lit(text).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base64_of(expr: str) -> str:
    """Base64 on one line; the built-in wraps lines."""
    return f"replace(base64(cast({expr} as binary)), '\\r\\n', '')"


PAGE_KEY = "concat(conv_id, '-', turn)"
DOC_ID = "concat('conv-', conv_id)"
STAGE_TIMES = f"""case conv_id % 6
    when 1 then ''
    when 2 then '{{"page split completed": "{STAGE_AT}"}}'
    when 3 then 'bad'
    when 4 then '[1]'
    when 5 then '{{"page split completed": "{STAGE_AT}", "markdown conversion completed": "2024-01-01T01:00:00"}}'
    end"""

PAGE_EXPRESSIONS = {
    "page_key": PAGE_KEY,
    "doc_id": DOC_ID,
    "doc_path": "concat('/docs/', conv_id, '.pdf')",
    "media_ref": "cast(null as string)",
    "page_number": "cast(turn as int)",
    "total_pages": "cast(total_pages as int)",
    "page_payload": base64_of("text"),
    "page_image": f"case when conv_id % 5 = 0 and turn % 2 = 0 then {base64_of('concat(text, text)')} end",
    "status": "'page split completed'",
    "stage_times": STAGE_TIMES,
    "ingest_id": "case when conv_id % 3 = 0 then 2 else 1 end",
    "row_file": "row_file",
    "row_index": "row_index",
}


def page_batch(spark: SparkSession, sf_dir: str, *carry: str, totals: bool = True) -> DataFrame:
    """FX1: one conversation is a document, one turn a page."""
    turns = with_row_ref(table(spark, sf_dir, "conversations"))
    if totals:
        per_doc = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("total_pages"))
        turns = probe_in_place(turns, per_doc, ["conv_id"], "left", 1 + per_doc.count() // (10 * PLAIN_ROWS))
    names = [n for n in PAGE_EXPRESSIONS if totals or n != "total_pages"]
    return turns.select(*[F.expr(PAGE_EXPRESSIONS[n]).alias(n) for n in names], *carry)


def stored_page_batch(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """FX1 as page files, as a run has them: each scan of some pages would otherwise count the turns of all documents."""
    pages = page_batch(spark, sf_dir).drop("row_file", "row_index")
    pages.write.option("maxRecordsPerFile", FILE_ROWS).parquet(folder)
    return read_pages(spark, folder, pages.schema)


def page_batch_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX1d: a second, different row for the pages of every tenth document."""
    pages = page_batch(spark, sf_dir, "conv_id", totals=False)
    copies = pages.where("conv_id % 10 = 0").withColumns(
        {
            "page_payload": F.expr(base64_of("concat('dup ', page_key)")),
            "row_file": F.concat("row_file", F.lit("#copy")),
        }
    )
    return pages.unionByName(copies).drop("conv_id")


def page_batch_with_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX1c: pages of an earlier ingest that arrive again with new content."""
    pages = page_batch(spark, sf_dir, "conv_id", totals=False)
    changed = pages.where("ingest_id = 1 and conv_id % 8 = 1").withColumns(
        {
            "page_payload": F.expr(base64_of("concat('new ', page_key)")),
            "ingest_id": F.lit(2),
            "row_file": F.concat("row_file", F.lit("#changed")),
        }
    )
    return pages.unionByName(changed).drop("conv_id")


def page_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX2: flags of three quarters of the documents."""
    docs = table(spark, sf_dir, "conversations").where("conv_id % 4 <> 3").select("conv_id").distinct()
    return docs.select(F.expr(DOC_ID).alias("doc_id"), F.expr("conv_id % 5 = 0").alias("use_image"))


def success_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX3: keys of earlier successes."""
    done = table(spark, sf_dir, "conversations").where("conv_id % 6 = 0 or conv_id % 7 = 0")
    return done.select(F.expr(PAGE_KEY).alias("page_key"))


def catalog_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX4e: error events by user as a catalog."""
    errors = table(spark, sf_dir, "events").where("event_type = 'error'")
    per_user = errors.groupBy("user_id").agg(F.count("*").alias("n"), F.max("ts").alias("ts"))
    return conform_schema(
        per_user.select(
            F.expr("concat('u', user_id)").alias("record_id"),
            F.expr("concat('h', user_id)").alias("content_hash"),
            F.expr("cast(n % 5 as int)").alias("attempt_count"),
            F.lit("x").alias("last_error"),
            F.expr(
                "case user_id % 6 when 0 then 'PERMANENT_INVALID_ENCODING' when 1 then 'PERMANENT_SIZE_LIMIT' "
                "when 2 then null else 'TIMEOUT' end"
            ).alias("error_category"),
            F.expr("case when user_id % 10 <> 9 then cast(ts as timestamp) end").alias("last_attempt_at"),
            F.expr("case when user_id % 10 <> 9 then cast(ts as date) end").alias("error_date"),
        ),
        schemas.CATALOG,
    )


def catalog_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX4p: a catalog whose rows belong to pages of FX1."""
    pages = page_batch(spark, sf_dir, "conv_id", "turn", totals=False).where("conv_id % 4 = 1")
    at = F.expr(
        "cast(case when turn = 2 then '2024-01-30 11:59:00' else '2024-01-30 06:00:00' end as timestamp)"
    )
    return conform_schema(
        pages.select(
            record_id().alias("record_id"),
            F.when(F.col("turn") == 5, F.sha2(F.lit("changed"), 256)).otherwise(content_hash()).alias("content_hash"),
            F.expr("cast(turn % 4 as int)").alias("attempt_count"),
            F.lit("ERROR: earlier").alias("last_error"),
            F.expr(
                "case turn when 6 then 'PERMANENT_SIZE_LIMIT' when 4 then null else 'SERVER_ERROR' end"
            ).alias("error_category"),
            at.alias("last_attempt_at"),
            F.to_date(at).alias("error_date"),
            "page_key",
        ),
        schemas.CATALOG,
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX5: what the conversion service answered for each page of FX1; page texts are the content."""
    scores = "'layout_score', turn / 10D, 'parse_score', 'nan', 'ocr_score', 0.5D"
    answer = lambda inner: f"to_json(named_struct('value', {inner}))"
    inner = {
        0: f"to_json(named_struct('content', concat('|--|--|\\n', text), 'confidence', named_struct({scores})))",
        1: "if(conv_id % 3 = 0, '{\"content\":\"bare\",\"confidence\":{\"table_score\": NaN,\"ocr_score\":0.25,\"parse_score\":-Infinity}}', "
        "to_json(named_struct('content', concat('![i](u) ', text), 'confidence', named_struct('table_score', 1))))",
        2: "if(conv_id % 3 = 0, concat('{\"content\":\"x\"} ', text), text)",
        4: "'{\"note\":\"none\"}'",
        5: "'{\"content\":null}'",
        7: "'{\"content\":\"x\",\"confidence\":null}'",
        11: "to_json(named_struct('content', concat('ERROR: ', text)))",
    }
    cases = " ".join(f"when {k} then {answer(v)}" for k, v in inner.items())
    body = f"""case (conv_id * 8 + turn) % 12 {cases}
        when 3 then if(conv_id % 2 = 0, '{{"value":"x"}} {{"more":1}}', '{{"other":1}}') when 6 then 'not json' when 8 then '{{"value":null}}'
        when 9 then if(conv_id % 2 = 1, 'Encoding exceeds size limit', 'slow down')
        when 10 then if(conv_id % 2 = 1, 'gateway timed out', 'unavailable') end"""
    return table(spark, sf_dir, "conversations").select(
        F.expr(PAGE_KEY).alias("page_key"),
        F.expr(DOC_ID).alias("doc_id"),
        F.expr("cast(turn as int)").alias("page_number"),
        F.expr(
            "cast(case (conv_id * 8 + turn) % 12 when 9 then 429 when 10 then 503 else 200 end as int)"
        ).alias("status_code"),
        F.expr(body).alias("body"),
    )


MESSAGES = (
    None,
    "",
    "ERROR: Invalid or missing encoding",
    "ERROR: Encoding exceeds size limit",
    "ERROR: Network error - Read timed out",
    "ERROR: Page API failed 429",
    "ERROR: Page API failed 503",
    "ERROR: Page API failed 401: Unauthorized",
    "ERROR: Network error - refused",
    "ERROR: Page API failed 400",
    "ERROR: Page API failed 404",
    "ERROR: Empty or null encoding provided",
    "ERROR: Page API failed 404: 1500 pages",
    "TIMEOUT after 429",
)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX7: an error message per event."""
    cases = " ".join(f"when {i} then '{m}'" for i, m in enumerate(MESSAGES) if m is not None)
    return table(spark, sf_dir, "events").select(
        "event_id", F.expr(f"case event_id % {len(MESSAGES)} {cases} end").alias("message")
    )


def markdown_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX8: documents as markdown with planted markers."""
    markdown = """case when doc_id % 17 = 0 then null
        when doc_id % 19 = 0 then ''
        when doc_id % 13 = 0 then concat('ERROR: ', text)
        when doc_id % 7 = 0 then concat('|--|--|\\n', text)
        when doc_id % 7 = 1 then concat('| --- | --- |\\n', text)
        when doc_id % 11 = 0 then concat('![i](u) ', text)
        when doc_id % 11 = 1 then concat('[Image] ', text)
        else text end"""
    return table(spark, sf_dir, "documents").select("doc_id", F.expr(markdown).alias("markdown"))


def raw_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX9: a score as text per event."""
    raw = """case event_id % 11 when 0 then cast(event_id / 16D as string)
        when 1 then 'nan' when 2 then 'NaN' when 3 then '-inf' when 4 then 'Infinity' when 5 then 'abc'
        when 6 then '' when 8 then ' 0.5 ' when 9 then '1e400' when 10 then '1' end"""
    return table(spark, sf_dir, "events").select("event_id", F.expr(raw).alias("raw"))


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw web pages as a page table: one document of one page each."""
    pages = with_row_ref(table(spark, sf_dir, "pages")).select(
        F.expr("concat('page-', page_id)").alias("page_key"),
        F.col("url").alias("doc_id"),
        F.col("url").alias("doc_path"),
        F.lit(1).alias("page_number"),
        F.lit(1).alias("total_pages"),
        F.expr(base64_of("html")).alias("page_payload"),
        F.lit("page split completed").alias("status"),
        "row_file",
        "row_index",
    )
    return conform_schema(pages, T.StructType([*schemas.PAGE.fields, *schemas.ROW_REF.fields]))
