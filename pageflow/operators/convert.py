"""The converter slot: how a page's payload becomes a service answer.

A converter takes a frame with ``page_key, payload, page_number, mode`` (and any other columns, which
are carried along) and adds ``status_code int, body string, call_error string``. Pages whose ``payload``
is null have been turned away already and are not sent.

A converter may have ``for_plan(plan, folder)``, which is given a plan's rows (``page_key, chunk``) and a work folder before
any chunk is fetched, and returns the converter of each chunk.
"""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import AccumulatorParam, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow import schemas
from pageflow.functions.requests import request_document
from pageflow.operators.joins import probe_in_place
from pageflow.settings import IMAGE_MODE
from pageflow.sources.tables import read_or_empty

Converter = Callable[[DataFrame], DataFrame]
PageCall = Callable[[str, int | None, str], tuple[int, str]]


# Bytes of recorded answers that are broadcast at once.
ANSWER_BYTES = 128 << 20
# Files of a chunk's recorded answers at most, so that many large answers are not one task's.
ANSWER_SLOTS = 8


class MostByTask(AccumulatorParam):
    """Counts by task, the most that any attempt of a task has seen: a task that is repeated counts once."""

    def zero(self, value: dict) -> dict:
        return {}

    def addInPlace(self, a: dict, b: dict) -> dict:
        return a | {task: max(n, a.get(task, 0)) for task, n in b.items()}


def python_converter(open_service: Callable[[], PageCall], calls_at_once: int = 1, documents: bool = False) -> Converter:
    """Converter around a Python call per page.

    ``open_service`` runs once per task and returns ``call(payload, page_number, mode) -> (status_code,
    body)``; a session or token it opens lives as long as the task. Only the three arguments travel to
    Python, in Arrow batches; the other columns stay in the JVM. A call that raises becomes that page's
    ``call_error``, so one page never fails a task; a service that can't be opened fails all of a task's pages. ``calls_at_once`` overlaps calls that wait on a service.

    With ``documents`` the first argument of a call is the whole request document, as JSON text, instead of the payload.

    ``failed_calls`` of the converter tells, while tasks run on, how many calls certainly failed in those that are done.
    """
    failed: list = []  # the accumulator, as soon as a session is known

    def answered_by(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]], counter) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor

        closed = None
        try:
            call = open_service()
        except Exception as e:
            closed = f"ERROR: Service could not be opened - {type(e).__name__}: {e}"

        def one(page):
            payload, page_number, mode = page
            if payload is None:
                return None, None, None
            if closed:
                return None, None, closed
            number = None if pd.isna(page_number) else int(page_number)
            try:
                status_code, body = call(payload, number, mode)
                return int(status_code), body, None
            except OSError as e:  # the base of connection and time-out errors of HTTP clients as well
                return None, None, f"ERROR: Network error - {e}"
            except Exception as e:
                return None, None, f"ERROR: Unexpected error - {type(e).__name__}: {e}"

        lost = 0
        with ThreadPoolExecutor(max_workers=calls_at_once) as pool:
            for payloads, numbers, modes in batches:
                run = map if calls_at_once == 1 else pool.map
                rows = list(run(one, zip(payloads, numbers, modes)))
                lost += sum(error is not None or code not in (None, 200) for code, _, error in rows)
                out = pd.DataFrame(rows, columns=["status_code", "body", "call_error"])
                yield out.astype({"status_code": "Int32"})
        if lost:
            task = TaskContext.get()
            counter.add({(task.stageId(), task.partitionId()): lost})

    answer_type = "status_code int, body string, call_error string"

    def convert(pages: DataFrame) -> DataFrame:
        if not failed:
            failed.append(pages.sparkSession.sparkContext.accumulator({}, MostByTask()))
        counter = failed[0]

        def answers(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            yield from answered_by(batches, counter)

        call_udf = F.pandas_udf(answers, answer_type).asNondeterministic()
        sent = F.col("payload")
        if documents:
            sent = F.when(sent.isNotNull(), request_document(F.col("mode") == IMAGE_MODE, sent, F.col("page_number")))
        answered = pages.withColumn("_answer", call_udf(sent, "page_number", "mode"))
        return answered.select(*pages.columns, "_answer.*")

    convert.failed_calls = lambda: sum(failed[0].value.values()) if failed else 0
    return convert


def recorded_converter(responses: DataFrame) -> Converter:
    """Converter that replays recorded answers (``page_key, status_code, body``, one per page).

    The answers for the pages at hand are measured and broadcast, in parts if they are many: no payload is shuffled. With
    ``for_plan`` they are dealt to all chunks in one pass, so that a chunk reads its own answers only.
    """
    recorded = responses.select(*[f.name for f in schemas.RESPONSES])

    def replay(pages: DataFrame, own: DataFrame) -> DataFrame:
        size = own.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("body"), F.lit(0)) + 100), F.lit(0))).first()[0]
        joined = probe_in_place(pages, own, ["page_key"], "left", 1 + size // ANSWER_BYTES)
        missing = F.col("payload").isNotNull() & F.col("status_code").isNull() & F.col("body").isNull()
        return joined.withColumn("call_error", F.when(missing, F.lit("ERROR: Network error - no recorded response")))

    def convert(pages: DataFrame) -> DataFrame:
        return replay(pages, recorded.join(pages.select("page_key").distinct(), "page_key", "left_semi"))

    def for_plan(plan: DataFrame, folder: str) -> Callable[[int], Converter]:
        wanted = plan.where(F.col("chunk") >= 0).select("page_key", "chunk").distinct()
        slot = F.pmod(F.xxhash64("page_key"), F.lit(ANSWER_SLOTS))
        dealt = recorded.join(wanted, "page_key").repartition("chunk", slot)
        dealt.write.mode("overwrite").partitionBy("chunk").parquet(folder)
        return lambda chunk: lambda pages: replay(pages, read_or_empty(pages.sparkSession, schemas.RESPONSES, f"{folder}/chunk={chunk}"))

    convert.for_plan = for_plan
    return convert


def by_chunk(converter: Converter, plan: DataFrame, folder: str) -> Callable[[int], Converter]:
    """The converter of each chunk of a plan."""
    deal = getattr(converter, "for_plan", None)
    return deal(plan, folder) if deal is not None else lambda chunk: converter
