"""One incremental run: plan, convert each page once, check, write, commit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pageflow import schemas
from pageflow.functions.errors import classify_error
from pageflow.functions.keys import bucket_of, content_hash, record_id
from pageflow.operators.catalog import DUE, KEY, PERMANENT, WAITING, merge_catalog, touched_records, waiting_rows
from pageflow.operators.convert import Converter, by_chunk
from pageflow.operators.joins import heavy_of, key_sketch
from pageflow.operators.metrics import breaker_check, count_if, error_summary, is_tripped, top_categories
from pageflow.operators.payloads import attach_flags, page_keys, rejection
from pageflow.operators.tables import conform_schema, empty
from pageflow.plans.chunks import PLACE, chunk_numbers, differences, fetch, find_again, in_flight, place_sum, with_chunks, with_slices
from pageflow.plans.pages import convert_pages, finish_pages, with_payload
from pageflow.plans.planner import ADDED, RETRY, catalog_states, combine, fresh_pages, mark_done, match_due, one_per_page_key, succeeded
from pageflow.settings import DEFAULTS, MISSING_PAGE, Settings
from pageflow.sources.store import CATALOG_BUCKETS, Head, PageStore
from pageflow.sources.tables import PageFolder

# Progress entry of the planning step; chunks count from 0.
PLANNED = -1
# Chunk of plan rows that fetch no page.
NO_PAGE = -1
FAILURE = ["page_key", *KEY, "attempt_count", "error", "error_category"]


class RepeatedSuccess(RuntimeError):
    """A page would have been in the success table twice; nothing of the run was committed."""


class BreakerTripped(RuntimeError):
    """Nearly everything failed; nothing of the run was committed."""


def run_batch(
    store: PageStore,
    added: DataFrame,
    pages: DataFrame | PageFolder,
    flags: DataFrame,
    converter: Converter,
    as_of: Column,
    run_id: str,
    last_ingest_id: int = -1,
    settings: Settings = DEFAULTS,
) -> None:
    """Process the pages in ``added`` and the retries that are due, and commit the run.

    ``pages`` is the whole page table, with row identity; retried pages are fetched from it. ``run_id``
    makes the run idempotent: committed, it does nothing; broken off, it resumes with what is finished. After a
    tripped breaker it plans and converts anew; after another run's commit in between it plans anew and takes over the
    answers for pages that are still planned. A run is committed only if every planned page has a result or an error,
    and no page key would be in the success table twice.
    """
    head = store.head()
    if run_id in head.runs:
        return
    version = store.version(run_id)
    finished = store.progress(version)
    if PLANNED not in finished:
        planned = _write_plan(store, head, added, flags, as_of, version, settings)
        store.mark_finished(version, PLANNED, last_ingest_id, planned)
        finished[PLANNED] = {"last_ingest_id": last_ingest_id, **planned}
    planned = finished.pop(PLANNED)
    last_ingest_id = planned["last_ingest_id"]
    plan = store.plan(version)
    answered = store.standing_answers(run_id)

    def convert(part: DataFrame, name: str, converter: Converter = converter) -> dict:
        return _write_results(store, version, _results(fetch(pages, part), converter, as_of, settings), name)

    def convert_chunk(chunk: int) -> None:
        rows, taken = plan.where(F.col("chunk") == chunk), {}
        if answered is not None:
            rows, taken = _take_over(store, version, answered, rows, f"answered-{chunk:05d}")
        figures = _total([taken, convert(_part(rows), f"chunk-{chunk:05d}", converter_of(chunk))])
        store.mark_finished(version, chunk, last_ingest_id, figures)
        finished[chunk] = figures

    chunks = chunk_numbers(plan)
    if not chunks:
        store.write(empty(store.spark, schemas.CONVERTED), "results", version)
    left = [c for c in chunks if c not in finished]
    if left:
        todo = plan if len(left) == len(chunks) else plan.where(F.col("chunk").isin(left))
        converter_of = by_chunk(converter, todo, store.path("steps/answers", version))
    before = sum(figures["errors"] for figures in finished.values())
    failed = getattr(converter, "failed_calls", lambda: 0)
    earlier = failed()

    def give_up() -> None:
        """Once it is certain that the breaker will trip, what runs on is stopped."""
        certain = planned["invalid"] + before + failed() - earlier
        if is_tripped(planned["planned"], certain, settings):
            raise _Certain(certain)

    try:
        in_flight(store.spark, convert_chunk, left, settings.chunks_at_once, give_up)
    except _Certain as e:
        _trip(store, run_id, version, plan, planned["planned"], e.args[0])
    done = _total([*finished.values()])

    results = store.read("results", version, schemas.CONVERTED)
    failures, gone = _failures(results, plan), None
    if (done["rows"], done["places"]) != (planned["fetched"], int(planned["places"])):
        fetched = plan.where(F.col("chunk") >= 0)
        gone, places, again = _recover(store, pages, plan, results, convert, version, settings)
        done = _total([done, again])
        results = store.read("results", version, schemas.CONVERTED)
        failures = _failures(results, plan).unionByName(gone)
        left = differences(places, results)
        if left.lost or left.extra:
            raise RuntimeError(f"{left.lost} planned pages of {run_id} have neither a result nor an error, {left.extra} have several")
    missing = gone.count() if gone is not None else 0
    store.write(_metrics(store, planned, done, missing, as_of, run_id), "metrics", version)
    _stop_if_tripped(store, run_id, version, failures, settings)
    _check_keys(store, head, run_id, results)

    arrived = plan.where((F.col("origin") == ADDED) & ~F.col("done"))
    records = touched_records(store.catalog(head), plan, arrived, failures)
    touched = [r[0] for r in records.select(bucket_of("record_id", CATALOG_BUCKETS)).distinct().collect()]
    catalog = merge_catalog(store.catalog(head, touched), plan, arrived, failures, as_of, settings)
    store.write_catalog(catalog, head, version, touched)
    store.write(waiting_rows(failures, as_of, settings), "waiting", version)
    counted = failures.withColumn("attempt_count", F.col("attempt_count") + 1)
    report = error_summary(counted, settings).withColumn("run_id", F.lit(run_id))
    store.write(conform_schema(report, schemas.REPORT), "report", version)
    store.commit(run_id, version, head, last_ingest_id, as_of)
    store.take_snapshot(settings.snapshot_every)


# Figures of converted rows; ``places`` tells which rows they were.
OUTCOMES = ("rows", "successes", "errors", "tables", "images", "null_contents", "places")


def _total(parts: list[dict]) -> dict:
    return {name: sum(int(p.get(name) or 0) for p in parts) for name in OUTCOMES}


def _write_results(store: PageStore, version: str, rows: DataFrame, name: str) -> dict:
    """Write converted rows below the run's results; their figures come from the same pass."""
    failed = F.col("error").isNotNull()
    figures = {
        "rows": F.count("*"),
        "successes": count_if(~failed),
        "errors": count_if(failed),
        "tables": count_if(F.col("has_table")),
        "images": count_if(F.col("has_image")),
        "null_contents": count_if(~failed & F.col("markdown").isNull()),
        "places": place_sum(),
    }
    seen = Observation()
    observed = conform_schema(rows, schemas.CONVERTED).observe(seen, *[f.alias(n) for n, f in figures.items()])
    observed.write.mode("overwrite").parquet(f"{store.path('results', version)}/{name}")
    return seen.get


def _part(rows: DataFrame) -> DataFrame:
    """What a fetch needs of plan rows; a retry must still find the content that failed."""
    expected = F.when(F.col("origin") == RETRY, F.col("content_hash")).alias("expected_hash")
    return rows.select("row_file", "row_index", "slice", "attempt_count", "use_image", expected)


def _take_over(store: PageStore, version: str, answered: DataFrame, rows: DataFrame, name: str) -> tuple[DataFrame, dict]:
    """Write the answers that there are for plan rows already; returns the rows without one, and figures of the others.

    The page must be the planned one: same place, same content. Its attempts count as planned now.
    """
    files = [r.row_file for r in rows.select("row_file").distinct().collect()]
    wanted = F.broadcast(rows.select(*PLACE, F.col("content_hash").alias("_planned"), F.col("attempt_count").alias("_attempts")))
    found = answered.where(F.col("row_file").isin(files)).join(wanted, PLACE)
    same = F.coalesce(F.col("content_hash"), content_hash()) == F.col("_planned")
    kept = found.where(same).withColumn("attempt_count", F.col("_attempts"))
    figures = _write_results(store, version, kept, name)
    done = store.spark.read.schema(schemas.CONVERTED).parquet(f"{store.path('results', version)}/{name}").select(*PLACE)
    return rows.join(done, PLACE, "left_anti"), figures


def _check_keys(store: PageStore, head: Head, run_id: str, results: DataFrame) -> None:
    """Refuse a run that would repeat a success: within itself, or one that is in the success table."""
    keys = results.where(F.col("error").isNull() & F.col("page_key").isNotNull()).groupBy("page_key").agg(F.count("*").alias("n"))
    earlier = succeeded(store.success_keys(head, keys), keys).withColumn("earlier", F.lit(True))
    found = keys.join(earlier, "page_key", "left").agg(count_if(F.col("n") > 1).alias("twice"), count_if(F.col("earlier")).alias("earlier")).first()
    if found.twice or found.earlier:
        store.give_up(run_id)
        raise RepeatedSuccess(
            f"{found.twice} page keys are twice among the successes of {run_id}, {found.earlier} succeeded in earlier runs"
        )


def _recover(
    store: PageStore,
    pages: DataFrame | PageFolder,
    plan: DataFrame,
    results: DataFrame,
    convert: Callable[[DataFrame, str], dict],
    version: str,
    settings: Settings,
) -> tuple[DataFrame, DataFrame, dict]:
    """Convert planned pages that are no longer where the plan says.

    Returns failures for those found nowhere, the places that all others were fetched from, and figures of those converted
    here. Page files may have been compacted, archived or replaced between two runs.
    """
    wanted = plan.where(F.col("chunk") >= 0)
    lost = wanted.join(results.select(*PLACE), PLACE, "left_anti")
    columns = [c for c in plan.columns if c not in ("chunk", "slice")]
    store.write(lost.select(*columns), "steps/lost", version)
    lost = store.read("steps/lost", version, plan.select(*columns).schema)
    expected = lost.count()
    again = with_slices(with_chunks(find_again(pages, lost), expected, settings), expected, F.lit(0), settings)
    store.write(conform_schema(again, schemas.PLAN), "steps/moved", version)
    moved = store.read("steps/moved", version, schemas.PLAN)
    figures = _total([convert(_part(moved.where(F.col("chunk") == chunk)), f"moved-{chunk:05d}") for chunk in chunk_numbers(moved)])
    found = moved.select("page_key", *KEY).toDF("_page", "_record", "_content")
    same = F.col("page_key").eqNullSafe(F.col("_page")) & (F.col("record_id") == F.col("_record")) & (F.col("content_hash") == F.col("_content"))
    gone = lost.join(found, same, "left_anti")
    reasoned = gone.withColumns({"error": F.lit(MISSING_PAGE), "error_category": classify_error(F.lit(MISSING_PAGE))})
    stayed = wanted.select(*PLACE).join(lost.select(*PLACE), PLACE, "left_anti")
    return reasoned.select(*FAILURE), stayed.unionByName(moved.select(*PLACE)), figures


def _write_plan(
    store: PageStore,
    head: Head,
    added: DataFrame,
    flags: DataFrame,
    as_of: Column,
    version: str,
    settings: Settings,
) -> dict:
    """Write the plan; returns its figures. Counts of a table come from the pass that writes it."""
    rows: dict[str, int] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        rows[name] = store.write_observed(df, f"steps/{name}", version, n=F.count("*"))["n"]
        return store.read(f"steps/{name}", version, df.schema)

    keys = store.write_observed(page_keys(added), "keys", version, n=F.count("*"), documents=key_sketch(["doc_id"]))
    rows["added"], large = keys["n"], heavy_of(keys["documents"], keys["n"])
    added_keys = store.read("keys", version, schemas.PAGE_KEYS)
    states = catalog_states(store.catalog(head), as_of, settings)
    of_state = {r.state: r["count"] for r in states.groupBy("state").count().collect()}
    due = states.where(F.col("state") == DUE).drop("state")
    seen = Observation()
    if rows["added"]:
        unique = keep("unique", one_per_page_key(added_keys))
        success = store.success_keys(head, unique)
        fresh = keep("fresh", fresh_pages(unique, success, states, settings, sum(of_state.values()), seen))
    else:
        fresh = empty(store.spark, fresh_pages(added_keys, store.success_keys(head), states, settings).schema)
    retries = match_due(store.known_keys(head, due), due, settings, of_state.get(DUE, 0))
    if of_state.get(DUE):
        matched = keep("matched", retries)
        retries = keep("retries", mark_done(matched, store.success_keys(head, matched), settings, rows["matched"]))
    else:
        retries = empty(store.spark, mark_done(retries, store.success_keys(head), settings).schema)
    work = combine(fresh, retries, settings, rows.get("fresh", 0), rows.get("retries", 0))
    flagged = attach_flags(work, flags, ["page_key", "content_hash"], settings, large)
    pick = lambda what: F.when(F.col("use_image"), F.col(f"image_{what}")).otherwise(F.col(f"page_{what}"))
    error = rejection(pick("length"), pick("blank"), settings)
    decided = flagged.withColumn("error", error)
    expected = rows.get("fresh", 0) + rows.get("retries", 0)
    fetched = ~F.col("done") & F.col("error").isNull()
    size = F.coalesce("page_length", F.lit(0)) + F.coalesce("image_length", F.lit(0))
    if expected <= min(settings.chunk_rows, settings.chunk_files, settings.task_calls):
        plan = decided.withColumns({"chunk": F.when(fetched, F.lit(0)).otherwise(F.lit(NO_PAGE)), "slice": F.lit(0)})
    else:
        decided = keep("decided", decided)
        chunked = with_slices(with_chunks(decided.where(fetched), expected, settings), expected, size, settings)
        plan = chunked.unionByName(decided.where(~fetched).withColumns({"chunk": F.lit(NO_PAGE), "slice": F.lit(0)}))
    todo, is_fetched = ~F.col("done"), F.col("chunk") >= 0
    figures = store.write_observed(
        conform_schema(plan, schemas.PLAN),
        "plan",
        version,
        "chunk",
        planned=count_if(todo),
        added=count_if(todo & (F.col("origin") == ADDED)),
        retried=count_if(todo & (F.col("origin") == RETRY)),
        invalid=count_if(todo & F.col("error").isNotNull()),
        fetched=count_if(is_fetched),
        places=F.coalesce(F.sum(F.when(is_fetched, F.xxhash64(*PLACE).cast("decimal(38,0)"))), F.lit(0)).cast("string"),
    )
    unseen = seen.get["n"] if rows["added"] else 0
    return {
        **figures,
        "duplicates": rows["added"] - rows.get("unique", 0),
        "succeeded_before": rows.get("unique", 0) - unseen,
        "held": unseen - rows.get("fresh", 0),
        **{state: of_state.get(state, 0) for state in (DUE, WAITING, PERMANENT)},
    }


def _results(wide: DataFrame, converter: Converter, as_of: Column, settings: Settings) -> DataFrame:
    """Convert a chunk. A failed page keeps its keys for the catalog and leaves its payloads behind."""
    failed = F.col("error").isNotNull()
    parsed = convert_pages(with_payload(wide), converter)
    rows = finish_pages(parsed, as_of)
    category = F.when(failed, classify_error(F.col("error"), F.col("status_code")))
    keyed = rows.select(
        *[c for c in rows.columns if c not in ("page_payload", "page_image")],
        F.when(failed, record_id()).alias("record_id"),
        F.when(failed, content_hash()).alias("content_hash"),
        category.alias("error_category"),
        *[F.when(~failed, F.col(c)).alias(c) for c in ("page_payload", "page_image")],
    )
    return conform_schema(keyed, schemas.CONVERTED)


def _failures(results: DataFrame, plan: DataFrame) -> DataFrame:
    rejected = plan.where(~F.col("done") & F.col("error").isNotNull())
    rejected = rejected.withColumn("error_category", classify_error(F.col("error")))
    return results.where(F.col("error").isNotNull()).select(*FAILURE).unionByName(rejected.select(*FAILURE))


def _metrics(store: PageStore, planned: dict, done: dict, missing: int, as_of: Column, run_id: str) -> DataFrame:
    """One row, from the figures of the passes that wrote the plan and the results; nothing is read again."""
    errors = planned["invalid"] + done["errors"] + missing
    share = lambda part, scale=1.0: part / planned["planned"] * scale if planned["planned"] else None
    values = {
        "run_id": run_id,
        "planned_count": planned["planned"],
        "added_count": planned["added"],
        "retry_count": planned["retried"],
        "valid_count": planned["planned"] - planned["invalid"],
        "invalid_count": planned["invalid"],
        "success_count": done["successes"],
        "error_count": errors,
        "conversion_error_count": done["errors"] + missing,
        "table_count": done["tables"],
        "image_count": done["images"],
        "null_content_count": done["null_contents"],
        "success_rate": share(done["successes"], 100.0),
        "error_rate": share(errors),
        "duplicate_count": planned["duplicates"],
        "succeeded_before_count": planned["succeeded_before"],
        "held_count": planned["held"],
        **{f"{state}_count": planned[state] for state in (DUE, WAITING, PERMANENT)},
    }
    kinds = {f.name: f.dataType for f in schemas.METRICS}
    row = store.spark.range(1).select(*[F.lit(v).cast(kinds[n]).alias(n) for n, v in values.items()], as_of.alias("as_of"))
    return conform_schema(row, schemas.METRICS)


class _Certain(Exception):
    """So many pages have failed that the breaker will trip whatever the others do."""


def _trip(store: PageStore, run_id: str, version: str, plan: DataFrame, planned: int, errors: int) -> None:
    """End an attempt whose failure is certain; what was written tells the categories."""
    store.give_up(run_id)
    results = empty(store.spark, schemas.CONVERTED)
    if store.progress(version).keys() - {PLANNED}:
        results = store.read("results", version, schemas.CONVERTED)
    _tripped(_failures(results, plan), f"{errors} of {planned} pages failed ({errors / planned:.1%})")


def _tripped(failures: DataFrame, what: str) -> None:
    top = ", ".join(f"{r.error_category}: {r.error_count}" for r in top_categories(failures).collect())
    raise BreakerTripped(f"{what}: {top}. Nothing was committed; the conversion service may be down.")


def _stop_if_tripped(store: PageStore, run_id: str, version: str, failures: DataFrame, settings: Settings) -> None:
    """End the attempt if nearly everything failed: the run's next start converts anew."""
    counts = store.read("metrics", version, schemas.METRICS).withColumn("processed_count", F.col("planned_count"))
    row = breaker_check(counts, settings).first()
    if row.tripped:
        store.give_up(run_id)
        _tripped(failures, f"{row.error_count} of {row.processed_count} pages failed ({row.error_rate:.1%})")
