"""Whole runs: retries over several runs, resuming, the breaker, and what the tables hold."""

from __future__ import annotations

import json
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from helpers import PAGES, at, catalog_rows, flags, page, payload, service, write_pages
from pageflow import schemas
from pageflow.operators import tables
from pageflow.operators.convert import MostByTask, python_converter
from pageflow.plans.chunks import fetch
from pageflow.plans.incremental import BreakerTripped, RepeatedSuccess, run_batch
from pageflow.plans.one_shot import PagesMissing, in_band, one_shot_run
from pageflow.settings import Settings
from pageflow.sources.commits import create_new
from pageflow.sources.store import CommitConflict, PageStore
from pageflow.sources.tables import added_pages, previous_pages, read_pages


def run(store, pages, ingest, converter, when, run_id, flag_docs=(), settings=Settings()):
    head = store.head()
    added = added_pages(pages, head.last_ingest_id)
    run_batch(store, added, pages, flags(store.spark, *flag_docs), converter, at(when), run_id, ingest, settings)
    return store.metrics().where(F.col("run_id") == run_id).first()


def test_four_runs_fail_wait_retry_exhaust(spark, tmp_path):
    store, folder = PageStore(spark, f"{tmp_path}/store"), f"{tmp_path}/pages"
    converter, calls = service(spark)
    pages = write_pages(spark, folder, page("a"), page("b", "fail b"), page("c", "x", image="pic"), page("d", None))

    m = run(store, pages, 1, converter, "2024-01-01 10:00:00", "r1", ["doc-c"])
    assert (m.planned_count, m.valid_count, m.invalid_count, m.success_count, m.error_count) == (4, 3, 1, 2, 2)
    assert calls.value == 3
    assert catalog_rows(store) == [
        ("doc-b::1", 1, "SERVER_ERROR", "2024-01-01 10:00:00"),
        ("doc-d::1", 1, "PERMANENT_INVALID_ENCODING", "2024-01-01 10:00:00"),
    ]
    rows = {r.page_key: r for r in store.successes().collect()}
    assert rows["a"].markdown == "Page 1: ok" and rows["c"].markdown == "Image 1: pic"
    assert rows["a"].ocr_score == 0.5 and rows["a"].word_count == 3 and rows["a"].page_payload is not None
    assert json.loads(rows["a"].stage_times) == {"split": "S", "markdown conversion completed": "2024-01-01T10:00:00"}
    assert store.successes().schema.names == schemas.SUCCESS.names

    # One minute later nothing is due; the waiting row stays in the catalog.
    m = run(store, pages, 1, converter, "2024-01-01 10:01:00", "r2")
    assert (m.planned_count, calls.value) == (0, 3)
    assert [r[1] for r in catalog_rows(store)] == [1, 1]

    m = run(store, pages, 1, converter, "2024-01-01 10:02:00", "r3")
    assert (m.planned_count, m.retry_count, m.error_count, calls.value) == (1, 1, 1, 4)
    assert catalog_rows(store)[0] == ("doc-b::1", 2, "SERVER_ERROR", "2024-01-01 10:02:00")

    m = run(store, pages, 1, converter, "2024-01-01 10:06:00", "r4")
    assert (m.retry_count, calls.value) == (1, 5)
    assert catalog_rows(store)[0][1] == 3

    # Attempts used up: never again, and not because it arrives again either.
    pages = write_pages(spark, folder, page("b", "fail b", ingest=2), page("e", ingest=2))
    m = run(store, pages, 2, converter, "2024-02-01 00:00:00", "r5")
    assert (m.planned_count, m.success_count, calls.value) == (1, 1, 6)
    assert sorted(r.page_key for r in store.successes().collect()) == ["a", "c", "e"]


def test_retry_that_recovers_leaves_the_catalog(spark, tmp_path):
    store = PageStore(spark, f"{tmp_path}/store")
    pages = write_pages(spark, f"{tmp_path}/pages", page("a", "fail a"), page("b", "raise b"), page("c", "crash c"))
    run(store, pages, 1, service(spark)[0], "2024-01-01 10:00:00", "r1")
    assert [(r[0], r[2]) for r in catalog_rows(store)] == [
        ("doc-a::1", "SERVER_ERROR"),
        ("doc-b::1", "NETWORK_ERROR"),
        ("doc-c::1", "UNKNOWN"),
    ]
    converter, calls = service(spark, recover=True, at_once=4)
    m = run(store, pages, 1, converter, "2024-01-01 11:00:00", "r2")
    assert (m.success_count, m.retry_count, calls.value) == (3, 3, 3)
    assert catalog_rows(store) == []
    # Nothing left to do.
    assert run(store, pages, 1, converter, "2024-01-02 11:00:00", "r3").planned_count == 0
    assert store.successes().count() == 3 and calls.value == 3


def test_new_content_replaces_the_failed_one(spark, tmp_path):
    store, folder = PageStore(spark, f"{tmp_path}/store"), f"{tmp_path}/pages"
    converter, calls = service(spark)
    run(store, write_pages(spark, folder, page("a", "fail a")), 1, converter, "2024-01-01 10:00:00", "r1")
    pages = write_pages(spark, folder, page("a", "ok now", ingest=2))
    m = run(store, pages, 2, converter, "2024-01-01 12:00:00", "r2")
    assert (m.added_count, m.retry_count, m.success_count, calls.value) == (1, 0, 1, 2)
    assert catalog_rows(store) == []


def test_committed_run_is_not_repeated(spark, tmp_path):
    store = PageStore(spark, f"{tmp_path}/store")
    pages = write_pages(spark, f"{tmp_path}/pages", page("a"), page("b", "fail"))
    converter, calls = service(spark)
    run(store, pages, 1, converter, "2024-01-01 10:00:00", "r1")
    run(store, pages, 1, converter, "2024-01-01 12:00:00", "r1")
    assert calls.value == 2 and store.metrics().count() == 1


def test_broken_run_resumes_with_what_is_finished(spark, tmp_path, monkeypatch):
    store = PageStore(spark, f"{tmp_path}/store")
    # One row per chunk block: every file is a chunk of its own.
    pages = write_pages(spark, f"{tmp_path}/pages", *[page(f"p{i}") for i in range(40)], files=8)
    small = Settings(chunk_rows=5, chunks_at_once=1)
    converter, calls = service(spark)
    marked = []
    original = PageStore.mark_finished

    def die_after_two_chunks(self, run_id, chunk, *rest):
        original(self, run_id, chunk, *rest)
        marked.append(chunk)
        if len([c for c in marked if c >= 0]) == 2:
            raise KeyboardInterrupt

    monkeypatch.setattr(PageStore, "mark_finished", die_after_two_chunks)
    with pytest.raises(KeyboardInterrupt):
        run(store, pages, 1, converter, "2024-01-01 10:00:00", "r1", settings=small)
    assert store.successes().isEmpty() and store.head().runs == ()
    before = calls.value
    assert 0 < before < 40
    monkeypatch.setattr(PageStore, "mark_finished", original)
    m = run(store, pages, 1, converter, "2024-01-01 11:00:00", "r1", settings=small)
    assert calls.value == 40 and m.success_count == 40
    assert store.successes().select("page_key").distinct().count() == store.successes().count() == 40
    assert store.head().last_ingest_id == 1


def test_chunks_do_not_change_the_result(spark, tmp_path):
    pages = write_pages(spark, f"{tmp_path}/pages", *[page(f"p{i}", "fail" if i % 4 == 0 else f"ok {i}") for i in range(60)], files=6)
    outcomes = []
    for name, limits in (("one", Settings()), ("many", Settings(chunk_rows=7)), ("wide", Settings(chunk_rows=7, chunk_files=1, chunks_at_once=1))):
        store = PageStore(spark, f"{tmp_path}/{name}")
        run(store, pages, 1, service(spark)[0], "2024-01-01 10:00:00", "r1", settings=limits)
        outcomes.append((sorted((r.page_key, r.markdown) for r in store.successes().collect()), catalog_rows(store)))
    assert outcomes[0] == outcomes[1] == outcomes[2]
    assert len(outcomes[0][0]) == 45 and len(outcomes[0][1]) == 15


def failing_once(spark, tmp_path):
    store, folder = PageStore(spark, f"{tmp_path}/store"), f"{tmp_path}/pages"
    pages = write_pages(spark, folder, page("a", "fail a"), page("b", "fail b"))
    run(store, pages, 1, service(spark)[0], "2024-01-01 10:00:00", "r1")
    return store, pages


def test_retries_are_found_again_in_a_rewritten_table(spark, tmp_path):
    store, pages = failing_once(spark, tmp_path)
    moved = f"{tmp_path}/compacted"
    pages.drop("row_file", "row_index").coalesce(1).write.parquet(moved)
    converter, calls = service(spark, recover=True)
    m = run(store, read_pages(spark, moved, PAGES), 1, converter, "2024-01-01 11:00:00", "r2")
    assert (m.planned_count, m.success_count, m.error_count, calls.value) == (2, 2, 0, 2)
    assert catalog_rows(store) == [] and store.successes().count() == 2


def test_pages_that_are_gone_stay_in_the_catalog(spark, tmp_path):
    store, pages = failing_once(spark, tmp_path)
    moved = f"{tmp_path}/partly"
    pages.where("page_key = 'a'").drop("row_file", "row_index").write.parquet(moved)
    m = run(store, read_pages(spark, moved, PAGES), 1, service(spark, recover=True)[0], "2024-01-01 11:00:00", "r2")
    assert (m.planned_count, m.success_count, m.error_count) == (2, 1, 1)
    assert [(r[0], r[1]) for r in catalog_rows(store)] == [("doc-b::1", 2)]


def test_a_reused_file_does_not_send_another_page(spark, tmp_path):
    store, pages = failing_once(spark, tmp_path)
    at_old_places = pages.withColumn("page_payload", F.lit(payload("another page")))
    converter, calls = service(spark, recover=True)
    m = run(store, at_old_places, 1, converter, "2024-01-01 11:00:00", "r2")
    assert (m.planned_count, m.success_count, m.error_count, calls.value) == (2, 0, 2, 0)


def test_waiting_page_survives_another_page_of_its_record(spark, tmp_path):
    store, folder = PageStore(spark, f"{tmp_path}/store"), f"{tmp_path}/pages"
    pages = write_pages(spark, folder, page("a", "fail a", doc="D", number=None))
    run(store, pages, 1, service(spark)[0], "2024-01-01 10:00:00", "r1")
    pages = write_pages(spark, folder, page("b", "b", ingest=2, doc="D", number=None))
    run(store, pages, 2, service(spark)[0], "2024-01-01 10:01:00", "r2")
    assert len(catalog_rows(store)) == 1
    run(store, pages, 2, service(spark, recover=True)[0], "2024-01-02 10:00:00", "r3")
    assert catalog_rows(store) == [] and sorted(r.page_key for r in store.successes().collect()) == ["a", "b"]


def test_pages_without_a_key_are_all_converted(spark, tmp_path):
    store = PageStore(spark, f"{tmp_path}/store")
    pages = write_pages(spark, f"{tmp_path}/pages", page(None, "x"), page(None, "y"), page(None, "fail z"))
    m = run(store, pages, 1, service(spark)[0], "2024-01-01 10:00:00", "r1")
    assert (m.planned_count, m.success_count, m.error_count) == (3, 2, 1)


def test_second_of_two_overlapping_runs_is_not_committed(spark, tmp_path, monkeypatch):
    store = PageStore(spark, f"{tmp_path}/store")
    pages = write_pages(spark, f"{tmp_path}/pages", page("a"), page("b"))
    commit, inner = PageStore.commit, []

    def overtaken(self, run_id, *rest):
        if run_id == "slow" and not inner:
            inner.append(run(PageStore(spark, store.root), pages, 1, service(spark)[0], "2024-01-01 10:00:00", "fast"))
        commit(self, run_id, *rest)

    monkeypatch.setattr(PageStore, "commit", overtaken)
    with pytest.raises(CommitConflict):
        run_batch(store, added_pages(pages, -1), pages, flags(spark), service(spark)[0], at("2024-01-01 10:00:00"), "slow", 1)
    assert store.head().runs == ("fast",) and store.successes().count() == 2
    # Started again it plans anew and finds nothing to do.
    run_batch(store, added_pages(pages, -1), pages, flags(spark), service(spark)[0], at("2024-01-01 10:00:00"), "slow", 1)
    assert store.head().runs == ("fast", "slow") and store.successes().count() == 2


def test_snapshots_stand_for_the_runs_before_them(spark, tmp_path):
    store, folder = PageStore(spark, f"{tmp_path}/store"), f"{tmp_path}/pages"
    pages = write_pages(spark, folder, page("a"), page("b", "fail b"))
    run(store, pages, 1, service(spark)[0], "2024-01-01 10:00:00", "r1")
    store.take_snapshot()
    before = store.head()
    store.take_snapshot()
    pages = write_pages(spark, folder, page("a", ingest=2), page("c", ingest=2))
    converter, calls = service(spark, recover=True)
    m = run(store, pages, 2, converter, "2024-01-01 11:00:00", "r2")
    assert (m.added_count, m.retry_count, m.success_count, calls.value) == (1, 1, 2, 2)
    assert [r.page_key for r in store.success_keys(before).collect()] == ["a"]
    assert sorted(r.page_key for r in store.success_keys(store.head()).collect()) == ["a", "b", "c"]
    assert store.known_keys(store.head()).count() == 4


def test_runs_take_snapshots_and_read_only_the_buckets_they_need(spark, tmp_path):
    store, folder = PageStore(spark, f"{tmp_path}/store"), f"{tmp_path}/pages"
    limits = Settings(snapshot_every=2)
    converter, calls = service(spark)
    pages = write_pages(spark, folder, *[page(f"p{i}") for i in range(300)], page("f", "fail f"))
    run(store, pages, 1, converter, "2024-01-01 10:00:00", "r1", settings=limits)
    assert store._newest_snapshot(store.head()) is None
    run(store, pages, 1, converter, "2024-01-01 10:00:30", "r2", settings=limits)
    assert store._newest_snapshot(store.head()) == 1
    wanted = spark.createDataFrame([("p7",), ("new",), (None,)], "page_key string")
    all_keys, few = store.success_keys(store.head()), store.success_keys(store.head(), wanted)
    count_files = lambda df: df.select(F.input_file_name()).distinct().count()
    assert count_files(few) <= 2 < count_files(all_keys) and few.where("page_key = 'p7'").count() == 1
    assert "PartitionFilters: [bucket" in few._jdf.queryExecution().executedPlan().toString()
    pages = write_pages(spark, folder, page("p7", ingest=2), page("new", ingest=2))
    m = run(store, pages, 2, service(spark, recover=True)[0], "2024-01-01 11:00:00", "r3", settings=limits)
    assert (m.added_count, m.succeeded_before_count, m.retry_count, m.success_count) == (1, 1, 1, 2)
    assert store.successes().count() == 302


def test_runs_write_only_the_parts_of_the_catalog_they_change(spark, tmp_path):
    store, folder = PageStore(spark, f"{tmp_path}/store"), f"{tmp_path}/pages"
    pages = write_pages(spark, folder, *[page(f"p{i}", "fail") for i in range(90)])
    run(store, pages, 1, service(spark)[0], "2024-01-01 10:00:00", "r1", settings=Settings(breaker_min_failures=1000))
    parts = lambda version: len(list((tmp_path / "store" / "catalog" / f"run={version}").glob("bucket=*")))
    assert parts("r1") > 50
    pages = write_pages(spark, folder, *[page(f"q{i}", "fail", ingest=2) for i in range(10)])
    run(store, pages, 2, service(spark)[0], "2024-01-01 10:01:00", "r2")
    assert 0 < parts("r2") <= 10 and store.catalog().count() == 100
    assert run(store, pages, 2, service(spark)[0], "2024-01-01 10:01:30", "r3").planned_count == 0
    assert parts("r3") == 0 and store.catalog().count() == 100
    store.clean_up()
    run(store, pages, 2, service(spark, recover=True)[0], "2024-01-01 12:00:00", "r4")
    assert store.catalog().count() == 0


def test_clean_up_keeps_what_is_committed(spark, tmp_path, monkeypatch):
    store = PageStore(spark, f"{tmp_path}/store")
    pages = write_pages(spark, f"{tmp_path}/pages", page("a"), page("b", "fail b"))
    run(store, pages, 1, service(spark)[0], "2024-01-01 10:00:00", "r1")

    def die(self, *args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(PageStore, "commit", die)
        with pytest.raises(KeyboardInterrupt):
            run(store, pages, 1, service(spark, recover=True)[0], "2024-01-01 11:00:00", "r2")
    gone = store.clean_up()
    assert any("results/run=r2" in g for g in gone) and not any("results/run=r1" in g for g in gone)
    assert store.successes().count() == 1 and store.metrics().count() == 1 and len(catalog_rows(store)) == 1
    assert run(store, pages, 1, service(spark, recover=True)[0], "2024-01-01 11:00:00", "r2").success_count == 1


def test_report_by_category(spark, tmp_path):
    store, _ = failing_once(spark, tmp_path)
    assert [tuple(r) for r in store.report().collect()] == [("r1", "SERVER_ERROR", 2, 1.0, 0, 0)]


def test_service_that_cannot_be_opened_fails_pages_not_tasks(spark, tmp_path):
    def closed():
        raise PermissionError("no credentials")

    store = PageStore(spark, f"{tmp_path}/store")
    pages = write_pages(spark, f"{tmp_path}/pages", page("a"), page("b"))
    m = run(store, pages, 1, python_converter(closed), "2024-01-01 10:00:00", "r1")
    assert (m.success_count, m.error_count) == (0, 2)
    assert {r.last_error for r in store.catalog().collect()} == {"ERROR: Service could not be opened - PermissionError: no credentials"}


def test_breaker_commits_nothing(spark, tmp_path):
    store = PageStore(spark, f"{tmp_path}/store")
    pages = write_pages(spark, f"{tmp_path}/pages", *[page(f"p{i}", "fail" if i < 95 else "ok" if i < 100 else None) for i in range(110)])
    with pytest.raises(BreakerTripped, match=r"105 of 110 .*SERVER_ERROR: 95, PERMANENT_INVALID_ENCODING: 10"):
        run(store, pages, 1, service(spark)[0], "2024-01-01 10:00:00", "r1")
    assert store.head().runs == () and store.catalog().isEmpty() and store.successes().isEmpty()
    # The next start of the run converts anew.
    m = run(store, pages, 1, service(spark, recover=True)[0], "2024-01-01 11:00:00", "r1")
    assert (m.success_count, m.error_count) == (100, 10)


def test_breaker_stops_chunks_in_flight(spark, tmp_path):
    """A dead service: as soon as so many pages have failed that the rest can't save the run, no more are sent."""
    store = PageStore(spark, f"{tmp_path}/store")
    pages = write_pages(spark, f"{tmp_path}/pages", *[page(f"p{i}", "fail") for i in range(400)], files=40)
    converter, calls = service(spark)
    limits = Settings(chunk_rows=10, chunks_at_once=1, breaker_rate=0.5)
    with pytest.raises(BreakerTripped, match=r"2\d\d of 400 pages failed .*: SERVER_ERROR: \d+"):
        run(store, pages, 1, converter, "2024-01-01 10:00:00", "r1", settings=limits)
    assert 200 <= calls.value < 300
    assert store.head().runs == () and store.successes().isEmpty()
    m = run(store, pages, 1, service(spark, recover=True)[0], "2024-01-01 11:00:00", "r1", settings=limits)
    assert m.success_count == 400


def test_a_task_that_is_repeated_counts_once():
    merge = MostByTask().addInPlace
    assert merge(merge({}, {(1, 0): 3}), {(1, 0): 2, (1, 1): 4}) == {(1, 0): 3, (1, 1): 4}


def test_planning_figures_of_a_run(spark, tmp_path):
    store, folder = PageStore(spark, f"{tmp_path}/store"), f"{tmp_path}/pages"
    pages = write_pages(spark, folder, page("a"), page("a", "other"), page("b", "fail b"), page("c", None), page("d", "fail d"))
    m = run(store, pages, 1, service(spark)[0], "2024-01-01 10:00:00", "r1")
    assert (m.duplicate_count, m.succeeded_before_count, m.held_count, m.due_count, m.waiting_count, m.permanent_count) == (1, 0, 0, 0, 0, 0)
    pages = write_pages(spark, folder, page("a", "again", ingest=2), page("b", "fail b", ingest=2), page("c", None, ingest=2), page("e", ingest=2))
    m = run(store, pages, 2, service(spark)[0], "2024-01-01 10:01:00", "r2")
    assert (m.duplicate_count, m.succeeded_before_count, m.held_count) == (0, 1, 2)
    assert (m.due_count, m.waiting_count, m.permanent_count) == (0, 2, 1)
    assert (m.planned_count, m.success_count, m.added_count) == (1, 1, 1)
    m = run(store, pages, 2, service(spark)[0], "2024-01-01 12:00:00", "r3")
    assert (m.planned_count, m.retry_count, m.due_count, m.waiting_count, m.permanent_count) == (2, 2, 2, 0, 1)


def test_first_run_without_pages(spark, tmp_path):
    store = PageStore(spark, f"{tmp_path}/store")
    pages = write_pages(spark, f"{tmp_path}/pages", page("a"))
    run_batch(store, pages.where("false"), pages, flags(spark), service(spark)[0], at("2024-01-01 10:00:00"), "r0")
    assert store.successes().isEmpty() and store.catalog().isEmpty() and store.metrics().count() == 1


def test_history_is_taken_over_once(spark, tmp_path):
    store = PageStore(spark, f"{tmp_path}/store")
    pages = write_pages(spark, f"{tmp_path}/pages", page("a"), page("b"), page("c", ingest=2), page("a", "again", ingest=2))
    done = spark.createDataFrame([("a",)], schemas.SUCCESS_KEYS)
    for _ in range(2):
        store.import_history(previous_pages(pages, 1), done, tables.empty(spark, schemas.CATALOG), 1, at("2024-01-01 09:00:00"))
    m = run(store, pages, 2, service(spark)[0], "2024-01-01 10:00:00", "r1")
    assert (m.planned_count, m.success_count) == (1, 1)
    assert store.head().runs == ("history", "r1")


def test_one_shot_in_one_pass_and_in_chunks(spark, tmp_path):
    pages = write_pages(
        spark, f"{tmp_path}/pages", page("a"), page("b", "fail"), page("c", "x", image="pic"), page("d", None), page("e", "x", doc="doc-c")
    )
    converter, calls = service(spark)
    def once(p, service=None, **limits):
        service = service or globals()["service"](spark)[0]
        return in_band(one_shot_run(p, flags(spark, "doc-c"), service, at("2024-01-01 10:00:00"), f"{tmp_path}/out", "r1", Settings(**limits)))

    lazy = once(pages, converter)
    rows = {r.page_key: r for r in lazy.collect()}
    assert calls.value == 3
    assert lazy.columns == schemas.SUCCESS.names
    assert {k: r.markdown for k, r in rows.items()} == {
        "a": "Page 1: ok",
        "b": "ERROR: Page API failed 503: down",
        "c": "Image 1: pic",
        "d": "ERROR: Invalid or missing encoding",
        "e": "ERROR: Invalid or missing encoding",
    }
    assert rows["a"].status == "markdown conversion completed" and rows["b"].status == "markdown conversion failed"
    assert rows["b"].page_payload is not None and rows["b"].word_count == 0
    assert sorted(map(str, once(pages, chunk_rows=2).collect())) == sorted(map(str, rows.values()))
    # The same folder again, with fewer chunks, fewer pages and none: nothing of an earlier run comes back.
    assert once(pages).count() == 5
    assert once(pages.where("page_key = 'a'")).count() == 1
    assert once(pages.where("false")).count() == 0


def test_a_batch_that_cannot_start_fails_as_a_whole(spark, tmp_path):
    pages = write_pages(spark, f"{tmp_path}/pages", page("a"), page("b", None))

    def no_token():
        raise PermissionError("authentication failed")

    converter, calls = service(spark)
    arguments = (pages, flags(spark), converter, at("2024-01-01 10:00:00"), f"{tmp_path}/out", "r1")
    done = in_band(one_shot_run(*arguments, ready=no_token))
    want = tables.fail_batch(pages, "authentication failed", at("2024-01-01 10:00:00"))
    assert sorted(map(str, done.collect())) == sorted(map(str, want.collect())) and calls.value == 0
    assert one_shot_run(*arguments, ready=lambda: "token").where("error is null").count() == 1


def test_a_converter_can_send_request_documents(spark, tmp_path):
    def open_service():
        def call(document, page_number, mode):
            sent = json.loads(document)["parameters"]
            return 200, json.dumps({"value": json.dumps({"content": f"{mode} {page_number} {sorted(sent)}"})})

        return call

    pages = write_pages(spark, f"{tmp_path}/pages", page("a"), page("b", None), page("c", "x", image="pic"))
    converter = python_converter(open_service, documents=True)
    done = one_shot_run(pages, flags(spark, "doc-c"), converter, at("2024-01-01 10:00:00"), f"{tmp_path}/out", "r1")
    got = {r.page_key: r.markdown for r in done.collect()}
    assert got["b"] is None and got["a"].startswith("Page 1 [") and got["c"].startswith("Image 1 [")
    assert "pdf_encoding" in got["a"] and "page_image_base64_encoding" in got["c"]


def test_one_shot_goes_on_after_a_break_and_misses_no_page(spark, tmp_path, monkeypatch):
    pages = write_pages(spark, f"{tmp_path}/pages", *[page(f"p{i}") for i in range(20)], files=4)
    converter, calls = service(spark)
    limits = Settings(chunk_rows=5, chunks_at_once=1)
    convert = lambda: one_shot_run(pages, flags(spark), converter, at("2024-01-01 10:00:00"), f"{tmp_path}/out", "r1", limits)
    original, marked = PageStore.mark_finished, []

    def die(self, version, chunk, *rest):
        original(self, version, chunk, *rest)
        marked.append(chunk)
        if len(marked) == 3:
            raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(PageStore, "mark_finished", die)
        with pytest.raises(KeyboardInterrupt):
            convert()
    assert 0 < calls.value < 20
    assert convert().select("page_key").distinct().count() == 20 and calls.value == 20
    # A file is replaced after the plan was made: nothing is lost silently, and the next start plans anew.
    shorter = pages.where("page_key <> 'p7'")
    with monkeypatch.context() as m:
        m.setattr("pageflow.plans.one_shot.fetch", lambda _, part: fetch(shorter, part))
        with pytest.raises(PagesMissing, match="1 pages"):
            convert()
    assert convert().count() == 20


def test_of_two_commits_on_one_state_one_is_made(spark, tmp_path):
    """Both runs have read the same head and are done; the store is entered by many threads at once."""
    store = PageStore(spark, f"{tmp_path}/store")
    head, start = store.head(), threading.Barrier(6)

    def commit(number):
        start.wait()
        try:
            PageStore(spark, store.root).commit(f"r{number}", f"r{number}", head, number, at("2024-01-01 10:00:00"))
        except CommitConflict:
            return None
        return f"r{number}"

    with ThreadPoolExecutor(6) as pool:
        won = [r for r in pool.map(commit, range(6)) if r]
    assert len(won) == 1 and store.head().runs == tuple(won) and store.head().seq == 0


def test_a_name_is_created_once_on_other_file_systems_too(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.once.link./t", f"file://{tmp_path}")
    path = "viewfs://once/t/manifest/7.json"
    assert [create_new(spark, path, text) for text in ("a", "b")] == [True, False]
    assert (tmp_path / "manifest" / "7.json").read_text() == "a"


def test_an_entry_that_was_never_written_blocks_until_clean_up(spark, tmp_path):
    store = PageStore(spark, f"{tmp_path}/store")
    (tmp_path / "store" / "manifest").mkdir(parents=True)
    (tmp_path / "store" / "manifest" / "000000000000.json").touch()
    assert store.head().seq == -1
    with pytest.raises(CommitConflict):
        store.commit("r1", "r1", store.head(), 1, at("2024-01-01 10:00:00"))
    assert len(store.clean_up()) == 1
    store.commit("r1", "r1", store.head(), 1, at("2024-01-01 10:00:00"))
    assert store.head().runs == ("r1",)


def test_a_run_that_lost_keeps_its_answers(spark, tmp_path, monkeypatch):
    store = PageStore(spark, f"{tmp_path}/store")
    pages = write_pages(spark, f"{tmp_path}/pages", page("a"), page("b"), page("c", "fail c"), page("d", ingest=2), files=3)
    converter, calls = service(spark)
    commit, inner = PageStore.commit, []

    def overtaken(self, run_id, *rest):
        if run_id == "slow" and not inner:
            other = PageStore(spark, store.root)
            inner.append(run_batch(other, pages.where("page_key = 'b'"), pages, flags(spark), service(spark)[0], at("2024-01-01 10:00:00"), "fast", 1))
        commit(self, run_id, *rest)

    monkeypatch.setattr(PageStore, "commit", overtaken)
    slow = lambda: run_batch(store, added_pages(pages, -1), pages, flags(spark), converter, at("2024-01-01 10:00:00"), "slow", 2)
    with pytest.raises(CommitConflict):
        slow()
    assert calls.value == 4
    slow()
    # b is done by the other run; nothing is sent a second time.
    assert calls.value == 4 and store.head().runs == ("fast", "slow")
    assert sorted(r.page_key for r in store.successes().collect()) == ["a", "b", "d"]
    assert [(r[0], r[1]) for r in catalog_rows(store)] == [("doc-c::1", 1)]


def test_no_run_repeats_a_success(spark, tmp_path, monkeypatch):
    """Should planning ever let a page through that has succeeded, the run is refused."""
    store, folder = PageStore(spark, f"{tmp_path}/store"), f"{tmp_path}/pages"
    pages = write_pages(spark, folder, page("a"), page("b", ingest=2))
    run(store, pages.where("page_key = 'a'"), 1, service(spark)[0], "2024-01-01 10:00:00", "r1")
    with monkeypatch.context() as m:
        m.setattr("pageflow.plans.planner.unseen_pages", lambda added, success: added)
        with pytest.raises(RepeatedSuccess, match="0 page keys are twice .*, 1 succeeded"):
            run_batch(store, pages, pages, flags(spark), service(spark)[0], at("2024-01-01 11:00:00"), "r2", 2)
    assert store.head().runs == ("r1",)
    run_batch(store, pages, pages, flags(spark), service(spark)[0], at("2024-01-01 11:00:00"), "r2", 2)
    assert sorted(r.page_key for r in store.successes().collect()) == ["a", "b"]


def test_pages_without_a_key_are_found_again(spark, tmp_path):
    store, folder = PageStore(spark, f"{tmp_path}/store"), f"{tmp_path}/pages"
    pages = write_pages(spark, folder, page(None, "fail x", doc="X"), page(None, "fail y", doc="X"), page("c", "fail c"))
    run(store, pages, 1, service(spark)[0], "2024-01-01 10:00:00", "r1")
    moved = f"{tmp_path}/compacted"
    pages.drop("row_file", "row_index").coalesce(1).write.parquet(moved)
    converter, calls = service(spark, recover=True)
    m = run(store, read_pages(spark, moved, PAGES), 1, converter, "2024-01-01 11:00:00", "r2")
    assert (m.planned_count, m.success_count, m.error_count, calls.value) == (3, 3, 0, 3)
    assert catalog_rows(store) == []


def test_failed_batch(spark, tmp_path):
    pages = write_pages(spark, f"{tmp_path}/pages", page("a"), page("b", None))
    out = tables.fail_batch(pages, "authentication failed", at("2024-01-01 10:00:00"))
    assert out.columns == schemas.SUCCESS.names
    assert {(r.markdown, r.status, r.stage_times, r.has_table, r.word_count, r.ocr_score) for r in out.collect()} == {
        ("ERROR: authentication failed", "authentication failed", '{"markdown conversion failed":"2024-01-01T10:00:00"}', False, 0, None)
    }


def test_existing_tables_keep_their_column_names(spark, tmp_path):
    from pageflow.sources.naming import from_legacy, to_legacy

    pages = write_pages(spark, f"{tmp_path}/pages", page("a"))
    theirs = to_legacy(pages)
    assert theirs.columns[:10] == [
        "primaryKey", "originalMediaItemRid", "originalPath", "originalMediaReference", "pageNumber",
        "totalPages", "pageBase64", "pageImageBase64", "status", "timestamp",
    ]
    assert from_legacy(theirs).columns == pages.columns
    done = one_shot_run(from_legacy(theirs), flags(spark), service(spark)[0], at("2024-01-01 10:00:00"), f"{tmp_path}/out", "r1")
    out = to_legacy(in_band(done))
    assert out.first().converted_markdown == "Page 1: ok" and len(out.columns) == 18
