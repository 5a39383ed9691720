"""Micro-batches against one batch, and across a restart."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle

from helpers import at, catalog_rows, flags, page, service, write_pages
from pageflow import schemas
from pageflow.plans.incremental import run_batch
from pageflow.sources.store import PageStore
from pageflow.sources.tables import PageFolder
from pageflow.streaming.micro_batch import run_due_retries, stream_pages
from pageflow.streaming.retries import stream_retries, waker

ROWS = [page(f"p{i}", "fail" if i % 5 == 0 else f"text {i}") for i in range(12)]
ROWS += [page("p1", "text 1"), page("p2", "other text")]


def arriving(spark, folder, rows, files):
    spark.createDataFrame([r[:-1] for r in rows], schemas.PAGE).repartition(files, "page_key").write.mode("append").parquet(folder)


def stream(store, folder, converter, when="2024-01-01 10:00:00", per_batch=1, name="pages"):
    q = stream_pages(store, folder, flags(store.spark), converter, lambda: at(when), files_per_batch=per_batch, name=name)
    q.awaitTermination()


def successes(store):
    return sorted((r.page_key, r.markdown, r.word_count) for r in store.successes().collect())


def test_stream_equals_batch_and_restarts_where_it_stopped(spark, tmp_path):
    folder = f"{tmp_path}/in"
    arriving(spark, folder, ROWS, 3)
    streamed = PageStore(spark, f"{tmp_path}/stream")
    converter, calls = service(spark)
    stream(streamed, folder, converter)
    batches = len(streamed.head().runs)
    assert batches >= 2 and calls.value == 12

    batch = PageStore(spark, f"{tmp_path}/batch")
    pages = write_pages(spark, f"{tmp_path}/pages", *ROWS)
    run_batch(batch, pages, pages, flags(spark), service(spark)[0], at("2024-01-01 10:00:00"), "r1")
    assert successes(streamed) == successes(batch)
    assert catalog_rows(streamed) == catalog_rows(batch)

    # Again over the same folder: old files are not seen again. A new file makes one more batch.
    stream(streamed, folder, converter)
    assert len(streamed.head().runs) == batches and calls.value == 12
    arriving(spark, folder, [page("q", "new")], 1)
    stream(streamed, folder, converter)
    assert len(streamed.head().runs) == batches + 1 and calls.value == 13

    # Due retries need a run of their own when no file arrives.
    from pageflow.sources.tables import read_pages

    better, more = service(spark, recover=True)
    run_due_retries(streamed, read_pages(spark, folder, schemas.PAGE), flags(spark), better, at("2024-01-01 11:00:00"), "retry-1")
    assert more.value == 3 and catalog_rows(streamed) == []
    assert len(successes(streamed)) == 13


def test_batch_that_dies_is_replayed_and_counted_once(spark, tmp_path, monkeypatch):
    folder = f"{tmp_path}/in"
    arriving(spark, folder, ROWS, 1)
    store = PageStore(spark, f"{tmp_path}/store")
    converter, calls = service(spark)
    commit = PageStore.commit

    def die(self, *args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(PageStore, "commit", die)
    with pytest.raises(Exception):
        stream(store, folder, converter)
    assert store.successes().isEmpty() and calls.value == 12
    monkeypatch.setattr(PageStore, "commit", commit)
    stream(store, folder, converter, "2024-01-01 10:05:00")
    # The staged answers are used: no page is sent twice.
    assert calls.value == 12 and len(successes(store)) == 9 and len(catalog_rows(store)) == 3


def test_stream_goes_on_after_a_tripped_breaker(spark, tmp_path):
    folder = f"{tmp_path}/in"
    arriving(spark, folder, [page(f"p{i}", f"fail {i}") for i in range(110)], 1)
    store = PageStore(spark, f"{tmp_path}/store")
    for _ in range(2):
        with pytest.raises(Exception, match="110 of 110"):
            stream(store, folder, service(spark)[0])
    healthy, calls = service(spark, recover=True)
    stream(store, folder, healthy)
    assert len(successes(store)) == calls.value == 110


def test_renewed_checkpoint_and_second_folder_lose_nothing(spark, tmp_path):
    store = PageStore(spark, f"{tmp_path}/store")
    arriving(spark, f"{tmp_path}/one", [page("a")], 1)
    stream(store, f"{tmp_path}/one", service(spark)[0])
    (tmp_path / "store/stream/pages").rename(tmp_path / "old-checkpoint")
    arriving(spark, f"{tmp_path}/two", [page("b")], 1)
    stream(store, f"{tmp_path}/two", service(spark)[0])
    arriving(spark, f"{tmp_path}/three", [page("c")], 1)
    stream(store, f"{tmp_path}/three", service(spark)[0], name="third")
    assert [r[0] for r in successes(store)] == ["a", "b", "c"]


def test_streams_do_not_take_the_ingest_mark_back(spark, tmp_path):
    store = PageStore(spark, f"{tmp_path}/store")
    pages = write_pages(spark, f"{tmp_path}/pages", page("a", ingest=7))
    run_batch(store, pages, pages, flags(spark), service(spark)[0], at("2024-01-01 10:00:00"), "r1", 7)
    arriving(spark, f"{tmp_path}/in", [page("b")], 1)
    stream(store, f"{tmp_path}/in", service(spark)[0])
    assert store.head().last_ingest_id == 7 and len(successes(store)) == 2


def test_failed_pages_are_sent_again_by_the_clock(spark, tmp_path):
    """No file arrives: a page is tried again after 2 and 4 minutes, and then no more."""
    store = PageStore(spark, f"{tmp_path}/store")
    pages = write_pages(spark, f"{tmp_path}/pages", page("a", "fail a"), page("b"), page("c", None))
    converter, calls = service(spark)
    run_batch(store, pages, pages, flags(spark), converter, at("2024-01-01 10:00:00"), "r1", 1)
    assert calls.value == 2
    ticks = str(tmp_path / "clock")

    def tick(now):
        spark.range(1).select(at(now).alias("at")).write.mode("append").parquet(ticks)
        clock = spark.readStream.schema("at timestamp").parquet(ticks)
        stream = stream_retries(store, pages, flags(spark), converter, lambda: at(now), clock, availableNow=True)
        stream.awaitTermination()
        return calls.value

    sent = [tick(f"2024-01-01 10:{t}") for t in ("01:00", "02:30", "04:00", "06:45", "30:00")]
    assert sent == [2, 3, 3, 4, 4]
    assert [(r[0], r[1]) for r in catalog_rows(store)] == [("doc-a::1", 3), ("doc-c::1", 1)]


def test_retries_that_all_fail_again_are_committed(spark, tmp_path):
    """Enough of them for the breaker, which would stop the same pages again at each start."""
    store = PageStore(spark, f"{tmp_path}/store")
    pages = write_pages(spark, f"{tmp_path}/pages", *[page(f"p{i}", "fail" if i < 110 else "ok") for i in range(130)])
    converter, calls = service(spark)
    run_batch(store, pages, pages, flags(spark), converter, at("2024-01-01 10:00:00"), "r1", 1)
    run_due_retries(store, pages, flags(spark), converter, at("2024-01-01 10:30:00"), "r2")
    assert calls.value == 240 and {(r[1], r[2]) for r in catalog_rows(store)} == {(2, "SERVER_ERROR")}


def test_the_timers_need_no_package_where_they_run(tmp_path):
    (tmp_path / "waker").write_bytes(cloudpickle.dumps(waker()))
    code = "import pickle; pickle.load(open('waker', 'rb')).close()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)


def test_a_micro_batch_opens_its_own_files_only(spark, tmp_path, monkeypatch):
    """The folder is not listed again for each micro-batch, retries of earlier files included."""
    store, folder = PageStore(spark, f"{tmp_path}/store"), f"{tmp_path}/pages"
    opened = []
    of = PageFolder.of
    monkeypatch.setattr(PageFolder, "of", lambda self, files: opened.append(len(files)) or of(self, files))
    monkeypatch.setattr(PageFolder, "all", None)
    arriving(spark, folder, ROWS[:6], 3)
    stream(store, folder, service(spark)[0], per_batch=1)
    assert opened and max(opened) == 1
    arriving(spark, folder, [page("late")], 1)
    opened.clear()
    stream(store, folder, service(spark, recover=True)[0], "2024-01-01 12:00:00", per_batch=5)
    # The new file, and those of the pages that are due again.
    assert sum(opened) <= 3 and {k for k, *_ in successes(store)} == {f"p{i}" for i in range(6)} | {"late"}
