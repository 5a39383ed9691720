"""Retries that wake by themselves: one timer for each failed content.

Every run leaves its failures, slim rows, in the store. A stream over them keeps a state for each content (in RocksDB):
the attempts so far and a timer at the end of the backoff. When timers expire, a run without new pages sends what is due;
its failures are the stream's next input, so no file has to arrive for a page to be tried again. A failure that is
not to be tried again has no timer. A timer whose page has been settled otherwise wakes a run that finds nothing to do for it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from pageflow import schemas
from pageflow.operators.catalog import KEY
from pageflow.operators.convert import Converter
from pageflow.operators.tables import conform_schema
from pageflow.settings import DEFAULTS, Settings
from pageflow.sources.store import PageStore
from pageflow.streaming.micro_batch import run_due_retries

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DUE = schemas.schema("record_id string, content_hash string, page_key string, attempt_count int")


def waker() -> StatefulProcessor:
    """A processor that keeps a content's last failure until it is due.

    Its class is local, so it travels by value: the process that Spark starts beside the driver for it does not have this package.
    """
    columns = DUE.names

    class Waker(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.waiting = handle.getValueState("waiting", "page_key string, attempt_count int")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            # Ticks of a clock have no key and nothing to wait for.
            failures = [f for part in rows for f in zip(part["at"], part["page_key"], part["attempt_count"], part["due_ms"])]
            if key[0] is not None and failures:
                _, page_key, attempts, due = max(failures, key=lambda f: (f[0], f[2]))
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                if pd.isna(due):
                    self.waiting.clear()
                else:
                    self.waiting.update((page_key, int(attempts)))
                    self.handle.registerTimer(int(due))
            return iter([])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            if self.waiting.exists():
                page_key, attempts = self.waiting.get()
                self.waiting.clear()
                yield pd.DataFrame([(key[0], key[1], page_key, attempts)], columns=columns)

        def close(self) -> None:
            pass

    return Waker()


def due_stream(store: PageStore, clock: DataFrame | None = None) -> DataFrame:
    """A stream of the failures whose backoff is over.

    Time is that of the cluster; or, with ``clock``, a stream with a column ``at``, the latest time that it has told.
    """
    reader = store.spark.readStream.schema(schemas.WAITING).option("recursiveFileLookup", True)
    rows = reader.parquet(store.path("waiting"))
    if clock is not None:
        rows = rows.unionByName(conform_schema(clock, schemas.WAITING)).withWatermark("at", "1 second")
    mode = "processingTime" if clock is None else "eventTime"
    # As a number, so that no time zone plays a part.
    rows = rows.withColumn("due_ms", F.unix_millis("due_at"))
    return rows.groupBy(*KEY).transformWithStateInPandas(waker(), DUE, "append", mode)


def stream_retries(
    store: PageStore,
    pages: DataFrame,
    flags: DataFrame,
    converter: Converter,
    as_of: Callable[[], Column],
    clock: DataFrame | None = None,
    settings: Settings = DEFAULTS,
    name: str = "retries",
    **trigger,
) -> StreamingQuery:
    """Start a query that sends failed pages again when their backoff is over; ``trigger`` as Spark's own.

    A micro-batch that is replayed keeps its run id, so it commits once. The state is in RocksDB for this query; the
    session's setting is left as it was.
    """
    spark = store.spark

    def on_batch(due: DataFrame, batch_id: int) -> None:
        # Counted, not looked into: all of the state has to be brought up to date, and once only.
        if due.count():
            checkpoint = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
            run_due_retries(store, pages, flags, converter, as_of(), f"{name}-{checkpoint}-{batch_id:08d}", settings)

    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        writer = due_stream(store, clock).writeStream.foreachBatch(on_batch)
        return writer.option("checkpointLocation", f"{store.path('stream')}/{name}").trigger(**trigger).start()
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)
