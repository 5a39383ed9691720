"""The state of an incremental pipeline: a folder of parquet tables and a manifest.

Layout below the root::

    keys/run=V          slim keys of the pages that arrived with the run
    steps/<step>/run=V  intermediate tables of planning
    plan/run=V          what the run decided to do, by chunk
    results/run=V/...   converted pages of the run, one folder per chunk
    progress/run=V/...  chunks of the run that are complete
    ended/run=R/...     attempts of run R that were given up
    catalog/run=V       error catalog: the buckets that the run has changed
    catalog_map/run=V   where each bucket of the catalog is as of the run: untouched ones lie with the run that changed them last
    metrics/run=V       one row
    report/run=V        failures by category
    waiting/run=V       failures of the run with the time of their next attempt, for a stream of retries
    snapshot_keys/run=N, snapshot_successes/run=N   keys of all runs up to number N, for planning
    snapshots/run=all/... numbers of finished snapshots
    manifest/N.json     the run committed as number N, naming its version V

A run is tried in attempts; its version V is the run id and, from the second attempt on, the attempt's number.
A run counts from the moment its manifest file is there, which is the last thing it does. The file is named by the number that
follows the newest run the plan was made on, and is created only if there is none of that name: of several runs that were planned on one state,
one is committed. Readers take versions from the manifest, so an attempt that died or was given up leaves nothing
visible. A run that died and is started again under its id goes on with what its attempt has finished; one that lost to another
run plans anew and takes over the answers it has for pages that are still planned.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow import schemas
from pageflow.functions.keys import bucket_of
from pageflow.operators.payloads import page_keys
from pageflow.operators.tables import conform_schema, empty
from pageflow.sources.commits import create_new
from pageflow.sources.tables import read_or_empty

PROGRESS = schemas.schema("chunk int, last_ingest_id bigint, figures string")
VERSION = T.StructField("run", T.StringType())
# Parts of the catalog by record id, likewise.
CATALOG_BUCKETS = 256
# Parts of a snapshot; stored in its folders' names, so it can't be changed for a store.
SNAPSHOT_BUCKETS = 256
BUCKET = T.StructField("bucket", T.IntegerType())
TEMPORARY = ("plan", "progress", "steps/*")
PER_RUN = ("keys", "plan", "results", "progress", "catalog", "catalog_map", "metrics", "report", "waiting")
CATALOG_MAP = schemas.schema("bucket int, version string")
HISTORY = "history"


class CommitConflict(RuntimeError):
    """The state that a run was planned on is no longer the newest."""


@dataclass(frozen=True)
class Head:
    """The newest committed run, and all committed run ids and versions in order."""

    runs: tuple[str, ...] = ()
    versions: tuple[str, ...] = ()
    seq: int = -1
    last_ingest_id: int = -1
    catalog_version: str | None = None


class PageStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str, run_id: str | None = None) -> str:
        return f"{self.root}/{table}" + (f"/run={run_id}" if run_id is not None else "")

    # -- committed state ------------------------------------------------------------------------

    def head(self) -> Head:
        """One row per run is read to the driver."""
        try:
            rows = self.spark.read.schema(schemas.MANIFEST).json(self.path("manifest")).collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        if not rows:
            return Head()
        rows.sort(key=lambda r: r.seq)
        top = rows[-1]
        return Head(
            tuple(r.run_id for r in rows),
            tuple(r.catalog_version for r in rows),
            top.seq,
            max(r.last_ingest_id for r in rows),
            top.catalog_version,
        )

    def _committed(self, table: str, schema: T.StructType, head: Head) -> DataFrame:
        if not head.versions:
            return empty(self.spark, schema)
        return self._reader(schema).parquet(*[self.path(table, v) for v in head.versions])

    def successes(self, head: Head | None = None) -> DataFrame:
        """The success table: all pages converted by committed runs."""
        rows = self._committed("results", schemas.CONVERTED, head or self.head())
        return conform_schema(rows.where(F.col("error").isNull()), schemas.SUCCESS)

    def known_keys(self, head: Head, wanted: DataFrame | None = None) -> DataFrame:
        """Slim keys of every page seen by committed runs; of ``wanted`` records, if given."""
        of_runs = lambda h: self._committed("keys", schemas.PAGE_KEYS, h)
        return self._since_snapshot("snapshot_keys", schemas.PAGE_KEYS, "record_id", head, of_runs, wanted)

    def success_keys(self, head: Head, wanted: DataFrame | None = None) -> DataFrame:
        """Page keys of all successes, what planning needs of the success table; of ``wanted`` pages, if given."""
        of_runs = lambda h: self.successes(h).select("page_key")
        return self._since_snapshot("snapshot_successes", schemas.SUCCESS_KEYS, "page_key", head, of_runs, wanted)

    def _since_snapshot(
        self, table: str, schema: T.StructType, key: str, head: Head, of_runs: Callable[[Head], DataFrame], wanted: DataFrame | None
    ) -> DataFrame:
        """The newest snapshot and the runs after it, so that a scan names few paths however many runs there were.

        A snapshot lies in buckets by ``key``; those that no key of ``wanted`` is in are not read. Other rows may be left.
        """
        newest = self._newest_snapshot(head)
        if newest is None:
            return of_runs(head)
        later = replace(head, versions=head.versions[newest + 1 :])
        stored = self.spark.read.schema(T.StructType([*schema.fields, BUCKET])).parquet(self.path(table, str(newest)))
        if wanted is not None:
            hit = [r[0] for r in wanted.select(bucket_of(key, SNAPSHOT_BUCKETS)).distinct().collect() if r[0] is not None]
            if len(hit) < SNAPSHOT_BUCKETS:
                stored = stored.where(F.col("bucket").isin(hit))
        stored = stored.drop("bucket")
        return stored.unionByName(of_runs(later)) if later.versions else stored

    def _newest_snapshot(self, head: Head) -> int | None:
        return max((n for n in self._marks("snapshots", "all") if n <= head.seq), default=None)

    def take_snapshot(self, every: int = 1) -> None:
        """Fold the keys of all committed runs into one table each, if there are ``every`` runs since the last time."""
        head = self.head()
        newest = self._newest_snapshot(head)
        if head.seq >= 0 and head.seq - (-1 if newest is None else newest) >= every:
            for table, keys, key in (
                ("snapshot_keys", self.known_keys(head), "record_id"),
                ("snapshot_successes", self.success_keys(head).distinct(), "page_key"),
            ):
                bucketed = keys.withColumn("bucket", bucket_of(key, SNAPSHOT_BUCKETS))
                self.write(bucketed.repartition("bucket").sortWithinPartitions("bucket", key), table, str(head.seq), "bucket")
            self._mark("snapshots", "all", head.seq, 0)

    def clean_up(self) -> list[str]:
        """Delete what only a running or broken run needs: plans, steps and progress of committed runs, and every
        table of attempts that were never committed. Call it while no run is under way. Returns the folders.
        """
        committed = set(self.head().versions)
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        files = path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        gone = []
        for status in files.globStatus(path(f"{self.path('manifest')}/*.json")) or []:
            if status.getLen() == 0:  # its writer died before it had written
                files.delete(status.getPath(), False)
                gone.append(str(status.getPath()))
        for pattern in (*PER_RUN, "steps/*"):
            for status in files.globStatus(path(f"{self.root}/{pattern}/run=*")) or []:
                version = status.getPath().getName().removeprefix("run=")
                if version not in committed or pattern in TEMPORARY:
                    files.delete(status.getPath(), True)
                    gone.append(str(status.getPath()))
        return gone

    def catalog(self, head: Head | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The error catalog; only some of its ``buckets``, if given."""
        places = self._catalog_places(head or self.head())
        paths = [f"{self.path('catalog', version)}/bucket={b}" for b, version in places.items() if buckets is None or b in buckets]
        return self.spark.read.schema(schemas.CATALOG).parquet(*paths) if paths else empty(self.spark, schemas.CATALOG)

    def _catalog_places(self, head: Head) -> dict[int, str]:
        if head.catalog_version is None:
            return {}
        rows = self.spark.read.schema(CATALOG_MAP).parquet(self.path("catalog_map", head.catalog_version)).collect()
        return {r.bucket: r.version for r in rows}

    def write_catalog(self, rows: DataFrame, head: Head, version: str, buckets: list[int] | None = None) -> None:
        """Write ``rows`` as the catalog of ``version``: all of it, or what ``buckets`` hold now. The others stay where they are."""
        bucketed = conform_schema(rows, schemas.CATALOG).withColumn("bucket", bucket_of("record_id", CATALOG_BUCKETS))
        places = self._catalog_places(head) if buckets is not None else {}
        places = {b: v for b, v in places.items() if b not in buckets}
        if buckets is None or buckets:
            held = self.write_observed(bucketed.repartition("bucket"), "catalog", version, "bucket", bits=F.expr("bitmap_construct_agg(bucket)"))
            bits = held["bits"] or b""
            places |= {b: version for b in range(CATALOG_BUCKETS) if len(bits) > b // 8 and bits[b // 8] >> b % 8 & 1}
        self.write(self.spark.createDataFrame(sorted(places.items()), CATALOG_MAP).coalesce(1), "catalog_map", version)

    def metrics(self) -> DataFrame:
        return self._of_runs("metrics", schemas.METRICS)

    def report(self) -> DataFrame:
        """Failures by run and category."""
        return self._of_runs("report", schemas.REPORT)

    def _of_runs(self, table: str, schema: T.StructType) -> DataFrame:
        """Rows of committed versions; imported history has none."""
        versions = self.head().versions
        rows = read_or_empty(self.spark, T.StructType([*schema.fields, VERSION]), self.path(table))
        return rows.where(F.col("run").isin(*versions)).select(*schema.names) if versions else empty(self.spark, schema)

    # -- writing --------------------------------------------------------------------------------

    def write(self, df: DataFrame, table: str, run_id: str, *partition_by: str) -> None:
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(table, run_id))

    def write_observed(self, df: DataFrame, table: str, run_id: str, *partition_by: str, **figures: Column) -> dict:
        """Write, and return ``figures`` (aggregates) of what was written, from the same pass."""
        seen = Observation()
        self.write(df.observe(seen, *[figure.alias(name) for name, figure in figures.items()]), table, run_id, *partition_by)
        return seen.get

    def read(self, table: str, run_id: str, schema: T.StructType) -> DataFrame:
        return self._reader(schema).parquet(self.path(table, run_id))

    def plan(self, run_id: str) -> DataFrame:
        return self.spark.read.schema(schemas.PLAN).parquet(self.path("plan", run_id))

    def _reader(self, schema: T.StructType) -> DataFrameReader:
        """Chunk folders are not partitions."""
        return self.spark.read.schema(schema).option("recursiveFileLookup", True)

    def progress(self, version: str) -> dict[int, dict]:
        """Finished steps of an attempt that is not committed yet, with their figures; each has ``last_ingest_id``."""
        return self._marks("progress", version)

    def mark_finished(self, version: str, chunk: int, last_ingest_id: int, figures: dict | None = None) -> None:
        self._mark("progress", version, chunk, last_ingest_id, figures)

    def version(self, run_id: str) -> str:
        """The version that the run's current attempt writes."""
        given_up = len(self._marks("ended", run_id))
        return f"{run_id}~{given_up}" if given_up else run_id

    def give_up(self, run_id: str, answers_stand: bool = False) -> None:
        """End the current attempt: the run's next start plans anew.

        ``answers_stand``: only the plan is outdated, the pages were converted as they should.
        """
        self._mark("ended", run_id, len(self._marks("ended", run_id)), int(answers_stand))

    def standing_answers(self, run_id: str) -> DataFrame | None:
        """Results of the last attempt of ``run_id`` that ended although its answers stand, if there was one.

        It has taken over what earlier ones had for the pages of its plan.
        """
        stand = [n for n, ended in self._marks("ended", run_id).items() if ended["last_ingest_id"]]
        if not stand:
            return None
        newest = max(stand)
        return self.read("results", f"{run_id}~{newest}" if newest else run_id, schemas.CONVERTED)

    def _marks(self, table: str, name: str) -> dict[int, dict]:
        try:
            rows = self._reader(PROGRESS).parquet(self.path(table, name)).distinct().collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {r.chunk: {"last_ingest_id": r.last_ingest_id, **json.loads(r.figures)} for r in rows}

    def _mark(self, table: str, name: str, chunk: int, last_ingest_id: int, figures: dict | None = None) -> None:
        """A folder of its own for each mark, so that several can be written at once."""
        row = self.spark.range(1).select(
            F.lit(chunk).alias("chunk"),
            F.lit(last_ingest_id).cast("long").alias("last_ingest_id"),
            F.lit(json.dumps(figures or {})).alias("figures"),
        )
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path(table, name)}/mark_{chunk}")

    def commit(self, run_id: str, version: str, head: Head, last_ingest_id: int, as_of: Column) -> None:
        """Make a run visible as the one that follows ``head``, unless another one was committed there."""
        entry = {
            "run_id": run_id,
            "seq": head.seq + 1,
            "last_ingest_id": max(last_ingest_id, head.last_ingest_id),
            "catalog_version": version,
            "as_of": self.spark.range(1).select(F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")).first()[0],
        }
        if not create_new(self.spark, self._entry(head.seq + 1), json.dumps(entry)):
            self.give_up(run_id, answers_stand=True)
            raise CommitConflict(
                f"another run was committed while {run_id} ran, as number {head.seq + 1}; start it again, it plans anew"
            )

    def _entry(self, seq: int) -> str:
        return f"{self.path('manifest')}/{seq:012d}.json"

    def import_history(
        self,
        previous: DataFrame,
        successes: DataFrame,
        catalog: DataFrame,
        last_ingest_id: int,
        as_of: Column,
    ) -> None:
        """Take over the state of a pipeline that ran elsewhere, as a first committed run.

        Previous pages are hashed here once; later runs read their keys.
        """
        head = self.head()
        if HISTORY in head.runs:
            return
        self.write(page_keys(previous), "keys", HISTORY)
        self.write(conform_schema(successes, schemas.CONVERTED), "results", HISTORY)
        self.write_catalog(catalog, head, HISTORY)
        self.commit(HISTORY, HISTORY, head, last_ingest_id, as_of)
