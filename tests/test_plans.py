"""Shapes of physical plans that matter at scale."""

from __future__ import annotations

import json
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from helpers import at, flags, page, service, write_pages
from pageflow import queries, schemas
from pageflow.functions.responses import parse_responses
from pageflow.operators import payloads, tables
from pageflow.operators.convert import recorded_converter
from pageflow.operators.dedup import keep_one_per_key
from pageflow.operators.joins import heavy_keys, lookup, probe_in_place
from pageflow.plans import incremental, planner
from pageflow.plans.chunks import chunk_numbers, fetch, with_chunks, with_slices
from pageflow.plans.one_shot import one_shot_run
from pageflow.settings import DEFAULTS, Settings
from pageflow.sources import testdata as td
from pageflow.sources.store import PageStore
from pageflow.sources.tables import read_pages

PAYLOADS = ("page_payload", "page_image", "payload")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan: str) -> list[str]:
    """Shuffles, not broadcasts."""
    return [line for line in plan.splitlines() if re.search(r"\bExchange (hash|range|round|Single)", line)]


@contextmanager
def jobs_of(spark):
    """How many jobs were started inside."""
    context, group = spark.sparkContext, "jobs-of"
    context.setJobGroup(group, "")
    found = len(context.statusTracker().getJobIdsForGroup(group))
    yield lambda: len(context.statusTracker().getJobIdsForGroup(group)) - found
    context.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pages"))
    return write_pages(spark, folder, *[page(f"p{i}", f"text {i}") for i in range(40)], files=4)


def test_keys_are_computed_in_the_scan(pages):
    plan = physical(payloads.page_keys(pages))
    assert not exchanges(plan) and "Python" not in plan
    assert "doc_path" not in plan.split("ReadSchema")[1]


def test_slim_plans_read_no_payload(pages):
    slim = physical(pages.select("doc_id", "row_file", "row_index"))
    assert not any(p in slim.split("ReadSchema")[1] for p in PAYLOADS)


def test_dedup_folds_copies_before_the_shuffle(pages):
    plan = physical(keep_one_per_key(payloads.page_keys(pages), "page_key", planner.ORDER))
    assert len(exchanges(plan)) == 1
    assert "partial_min" in plan.split("Exchange")[1]


def test_large_table_is_probed_not_shuffled(spark, pages):
    """With few wanted keys the success table streams past a broadcast of them."""
    success = spark.range(1_000_000).select(F.concat(F.lit("p"), "id").alias("page_key"))
    hits = planner.succeeded(success, payloads.page_keys(pages))
    plan = physical(hits)
    assert re.search(r"BroadcastHashJoin \[page_key#\d+\], \[page_key#\d+\], LeftSemi, BuildRight", plan)


def test_converting_a_chunk_moves_no_payload_and_calls_python_once(spark, pages):
    part = pages.select("row_file", "row_index").limit(30).withColumns({"attempt_count": F.lit(0), "use_image": F.lit(False)})
    stored = spark.createDataFrame(part.collect(), part.schema)
    results = incremental._results(fetch(pages, stored), service(spark)[0], at("2024-01-01 10:00:00"), DEFAULTS)
    plan = physical(results)
    assert "BroadcastHashJoin" in plan and not exchanges(plan)
    assert len(re.findall(r"(?:ArrowEvalPython|MapInPandas|BatchEvalPython)\b", plan)) == 1
    # Only the three arguments of the call go to Python.
    call = re.search(r"ArrowEvalPython \[answers\(([^)]*)\)", plan).group(1)
    assert [a.split("#")[0].strip() for a in call.split(",")] == ["payload", "page_number", "mode"]


def test_scan_opens_only_the_chunks_files(spark, pages):
    files = [r.row_file for r in pages.select("row_file").distinct().collect()]
    assert len(files) == 4
    part = pages.where(F.col("row_file") == files[0]).select("row_file", "row_index")
    wide = fetch(pages, part)
    assert wide.count() == part.count()
    scans = [s for s in physical(wide).split("FileScan")[1:] if "page_payload" in s]
    assert len(scans) == 1 and files[0] in scans[0] and "file_path" in scans[0].split("DataFilters")[1]
    assert {r.row_file for r in wide.select("row_file").distinct().collect()} == {files[0]}


def test_chunks_are_packed_by_counted_size(spark):
    """More files than any limit: whole files, bounded chunks, and a scan that is always narrowed."""
    limits = Settings(chunk_rows=100, chunk_files=10)
    sizes = [3] * 45 + [70, 70, 70] + [250]
    rows = [(f"f{n:03d}", i) for n, size in enumerate(sizes) for i in range(size)]
    df = with_chunks(spark.createDataFrame(rows, "row_file string, row_index long"), len(rows), limits)
    per_chunk, chunks_of = {}, {}
    for r in df.collect():
        per_chunk.setdefault(r.chunk, []).append(r.row_file)
        chunks_of.setdefault((r.row_file, r.row_index // 100), set()).add(r.chunk)
    assert sum(map(len, per_chunk.values())) == len(rows)
    assert all(len(c) == 1 for c in chunks_of.values())
    assert all(len(files) < 200 and len(set(files)) <= 20 for files in per_chunk.values())


def test_no_fetch_shuffles_a_payload(spark, pages):
    """With broadcasts by size off and more files than the limit."""
    limits = Settings(chunk_rows=8, chunk_files=2)
    plan = with_chunks(pages.select("row_file", "row_index"), 40, limits)
    numbers = chunk_numbers(plan)
    assert len(numbers) > 1
    stored = spark.createDataFrame(plan.collect(), plan.schema)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = [fetch(pages, stored.where(F.col("chunk") == n).drop("chunk")) for n in numbers]
        assert sum(p.count() for p in parts) == 40
        for p in parts:
            plan = physical(p)
            assert not exchanges(plan) and "file_path" in plan.split("DataFilters")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_pages_of_one_file_are_dealt_to_many_tasks(spark, tmp_path):
    """50,000 tiny pages in one file: no task converts more than its share, and no payload is shuffled."""
    rows = spark.range(50_000).select(
        F.concat(F.lit("p"), "id").alias("page_key"), F.lit("d").alias("doc_id"), F.lit(1).alias("page_number"), F.lit("x" * 201).alias("page_payload")
    )
    tables.conform_schema(rows, schemas.PAGE).coalesce(1).write.parquet(str(tmp_path / "pages"))
    pages = read_pages(spark, str(tmp_path / "pages"), schemas.PAGE)
    limits = Settings(task_calls=5_000)
    slim = pages.select("row_file", "row_index")
    plan = with_slices(with_chunks(slim, 50_000, limits), 50_000, F.lit(200), limits)
    plan.write.parquet(str(tmp_path / "plan"))
    part = spark.read.parquet(str(tmp_path / "plan")).drop("chunk").withColumn("use_image", F.lit(False))
    wide = fetch(pages, part)
    assert not exchanges(physical(wide))
    per_task = [r["count"] for r in wide.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 50_000 and len(per_task) >= 8 and max(per_task) <= 5_000


def test_large_pages_are_read_once(spark):
    """Where a scan makes tasks enough by bytes, there is one slice."""
    limits = Settings(task_calls=10, task_bytes=1000)
    rows = spark.createDataFrame([("f", i, 0) for i in range(500)], "row_file string, row_index long, chunk int")
    assert [r["slice"] for r in with_slices(rows, 500, F.lit(100), limits).select("slice").distinct().collect()] == [0]
    sizes = with_slices(rows, 500, F.lit(25), limits).groupBy("slice").count().collect()
    assert len(sizes) == 4 and sum(r["count"] for r in sizes) == 500


def test_hot_keys_are_spread_when_a_lookup_shuffles(spark):
    """With broadcasts off: a key with a third of all rows reaches many tasks, and only partial results do."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = spark.range(48_000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
        entries = spark.range(-1, 1000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
        joined = lookup(rows, entries, ["k"], ["id"], heavy=heavy_keys(rows, ["k"]))
        sizes = joined.where("k = -1").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in sizes) == 16_000
        assert len(sizes) >= 8 and max(r["count"] for r in sizes) <= 16_000 / 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_only_heavy_keys_have_copies_of_their_entries(spark):
    rows = spark.range(10_000).select("id", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"))
    entries = spark.range(200).toDF("k").withColumn("v", F.lit(1))
    heavy = heavy_keys(rows, ["k"])
    assert heavy == [r[0] for r in spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).collect()]
    plan = physical(lookup(rows, entries, ["k"], ["id"], heavy=heavy))
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert "BroadcastHashJoin" in physical(lookup(rows, entries, ["k"], entry_rows=200))
    # Nothing is known: Spark picks the join, and no job runs before it.
    with jobs_of(spark) as jobs:
        lookup(rows, entries, ["k"])
    assert jobs() == 0


def test_wide_rows_are_joined_where_they_are_read(spark, pages):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        entries = spark.range(30).select(F.concat(F.lit("doc-p"), "id").alias("doc_id"), F.lit(True).alias("f"))
        want = sorted((r.page_key, r.f) for r in pages.join(entries, "doc_id", "left").select("page_key", "f").collect())
        for parts in (1, 3):
            joined = probe_in_place(pages, entries, ["doc_id"], "left", parts)
            assert not exchanges(physical(joined))
            assert sorted((r.page_key, r.f) for r in joined.select("page_key", "f").collect()) == want
        recorded = spark.createDataFrame([(f"p{i}", 200, "{}") for i in range(40)], schemas.RESPONSES)
        sent = pages.withColumns({"payload": F.col("page_payload"), "mode": F.lit("Page")})
        for answers in (recorded, recorded.where("false")):
            wide = [line for line in physical(recorded_converter(answers)(sent)).splitlines() if re.search(r"Exchange (hash|range|Single)", line)]
            assert all("payload" not in line for line in wide)
            assert recorded_converter(answers)(sent).count() == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("whole", [True, False])
def test_recorded_answers_are_read_once_for_all_chunks(spark, tmp_path, whole):
    stored = write_pages(spark, f"{tmp_path}/pages", *[page(f"p{i}") for i in range(12)], files=4)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    # The last page has no answer; one answer is of no page.
    rows = [(f"p{i}", 200, json.dumps({"value": f"text {i}"})) for i in range(13) if i != 11]
    converter = recorded_converter(spark.createDataFrame(rows, schemas.RESPONSES).mapInPandas(counted, schemas.RESPONSES))
    limits = Settings(chunk_rows=10, chunk_files=1)
    if whole:
        done = one_shot_run(stored, flags(spark), converter, at("2024-01-01 10:00:00"), f"{tmp_path}/out", "r", limits)
        failed = {r.page_key for r in done.where("error is not null").collect()}
        done = done.where("error is null")
    else:
        store = PageStore(spark, f"{tmp_path}/out")
        incremental.run_batch(store, stored, stored, flags(spark), converter, at("2024-01-01 10:00:00"), "r", 1, limits)
        failed, done = {r.page_key for r in store.catalog().collect()}, store.successes()
    assert {(r.page_key, r.markdown) for r in done.collect()} == {(f"p{i}", f"text {i}") for i in range(11)}
    assert failed == {"p11"} and read.value == len(rows)


def test_filter_on_the_outcome_does_not_parse_twice(spark):
    df = spark.createDataFrame([(200, '{"value": "x"}', "Page")], "status_code int, body string, mode string")
    plan = physical(parse_responses(df).where("error is null"))
    below = plan.split("Generate inline")[1]
    assert "isnull(error" in plan.split("Generate inline")[0]
    # Once as it is, and once mended where that is not JSON.
    assert len(re.findall(r"parseJson\(concat\(\[, body", below)) == 1 and below.count("regexp_replace(body") == 1


def test_flags_without_a_set_flag_are_not_looked_up(spark, pages):
    plan = payloads.attach_flags(pages, flags(spark, "doc-p1"), ["page_key"])
    assert {r.page_key for r in plan.where("use_image").collect()} == {"p1"}
    none = spark.createDataFrame([("doc-p1", False), ("doc-p2", None)], schemas.FLAGS)
    assert payloads.attach_flags(pages, none, ["page_key"]).where("use_image").isEmpty()


def test_fixture_scalars_stay_in_the_jvm(spark):
    sf = "/root/testdata/sf0.001"
    for df in (td.messages(spark, sf), td.markdown_docs(spark, sf)):
        assert "Python" not in physical(df)


@pytest.mark.parametrize("name", ["one_shot", "one_shot_chunked", "run_metrics", "breaker_check"])
def test_a_scan_of_some_pages_counts_no_turns(spark, monkeypatch, name):
    """The number of a document's pages is stored with them: a chunk neither counts nor broadcasts those of all documents."""
    sf, given = "/root/testdata/sf0.001", []

    class Stop(Exception):
        pass

    def run(pages, *_):
        given.append(pages)
        raise Stop

    monkeypatch.setattr(queries, "one_shot_run", run)
    with pytest.raises(Stop):
        queries.QUERIES[name](spark, sf)
    plan = physical(given[0].where(F.col("row_file") == "none"))
    assert "Aggregate" not in plan and "Exchange" not in plan
    want = td.page_batch(spark, sf).drop("row_file", "row_index")
    got = given[0].drop("row_file", "row_index")
    assert got.dtypes == want.dtypes and not got.exceptAll(want).count() and not want.exceptAll(got).count()


def test_generated_code_is_small_enough_to_be_compiled(spark, pages):
    """The JVM interprets methods above 8000 bytes of code for good, however hot they are."""
    part = pages.select("row_file", "row_index").withColumns({"attempt_count": F.lit(0), "use_image": F.lit(False)})
    results = incremental._results(fetch(pages, part), service(spark)[0], at("2024-01-01 10:00:00"), DEFAULTS)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stages = debug.codegenStringSeq(results._jdf.queryExecution().executedPlan()).iterator()
        sizes = []
        while stages.hasNext():
            sizes.append(stages.next()._3().maxMethodCodeSize())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and 0 < max(sizes) < 8000
