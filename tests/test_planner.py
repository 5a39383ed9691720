"""Planning on small cases, among them the ones where the simple rules would lose or repeat a page."""

from __future__ import annotations

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from pageflow import schemas
from pageflow.operators import catalog as C
from pageflow.operators import dedup, metrics, tables
from pageflow.operators.joins import heavy_keys, lookup
from pageflow.operators.payloads import rejection
from pageflow.plans import planner
from pageflow.settings import Settings

NOW = "2024-01-30 12:00:00"


def at(text=NOW):
    return F.lit(text).cast("timestamp")


def keys(spark, *rows):
    """Rows of (page_key, record_id, content_hash)."""
    full = [(k, "d", 1, r, h, 300, None, False, True, "f", i) for i, (k, r, h) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.PAGE_KEYS)


def success(spark, *page_keys):
    return spark.createDataFrame([(k,) for k in page_keys], schemas.SUCCESS_KEYS)


def catalog(spark, *rows):
    """Rows of (record_id, content_hash, attempts, category, last attempt[, page key])."""
    df = spark.createDataFrame(
        [(*r, None)[:6] for r in rows],
        "record_id string, content_hash string, attempt_count int, error_category string, last string, page_key string",
    )
    stamped = df.withColumn("last_attempt_at", F.col("last").cast("timestamp")).withColumn("last_error", F.lit("ERROR: x"))
    return tables.conform_schema(stamped, schemas.CATALOG)


def plan(spark, added, previous, done, errors):
    rows = planner.plan_work(keys(spark, *added), keys(spark, *previous), success(spark, *done), catalog(spark, *errors), at())
    return sorted((r.page_key, r.content_hash, r.origin, r.attempt_count, r.done) for r in rows.collect())


LONG_AGO = "2024-01-01 00:00:00"


def test_new_pages_only(spark):
    assert plan(spark, [("a", "r1", "h1"), ("b", "r2", "h2")], [], ["b"], []) == [("a", "h1", "added", 0, False)]


def test_duplicate_keys_keep_the_smallest_hash_and_pages_without_a_key_are_kept_by_content(spark):
    added = [("a", "r1", "h2"), ("a", "r1", "h1"), ("a", "r0", "h1"), *[(None, "r3", "h9")] * 2, (None, "r4", "h3"), (None, "r3", "h8")]
    work = planner.plan_work(keys(spark, *added), keys(spark), success(spark), catalog(spark), at()).collect()
    assert sorted((str(r.page_key), r.record_id, r.content_hash) for r in work) == [
        ("None", "r3", "h8"),
        ("None", "r3", "h9"),
        ("None", "r4", "h3"),
        ("a", "r0", "h1"),
    ]


def test_another_page_of_the_same_record_does_not_replace_a_retry(spark):
    """Pages of a document without page numbers share their record id."""
    planned = plan(spark, [("b", "d::-1", "h2")], [("a", "d::-1", "h1")], [], [("d::-1", "h1", 1, "TIMEOUT", LONG_AGO)])
    assert planned == [("a", "h1", "retry", 1, False), ("b", "h2", "added", 0, False)]


def test_due_retry_is_planned_with_its_attempts(spark):
    assert plan(spark, [], [("a", "r1", "h1")], [], [("r1", "h1", 1, "TIMEOUT", LONG_AGO)]) == [
        ("a", "h1", "retry", 1, False)
    ]


@pytest.mark.parametrize(
    "attempts, last, due",
    [
        (1, "2024-01-30 11:58:00", True),
        (1, "2024-01-30 11:58:01", False),
        (2, "2024-01-30 11:56:00", True),
        (2, "2024-01-30 11:56:01", False),
        (0, "2024-01-30 11:59:00", True),
        (2, None, True),
        (3, LONG_AGO, False),
    ],
)
def test_backoff(spark, attempts, last, due):
    planned = plan(spark, [], [("a", "r1", "h1")], [], [("r1", "h1", attempts, "TIMEOUT", last)])
    assert bool(planned) == due


@pytest.mark.parametrize("category", ["PERMANENT_INVALID_ENCODING", "PERMANENT_SIZE_LIMIT"])
def test_permanent_categories_are_not_retried(spark, category):
    assert plan(spark, [], [("a", "r1", "h1")], [], [("r1", "h1", 1, category, LONG_AGO)]) == []


def test_error_without_category_is_retried(spark):
    """Two opposite tests on a null category would both be unknown and lose the row."""
    errors = [("r1", "h1", 1, None, LONG_AGO)]
    split = catalog(spark, *errors)
    listed = F.col("error_category").isin("PERMANENT_INVALID_ENCODING", "PERMANENT_SIZE_LIMIT")
    assert split.where(listed | (F.col("attempt_count") >= 3)).count() == 0
    assert split.where(~listed & (F.col("attempt_count") < 3)).count() == 0
    assert plan(spark, [], [("a", "r1", "h1")], [], errors) == [("a", "h1", "retry", 1, False)]


def test_retry_that_has_succeeded_is_marked_done(spark):
    assert plan(spark, [], [("a", "r1", "h1")], ["a"], [("r1", "h1", 1, "TIMEOUT", LONG_AGO)]) == [
        ("a", "h1", "retry", 1, True)
    ]


def test_changed_content_of_a_previous_page_is_no_retry(spark):
    assert plan(spark, [], [("a", "r1", "h2")], [], [("r1", "h1", 1, "TIMEOUT", LONG_AGO)]) == []


def test_new_content_wins_over_a_retry_of_the_old(spark):
    """Dropping the new page by record id would leave it previous, without an error row, for good."""
    planned = plan(spark, [("a", "r1", "h2")], [("a", "r1", "h1")], [], [("r1", "h1", 1, "TIMEOUT", LONG_AGO)])
    assert planned == [("a", "h2", "added", 0, False)]


def test_same_content_is_tried_once_as_a_retry(spark):
    planned = plan(spark, [("a", "r1", "h1")], [("a", "r1", "h1")], [], [("r1", "h1", 2, "TIMEOUT", LONG_AGO)])
    assert planned == [("a", "h1", "retry", 2, False)]


@pytest.mark.parametrize(
    "error",
    [
        ("r1", "h1", 1, "PERMANENT_SIZE_LIMIT", LONG_AGO),
        ("r1", "h1", 3, "TIMEOUT", LONG_AGO),
        ("r1", "h1", 2, "TIMEOUT", "2024-01-30 11:59:00"),
    ],
)
def test_page_that_arrives_again_stays_out_while_given_up_or_waiting(spark, error):
    assert plan(spark, [("a", "r1", "h1")], [], [], [error]) == []


def test_page_that_arrives_again_keeps_its_attempts(spark):
    assert plan(spark, [("a", "r1", "h1")], [], [], [("r1", "h1", 2, "TIMEOUT", LONG_AGO)]) == [
        ("a", "h1", "added", 2, False)
    ]


def test_copies_of_a_previous_page_are_one_retry(spark):
    previous = [("a", "r1", "h1")] * 3 + [("b", "r1", "h1")]
    assert plan(spark, [], previous, [], [("r1", "h1", 1, "TIMEOUT", LONG_AGO)]) == [
        ("a", "h1", "retry", 1, False),
        ("b", "h1", "retry", 1, False),
    ]


def test_catalog_with_several_rows_per_content_does_not_multiply_retries(spark):
    errors = [("r1", "h1", 1, "TIMEOUT", LONG_AGO), ("r1", "h1", 2, "TIMEOUT", LONG_AGO)]
    assert plan(spark, [], [("a", "r1", "h1")], [], errors) == [("a", "h1", "retry", 2, False)]


def brute_force(added, previous, done, errors):
    """The same rules, page by page."""
    states = {}
    for r, h, n, c, due in errors:
        permanent = c.startswith("PERMANENT") or n >= 3
        states[r, h] = ("permanent" if permanent else "due" if due else "waiting", n)
    best = {}
    for k, r, h in added:
        best[k] = min(best.get(k, (h, r)), (h, r))
    fresh = {}
    for k, (h, r) in best.items():
        state, n = states.get((r, h), ("due", 0))
        if k not in done and state == "due":
            fresh[k] = (r, h, n)
    retries, finished = {}, set()
    for k, r, h in previous:
        if states.get((r, h), ("none", 0))[0] == "due":
            if k in done:
                finished.add((k, r, h))
            else:
                retries[k] = min(retries.get(k, (h, r)), (h, r))
    retries = {k: (h, r) for k, (h, r) in retries.items() if k not in fresh or fresh[k][:2] == (r, h)}
    work = {k: (h, "added", n) for k, (r, h, n) in fresh.items() if k not in retries}
    for k, (h, r) in retries.items():
        work.setdefault(k, (h, "retry", states[r, h][1]))
    return sorted([(k, h, o, n, False) for k, (h, o, n) in work.items()] + [(k, h, "retry", states[r, h][1], True) for k, r, h in finished])


@pytest.mark.parametrize("seed", range(6))
def test_plan_against_brute_force(spark, seed):
    """Dense random keys, so that every rule meets every other; page ``p0`` holds a third of the rows."""
    rng = random.Random(seed)

    def page():
        k = "p0" if rng.random() < 1 / 3 else f"p{rng.randrange(12)}"
        return k, f"r{rng.randrange(6)}", f"h{rng.randrange(3)}"

    added, previous = [page() for _ in range(40)], [page() for _ in range(60)]
    done = {f"p{rng.randrange(12)}" for _ in range(3)}
    errors, rows = [], []
    for r in range(6):
        for h in range(3):
            if rng.random() < 0.7:
                n, c, due = rng.randrange(4), rng.choice(["TIMEOUT", "UNKNOWN", "PERMANENT_SIZE_LIMIT"]), rng.random() < 0.7
                errors.append((f"r{r}", f"h{h}", n, c, due))
                rows.append((f"r{r}", f"h{h}", n, c, LONG_AGO if due else "2024-01-30 11:59:59"))
    assert plan(spark, added, previous, done, rows) == brute_force(added, previous, done, errors)


# -- the error catalog --------------------------------------------------------------------------


def merged(spark, old, settled=(), replaced=(), failed=()):
    failures = spark.createDataFrame(
        [(f"p-{f[0]}", *f) for f in failed],
        "page_key string, record_id string, content_hash string, attempt_count int, error string, error_category string",
    )
    pairs = lambda rows: spark.createDataFrame(
        [(f"p-{r[0]}", *r) if len(r) == 2 else r for r in rows], "page_key string, record_id string, content_hash string"
    )
    df = C.merge_catalog(catalog(spark, *old), pairs(settled), pairs(replaced), failures, at())
    return sorted((r.record_id, r.content_hash, r.attempt_count, r.error_category) for r in df.collect())


OLD = [
    ("r1", "h1", 1, "TIMEOUT", LONG_AGO, "p-r1"),
    ("r2", "h2", 3, "TIMEOUT", LONG_AGO, "p-r2"),
    ("r3", "h3", 2, "TIMEOUT", NOW, "p-r3"),
]


def test_untouched_rows_are_carried_over_waiting_ones_too(spark):
    assert merged(spark, OLD) == [("r1", "h1", 1, "TIMEOUT"), ("r2", "h2", 3, "TIMEOUT"), ("r3", "h3", 2, "TIMEOUT")]


def test_success_leaves_and_failure_counts_up(spark):
    after = merged(spark, OLD, [("r1", "h1"), ("r3", "h3")], failed=[("r3", "h3", 2, "ERROR: y", "SERVER_ERROR")])
    assert after == [("r2", "h2", 3, "TIMEOUT"), ("r3", "h3", 3, "SERVER_ERROR")]


def test_old_content_leaves_when_new_content_arrives(spark):
    assert merged(spark, OLD, replaced=[("r2", "h9"), ("r1", "h1")]) == [
        ("r1", "h1", 1, "TIMEOUT"),
        ("r3", "h3", 2, "TIMEOUT"),
    ]


def test_content_of_another_page_of_the_record_retires_nothing(spark):
    assert merged(spark, OLD, replaced=[("other", "r2", "h9")]) == merged(spark, OLD)


def test_failures_of_one_content_are_one_row(spark):
    failed = [("r9", "h9", 0, f"ERROR: {i}", "UNKNOWN") for i in range(5)] + [("r9", "h9", 1, "ERROR: z", None)]
    assert merged(spark, [], failed=failed) == [("r9", "h9", 2, "UNKNOWN")]


# -- smaller operators --------------------------------------------------------------------------


def test_lookup_equals_a_plain_join_when_one_key_holds_most_rows(spark):
    rows = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    rows = rows.unionByName(spark.range(5).select(F.col("id"), F.lit(None).cast("long").alias("k")))
    entries = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    ways = ({"entry_rows": 40}, {"heavy": heavy_keys(rows, ["k"])}, {})
    assert len(ways[1]["heavy"]) > 0
    for how, way in product(("left", "inner", "left_anti"), ways):
        got = lookup(rows, entries, ["k"], ["id"], how, **way)
        want = rows.join(entries, "k", how).select(got.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_conform_schema(spark):
    df = spark.createDataFrame([(1, "x")], "extra int, page_key string")
    out = tables.conform_schema(df, schemas.PAGE)
    assert out.columns == schemas.PAGE.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.PAGE]
    assert out.first().page_key == "x" and out.first().page_number is None


def test_typed_empty_table(spark):
    assert tables.empty(spark, schemas.CATALOG).schema == schemas.CATALOG
    assert tables.empty(spark, schemas.SUCCESS).isEmpty()


def test_key_audit_counts_null_as_one_key(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert tuple(dedup.key_audit(df, "k").first()) == (5, 3, 2)
    assert tuple(dedup.key_audit(df.where("k = 'none'"), "k").first()) == (0, 0, 0)


def test_keep_one_is_idempotent(spark):
    df = keys(spark, *[(f"p{i % 7}", f"r{i % 3}", f"h{i % 5}") for i in range(60)])
    once = dedup.keep_one_per_key(df, "page_key", planner.ORDER)
    assert sorted(once.collect()) == sorted(dedup.keep_one_per_key(once, "page_key", planner.ORDER).collect())
    assert once.columns == df.columns and once.count() == 7


@pytest.mark.parametrize(
    "length, blank, reason",
    [
        (None, True, "ERROR: Invalid or missing encoding"),
        (200, False, "ERROR: Invalid or missing encoding"),
        (201, False, None),
        (201, True, "ERROR: Empty or null encoding provided"),
        (1000, False, None),
        (1001, False, "ERROR: Encoding exceeds size limit"),
    ],
)
def test_rejection(spark, length, blank, reason):
    df = spark.createDataFrame([(length, blank)], "n int, b boolean")
    assert df.select(rejection(F.col("n"), F.col("b"), Settings(max_length=1000))).first()[0] == reason


@pytest.mark.parametrize(
    "rows, failures, tripped", [(99, 99, False), (100, 100, True), (100, 99, False), (112, 100, False), (111, 100, True), (0, 0, False)]
)
def test_breaker(spark, rows, failures, tripped):
    rate = failures / rows if rows else None
    df = spark.createDataFrame([(rows, failures, rate)], "processed_count long, error_count long, error_rate double")
    assert metrics.breaker_check(df).first().tripped == tripped
