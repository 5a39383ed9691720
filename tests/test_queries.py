"""Every registered query against its SQL counterpart in DuckDB, on the smallest test tables."""

from __future__ import annotations

import glob
import math
import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as driver
from pageflow import oracle, queries

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = queries.QUERIES, oracle.SQL


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(value) if isinstance(value, float) else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_query_has_a_counterpart():
    assert set(SQL) == set(QUERIES)
    assert QUERIES.items() <= driver.queries().items() and SQL.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_entry_imports_without_the_training_data_operators(tmp_path, left_out):
    root = os.path.dirname(os.path.abspath(driver.__file__))
    shutil.copytree(f"{root}/pageflow", tmp_path / "pageflow", ignore=shutil.ignore_patterns("__pycache__", *left_out))
    for name in {"__spark_entry__.py", "corpus_pipeline.py"} - set(left_out):
        if os.path.exists(f"{root}/{name}"):
            shutil.copy(f"{root}/{name}", tmp_path)
    code = "import __spark_entry__ as d; print(*sorted(d.queries()))"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    assert set(QUERIES) <= set(done.stdout.split()) and "pipeline" not in done.stdout.split()


def test_entry_has_rows(spark):
    df = driver.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = tables.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert table(df.columns, df.collect()) == table(columns, cursor.fetchall())
