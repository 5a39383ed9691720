"""The registered queries against SQL, and the pipeline, on the smallest test tables."""

from __future__ import annotations

import glob
import os

import pytest
from llm_cases import ODD
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from pageflow.llm import oracle, queries

duckdb = pytest.importorskip("duckdb")
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query(spark, tables, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    cursor = tables.execute(oracle.SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_queries_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(driver.queries())
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))


def test_pipeline(spark):
    packed = corpus_pipeline.run(spark, SF_DIR)
    got = packed.collect()
    known = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()}
    assert got and {r.doc_id for r in got} <= known
    room, held = {}, set()
    for r in got:
        if r.bin:
            room[r.bin] = room.get(r.bin, 0) + r.n_words
            assert (r.bin, r.doc_id) not in held
            held.add((r.bin, r.doc_id))
    assert max(room.values()) <= 2048


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES if s[0] != "best_fit_packing"], ids=lambda s: s[0])
def test_stages_keep_the_columns(spark, make_docs, tmp_path, stage):
    spark.createDataFrame([(8, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for rows in (ODD, []):
        docs = make_docs(rows)
        out = stage[1](spark, docs, str(tmp_path))
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        assert out.where(F.col("n_chars") != F.length("text")).count() == 0
