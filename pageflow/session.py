"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What a run wants from its session. Wide rows make the difference: a row may hold two payloads of
# many megabytes, so scans get small splits and Python small batches. Recording the call site of every
# column expression would cost a small run (a micro-batch) more time than its planning.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.parquet.columnarReaderBatchSize": "256",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": "32m",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Answers may repeat a key; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app: str = "pageflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Only a local session may go without that setting; it then uses a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="pageflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/pageflow-{uuid.uuid4().hex}"
