"""Exclusive creation of small files: what makes a commit atomic.

On the driver's own file system a file is written under a passing name and linked to its own, which fails if that
exists. Elsewhere the Hadoop file system creates it without overwriting; HDFS does that atomically. A writer that
dies between creating and closing leaves an empty file: it counts as nothing for readers, and keeps its name, so no
other writer can take it for free.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

PASSING = ".passing-"


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file ``path`` with ``text``, unless there is one; tells whether it was created."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.getScheme() == "file":
        return _link_new(target.toUri().getPath(), text)
    try:
        out = files.create(target, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def _link_new(path: str, text: str) -> bool:
    folder, name = os.path.split(path)
    os.makedirs(folder, exist_ok=True)
    passing = f"{folder}/{PASSING}{name}-{uuid.uuid4().hex}"
    with open(passing, "w", encoding="utf-8") as out:
        out.write(text)
        out.flush()
        os.fsync(out.fileno())
    try:
        os.link(passing, path)
    except FileExistsError:
        return False
    finally:
        os.unlink(passing)
    return True
