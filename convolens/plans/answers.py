"""The judge's answers as a store of committed writes: nothing is asked or stored twice.

A run writes what it asked into a folder of its own. The folder counts when Spark's writer has put its `_SUCCESS` mark
there, which is one step after all files are in place: a write that is cut off leaves a folder that nobody reads, and
one that is complete is read by whoever comes next, whatever became of its run. A run that is about to ask holds a
claim on the stage, a file that only one can create; others wait for it and then find its answers.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ANSWERS = "stage string, key string, answer string, error string, tokens_in long, tokens_out long"


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def committed(spark: SparkSession, store: str) -> list[str]:
    """The folders of complete writes."""
    root, fs = _path(spark, store)
    if not fs.exists(root):
        return []
    folders = [x.getPath() for x in fs.listStatus(root) if x.isDirectory() and x.getPath().getName().startswith("answers-")]
    return sorted(x.toString() for x in folders if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS")))


def read(spark: SparkSession, store: str | None) -> DataFrame:
    """One valid answer for each stage and key; prompts whose answer failed are as if never asked."""
    folders = committed(spark, store) if store else []
    rows = spark.read.schema(ANSWERS).parquet(*folders) if folders else spark.createDataFrame([], ANSWERS)
    return rows.where("error is null").dropDuplicates(["stage", "key"])


def add(rows: DataFrame, store: str) -> DataFrame:
    """Writes answers, failed ones too, and gives them back as they were written."""
    spark = rows.sparkSession
    folder = f"{store.rstrip('/')}/answers-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    return spark.read.schema(ANSWERS).parquet(folder)


def compact(spark: SparkSession, store: str) -> int:
    """Puts all valid answers into one folder and removes the others; how many folders went.

    A run that reads the old folders meanwhile must have ended; if this is cut off, both forms hold and are read once.
    """
    before = committed(spark, store)
    if len(before) > 1:
        add(read(spark, store), store)
        for folder in before:
            path, fs = _path(spark, folder)
            fs.delete(path, True)
    return len(before) if len(before) > 1 else 0


@contextmanager
def claim(spark: SparkSession, store: str, stage: str, stale: float = 6 * 3600, wait: float = 0.5) -> Iterator[None]:
    """Held by one run at a time for a stage. A claim older than `stale` seconds is that of a dead run and is taken over."""
    path, fs = _path(spark, f"{store.rstrip('/')}/claim-{stage}")
    while True:
        try:
            fs.create(path, False).close()
            break
        except Exception as e:
            if "FileAlreadyExists" not in str(e) and "already exists" not in str(e):
                raise
        try:
            if time.time() - fs.getFileStatus(path).getModificationTime() / 1000 > stale:
                fs.delete(path, False)
        except Exception as e:  # it went meanwhile
            if "FileNotFound" not in str(e) and "does not exist" not in str(e):
                raise
        time.sleep(wait)
    try:
        yield
    finally:
        fs.delete(path, False)
