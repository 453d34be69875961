"""Cuts of a long plan: what a stage gave is kept in the folder that the driver and the executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a local session without one (tests) gets a temporary folder."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="convolens-")
        atexit.register(shutil.rmtree, configured, True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def settle(rows: DataFrame) -> DataFrame:
    """rows as a reliable checkpoint: later steps neither plan nor run what came before again."""
    folder(rows.sparkSession)
    return rows.checkpoint()
