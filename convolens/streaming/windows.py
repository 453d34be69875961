"""Windowed counts that run alike over batch and streaming frames; late rows end with the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _watermarked(rows: DataFrame, time: str, late: str) -> DataFrame:
    """Streams need an instant for their watermark, so a local time is read in the session's zone."""
    return rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late) if rows.isStreaming else rows


def tumbling(rows: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """started, key, n of windows of equal width."""
    counted = _watermarked(rows, time, late).groupBy(F.window(time, width), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("started"), key, "n")


def sessions(rows: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """key, started, ended, n of sessions: runs of rows less than the gap apart; ended is the last row plus the gap."""
    counted = _watermarked(rows, time, late).groupBy(F.session_window(time, gap), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(key, F.col("session_window.start").alias("started"), F.col("session_window.end").alias("ended"), "n")
