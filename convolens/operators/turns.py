"""Follow-up pairing and history over conversation turns: one window per conversation, one shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convolens.operators.cases import with_history


def _before():
    """All strictly earlier turns; RANGE leaves out rows that repeat a turn number."""
    return Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)


def pairs(turns: DataFrame) -> DataFrame:
    """User turns with the answer they react to: the latest earlier turn, if that is turn - 1 and the assistant's."""
    prior = F.last(F.struct(F.col("turn").alias("turn"), "role", "text")).over(_before())
    rows = turns.withColumn("prior", prior)
    keep = (F.col("role") == "user") & (F.col("prior.turn") == F.col("turn") - 1) & (F.col("prior.role") == "assistant")
    return rows.where(keep).select("conv_id", "turn", F.col("text").alias("question"), F.col("prior.text").alias("answer"))


def history(turns: DataFrame, k: int = 3) -> DataFrame:
    """User turns with their last k non-empty earlier questions, oldest first; k <= 0 gives all."""
    asked = F.when(F.col("role") == "user", F.col("text"))
    return with_history(turns, asked, k, ("conv_id",), "turn", "text", "earlier").where("role = 'user'").select("conv_id", "turn", "text", "earlier")


def in_ranges(turns: DataFrame, ranges: list[tuple[int, int | None]]) -> DataFrame:
    """Turns inside any of the closed ranges; an open end is None. No range keeps every turn."""
    if not ranges:
        return turns
    keep = F.lit(False)
    for low, high in ranges:
        keep = keep | ((F.col("turn") >= low) & (F.lit(True) if high is None else F.col("turn") <= high))
    return turns.where(keep)


def integrity(turns: DataFrame) -> DataFrame:
    """issue, n: conversations with gaps or repeats in their turn numbers, turns without text, unknown roles."""
    per = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("turn").alias("d"), F.min("turn").alias("lo"), F.max("turn").alias("hi"))
    of_conv = per.agg(
        F.count_if((F.col("d") != F.col("n"))).alias("repeated_turn"),
        F.count_if((F.col("hi") - F.col("lo") + 1 != F.col("d")) | (F.col("lo") != 0)).alias("turn_numbering"),
    )
    of_turn = turns.agg(
        F.count_if(F.coalesce(F.trim("text"), F.lit("")) == "").alias("blank_text"),
        F.count_if(~F.coalesce(F.col("role").isin("user", "assistant", "system"), F.lit(False))).alias("unknown_role"),
    )
    long = lambda df: df.unpivot([], df.columns, "issue", "n")
    return long(of_conv).unionByName(long(of_turn))
