"""Filters with step accounting, turn lists against a log, and nesting of turns for output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def steps(rows: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """step, position, remaining, dropped of predicates applied one after the other, in one pass. Null fails."""
    kept, counts = F.lit(True), [F.count(F.lit(1)).alias("c0")]
    for i, predicate in enumerate(predicates.values(), 1):
        kept = kept & F.coalesce(predicate, F.lit(False))
        counts.append(F.count_if(kept).alias(f"c{i}"))
    cells = [
        F.struct(F.lit(name).alias("step"), F.lit(i).cast("long").alias("position"), F.col(f"c{i}").alias("remaining"), (F.col(f"c{i - 1}") - F.col(f"c{i}")).alias("dropped"))
        for i, name in enumerate(predicates, 1)
    ]
    return rows.agg(*counts).select(F.inline(F.array(*cells)))


def apply(rows: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    for predicate in predicates.values():
        rows = rows.where(predicate)
    return rows


def resolve_refs(turns: DataFrame, refs: DataFrame) -> DataFrame:
    """refs (conv_id, turn) with status ok, no_conversation, no_turn or no_prior; nothing is dropped silently.

    The log is first cut down to the listed conversations, so its texts do not shuffle.
    """
    wanted = refs.select("conv_id").distinct()
    found = turns.select("conv_id", "turn").join(wanted, "conv_id", "left_semi").groupBy("conv_id").agg(F.collect_set("turn").alias("turns"))
    has = lambda n: F.coalesce(F.array_contains("turns", n), F.lit(False))
    status = F.when(F.col("turns").isNull(), "no_conversation").when(~has(F.col("turn")), "no_turn").when(~has(F.col("turn") - 1), "no_prior").otherwise("ok")
    return refs.join(found, "conv_id", "left").select("conv_id", "turn", status.alias("status"))


def nest(turns: DataFrame) -> DataFrame:
    """One row per conversation with its turns as an array sorted by number."""
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
