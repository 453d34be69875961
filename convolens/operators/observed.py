"""Counts that are taken in the very pass that writes a result, with Spark's observed metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def filtered(rows: DataFrame, predicates: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """(rows that pass all predicates, what each step left). The counts are there after the first action on the rows."""
    kept, counts = F.lit(True), [F.count(F.lit(1)).alias("c0")]
    for i, predicate in enumerate(predicates.values(), 1):
        kept = kept & F.coalesce(predicate, F.lit(False))
        counts.append(F.count_if(kept).alias(f"c{i}"))
    seen = Observation()
    return rows.observe(seen, *counts).where(kept), seen


def steps(spark: SparkSession, seen: Observation, predicates: dict[str, Column]) -> DataFrame:
    """step, position, remaining, dropped, as `selection.steps` gives them with a pass of its own."""
    n = [seen.get[f"c{i}"] for i in range(len(predicates) + 1)]
    return spark.createDataFrame([(name, i, n[i], n[i - 1] - n[i]) for i, name in enumerate(predicates, 1)], "step string, position long, remaining long, dropped long")


def outcome(results: DataFrame, stages: tuple[str, ...]) -> tuple[DataFrame, Observation]:
    """(classified rows, counts of all, classified, failed, failed by stage, calls and tokens): write the rows, then look."""
    failed = {f"failed_{s}": F.count_if(F.coalesce(F.col("error").startswith(f"[{s}]"), F.lit(False))) for s in stages}
    sums = {c: F.coalesce(F.sum(c), F.lit(0)) for c in ("llm_calls", "tokens_in", "tokens_out") if c in results.columns}
    counts = {"n": F.count(F.lit(1)), "n_classified": F.count("classification"), "n_failed": F.count("error"), **failed, **sums}
    seen = Observation()
    return results.observe(seen, *[c.alias(k) for k, c in counts.items()]), seen
