"""Accuracy of predictions against expected labels, in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy(rows: DataFrame, group: str, expected: str, predicted: str) -> DataFrame:
    """group, n, hits, false_positive, false_negative for 0/1 labels; a total stands in the row with a null group."""
    e, p = F.col(expected), F.col(predicted)
    counts = [F.count(F.lit(1)).alias("n"), F.count_if(e == p).alias("hits"), F.count_if((e == 0) & (p == 1)).alias("false_positive"), F.count_if((e == 1) & (p == 0)).alias("false_negative")]
    return rows.where(e.isNotNull() & p.isNotNull()).rollup(group).agg(*counts)


def fields(rows: DataFrame, expected: dict[str, str]) -> DataFrame:
    """field, n, hits, rate of observations against expectations; the worst field first, of equals the one seen more often.

    expected: field to the column that holds what is right: a value, or an array of values that all are. A null
    expectation is no question.
    """
    cells = []
    for field, column in expected.items():
        several = dict(rows.dtypes)[column].startswith("array")
        wanted = F.transform(column, lambda x: x.cast("string")) if several else F.array(F.col(column).cast("string"))
        cells.append(F.struct(F.lit(field).alias("field"), F.when(F.col(column).isNotNull(), F.array_contains(wanted, F.coalesce(F.col(field).cast("string"), F.lit("")))).alias("hit")))
    melted = rows.select(F.inline(F.array(*cells))).where("hit is not null")
    scored = melted.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("hits"))
    return scored.withColumn("rate", F.col("hits") / F.col("n")).orderBy("rate", F.desc("n"), "field")


def misses(rows: DataFrame, key: str, expected: dict[str, str]) -> DataFrame:
    """key and the fields that miss their expectation; an empty list marks a clean case."""
    wrong = []
    for field, column in expected.items():
        several = dict(rows.dtypes)[column].startswith("array")
        wanted = F.transform(column, lambda x: x.cast("string")) if several else F.array(F.col(column).cast("string"))
        wrong.append(F.when(F.col(column).isNotNull() & ~F.array_contains(wanted, F.coalesce(F.col(field).cast("string"), F.lit(""))), F.lit(field)))
    return rows.select(key, F.array_compact(F.array(*wrong)).alias("missed"))


def citations(rows: DataFrame, verdict: str, expected_verdict: str, cited: str, wanted: str, dropped: str) -> DataFrame:
    """One row: cases, right verdicts, cases with wanted citations, those that cite one of them, cases with an invented quote.

    cited and wanted: arrays of passage numbers; dropped: the number of quotes that no passage holds.
    """
    asked = F.size(wanted) > 0
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(verdict) == F.col(expected_verdict)).alias("verdicts"), F.count_if(asked).alias("n_cited"),
        F.count_if(asked & F.arrays_overlap(cited, wanted)).alias("located"), F.count_if(F.col(dropped) > 0).alias("invented"),
    )


def by_trap(rows: DataFrame, trap: str, label: str, allowed: str, flag: str, expected_flag: str) -> DataFrame:
    """trap, n, hits, false_insufficient, false_sufficient, flags_agree; all traps together in the row with a null trap.

    allowed: the array of labels that are right. A direction is wrong where none of the right labels is on its side.
    """
    right, low = F.array_contains(allowed, F.col(label)), ("rag_insufficient", "rag_partial")
    side = F.col(label).isin(*low)
    all_low, none_low = F.forall(allowed, lambda x: x.isin(*low)), F.forall(allowed, lambda x: ~x.isin(*low))
    return rows.rollup(trap).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(right).alias("hits"), F.count_if(side & none_low).alias("false_insufficient"), F.count_if(~side & all_low).alias("false_sufficient"),
        F.count_if(F.col(flag).eqNullSafe(F.col(expected_flag))).alias("flags_agree"),
    )


def legacy_health(rows: DataFrame, few: float = 0.2) -> DataFrame:
    """One row: cases whose citations all failed, dropped quotes, cases that need their context, passages on average, cases with one passage at most and whether these are too many."""
    counted = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if("citation_failed").alias("citation_failed"), F.sum("n_dropped").alias("n_dropped"), F.count_if("context_dependent").alias("context_dependent"),
        F.avg(F.size("rag_chunks")).alias("passages"), F.count_if(F.size("rag_chunks") <= 1).alias("one_passage"),
    )
    return counted.withColumn("too_few_passages", F.coalesce(F.try_divide("one_passage", "n") > few, F.lit(False)))
