"""Ranks and cumulated shares over any number of counted labels: ranges of the order, and prefix sums on two levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convolens.operators.stages import settle


def ranked(counts: DataFrame, order: list[Column], n: str = "n") -> DataFrame:
    """counts with rank (from 1), upto (the sum of n up to this row) and total, in an order that tells all rows apart.

    Rows are dealt to ranges of the order and ranked inside each; what the ranges before hold is added. No window
    runs over all rows, and what is broadcast is one row a range.
    """
    dealt = settle(counts.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    ranges = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"), F.sum(n).alias("__sum"))
    pairs = ranges.select(F.col("__part").alias("__before"), F.col("__rows").alias("__r"), F.col("__sum").alias("__s"))
    # ranges are as many as shuffle partitions, so a join of each with those before it is small
    before = ranges.join(F.broadcast(pairs), F.col("__before") < F.col("__part"), "left").groupBy("__part").agg(F.coalesce(F.sum("__r"), F.lit(0)).alias("__r"), F.coalesce(F.sum("__s"), F.lit(0)).alias("__s"))
    total = ranges.agg(F.sum("__sum").alias("total"))
    own = Window.partitionBy("__part").orderBy(*order)
    rows = dealt.withColumns({"__rank": F.row_number().over(own), "__upto": F.sum(n).over(own.rowsBetween(Window.unboundedPreceding, 0))})
    rows = rows.join(F.broadcast(before), "__part").join(F.broadcast(total))  # total is one row
    out = rows.withColumns({"rank": (F.col("__rank") + F.col("__r")).cast("long"), "upto": F.col("__upto") + F.col("__s")})
    return out.select(*counts.columns, "rank", "upto", "total")


def cover(ranks: DataFrame, places: tuple[int, ...] = (3, 5, 10)) -> DataFrame:
    """place, covered: the share of everything that the first 3, 5 and 10 labels cover, rounded to three places."""
    return ranks.where(F.col("rank") <= max(places)).select(F.explode(F.array(*map(F.lit, places))).alias("place"), "rank", "upto", "total").where(F.col("rank") <= F.col("place")).groupBy("place").agg(F.round(F.max(F.col("upto") / F.col("total")), 3).alias("covered"))
