"""Cross tables in long form: counts first, everything else works on the few counted cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convolens.operators.ranks import ranked
from convolens.operators.stages import settle


def lift(rows: DataFrame, axis: str, column: str, least_count: int = 5, least_lift: float = 1.5) -> DataFrame:
    """axis, column, n, expected count under independence, lift, shares, and whether the cell is an outlier."""
    cells = rows.groupBy(axis, column).agg(F.count(F.lit(1)).alias("n"))
    of_axis, of_column = F.sum("n").over(Window.partitionBy(axis)), F.sum("n").over(Window.partitionBy(column))
    total = cells.agg(F.sum("n").alias("total"))
    out = cells.withColumns({"row_total": of_axis, "col_total": of_column}).join(F.broadcast(total))  # total is one row
    out = out.withColumn("expected", F.col("row_total") * F.col("col_total") / F.col("total"))
    out = out.withColumn("lift", F.try_divide("n", "expected"))
    return out.select(
        axis, column, "n", "expected", "lift",
        (F.col("n") / F.col("row_total")).alias("row_share"),
        (F.col("col_total") / F.col("total")).alias("global_share"),
        ((F.col("n") >= least_count) & (F.col("lift") >= least_lift)).alias("outlier"),
    )


def totals(rows: DataFrame, axis: str, column: str) -> DataFrame:
    """Counts of all cells, of both margins and of everything; margins hold null in the other column."""
    return rows.cube(axis, column).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("long").alias("level"))


def shares(rows: DataFrame, axis: str, column: str) -> DataFrame:
    """axis, column, n, share, level of cells (0), rows (1), columns (2) and everything (3), in one pass of grouping sets.

    The share of a cell is that of its row, that of a margin is of everything. Margins hold null in the other column.
    """
    cells = rows.groupingSets([[axis, column], [axis], [column], []], axis, column).agg(F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("n"))
    whole = cells.where("level = 3").select(F.col("n").alias("__all"))  # one row
    of_rows = cells.where("level = 1").select(F.col(axis).alias("__axis"), F.col("n").alias("__row"))
    out = cells.join(of_rows, (F.col("level") == 0) & F.col(axis).eqNullSafe(F.col("__axis")), "left").join(F.broadcast(whole))
    return out.select(axis, column, "n", (F.col("n") / F.coalesce("__row", "__all")).alias("share"), "level")


def pivot(rows: DataFrame, axis: str, column: str, values: list[str], baseline: str = "■ 전체") -> DataFrame:
    """axis, one column for each of the values in their order, others, total; the baseline row first, then by falling total.

    The values are given, so no pass is spent on finding them; what is none of them counts as `others`. The baseline
    is the sum of the counted rows and not another pass.
    """
    named = F.when(F.col(column).isin(*values), F.col(column)).otherwise("others")
    counted = rows.select(F.col(axis).cast("string").alias(axis), named.alias("__value")).groupBy(axis).pivot("__value", [*values, "others"]).agg(F.count(F.lit(1)))
    columns = [*values, "others"]
    counted = settle(counted.select(axis, *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) for c in columns]))
    total = sum([F.col(f"`{c}`") for c in columns], F.lit(0).cast("long"))
    first = counted.agg(*[F.coalesce(F.sum(f"`{c}`"), F.lit(0)).alias(c) for c in columns]).select(F.lit(baseline).alias(axis), *[f"`{c}`" for c in columns], F.lit(0).alias("__order"))
    out = first.unionByName(counted.withColumn("__order", F.lit(1))).withColumn("total", total)
    return out.orderBy("__order", F.desc("total"), axis).drop("__order")


def pareto(rows: DataFrame, label: str) -> DataFrame:
    """label, n, rank and the share that the labels up to this rank cover."""
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return ranked(counts, [F.desc("n"), F.col(label)]).select(label, "n", "rank", (F.col("upto") / F.col("total")).alias("covered"))
