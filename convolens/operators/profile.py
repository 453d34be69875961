"""Survey statistics. Values are counted before they are ranked, so no task holds the rows of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convolens.operators.stages import settle

QUANTILES = (0.25, 0.5, 0.75, 0.9)
#: Distinct values of a key that are sorted in one task; keys above that, and above one HOT_SHARE-th of all, are selected in bins.
HOT_VALUES, HOT_SHARE, BINS = 100_000, 1024, 4096


def histogram_of_sizes(rows: DataFrame, key: str) -> DataFrame:
    """size, n: how many keys have that many rows."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("size")).groupBy("size").agg(F.count(F.lit(1)).alias("n"))


def numeric_profile(rows: DataFrame, key: str, value: str, hot: int = HOT_VALUES) -> DataFrame:
    """n, missing, lo, p25, p50, p75, p90, hi by key; quantile p is the sorted value number min(n - 1, floor(n p)), from 0.

    Values are counted first. A key with more distinct values than `hot`, and than a thousandth of all, is never in
    one task: its quantiles come by `selected`. The others, with a bounded number of values each, are sorted.
    """
    counts = settle(rows.groupBy(F.col(key).alias("key"), F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c")))
    limit = max(hot, counts.count() // HOT_SHARE)
    known = F.when(F.col("v").isNotNull(), F.col("c")).otherwise(0)
    facts = counts.groupBy("key").agg(F.sum(known).alias("n"), F.sum(F.col("c") - known).alias("missing"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("values"))
    facts = settle(facts)
    large = facts.where(F.col("values") > limit)  # HOT_SHARE keys at most
    small = counts.join(F.broadcast(large.select(F.col("key").alias("hot_key"))), F.col("key").eqNullSafe(F.col("hot_key")), "left_anti")
    ordered = Window.partitionBy("key").orderBy(F.col("v").asc_nulls_last())
    ranked = small.withColumn("upto", F.sum(known).over(ordered)).withColumn("n", F.sum(known).over(Window.partitionBy("key")))
    # the first value whose cumulated count exceeds the wanted number
    quantile = lambda p: F.min(F.when(F.col("upto") > _place(p), F.col("v")))
    found = ranked.groupBy("key").agg(*[quantile(p).alias(_named(p)) for p in QUANTILES])
    if large.limit(1).count():
        chosen = selected(counts, large.where("n > 0").select("key", "n"))
        of_large = large.select("key").join(chosen, large["key"].eqNullSafe(chosen["of"]), "left").groupBy("key").agg(*[F.max(F.when(F.col("p") == p, F.col("v"))).alias(_named(p)) for p in QUANTILES])
        found = found.unionByName(of_large)
    out = facts.join(found.withColumnRenamed("key", "of"), F.col("key").eqNullSafe(F.col("of")))
    return out.select(F.col("key").alias(key), "n", "missing", "lo", *map(_named, QUANTILES), "hi")


def _named(p: float) -> str:
    return f"p{round(p * 100)}"


def _place(p: float) -> Column:
    """The number, from 0, of the value wanted of n sorted ones."""
    return F.least(F.col("n") - 1, F.floor(F.col("n") * F.lit(p)))


def selected(counts: DataFrame, keys: DataFrame, bins: int = BINS) -> DataFrame:
    """of (the key), p, v: the exact quantiles of a few keys with any number of values, by distributed selection.

    counts: key, v, c. keys: key, n. Each round cuts the range that holds a wanted value into bins, counts them with
    a partial sum in every task, and goes on in the one bin that holds it, between the least and the greatest value
    there. These always fall into different bins, so a round that leaves two values leaves fewer in the next.
    """
    number = F.col("v").cast("double")
    spans = counts.where("v is not null").join(F.broadcast(keys.select(F.col("key").alias("of"), "n")), F.col("key").eqNullSafe(F.col("of")))
    ends = spans.groupBy("of", "n").agg(F.min(F.when(~F.isnan(number), F.col("v"))).alias("lo"), F.max(F.when(~F.isnan(number), F.col("v"))).alias("hi"))
    wanted = settle(ends.select("of", F.explode(F.array(*[F.struct(F.lit(p).alias("p"), _place(p).alias("left")) for p in QUANTILES])).alias("x"), "lo", "hi").select("of", "x.p", "x.left", "lo", "hi"))
    first = True
    while first or wanted.where("lo < hi").limit(1).count():
        inside = counts.where("v is not null").join(F.broadcast(wanted), F.col("key").eqNullSafe(F.col("of")))
        half = lambda c: F.col(c).cast("double") / 2  # noqa: E731  so that no difference is infinite
        share = F.when(F.col("hi") > F.col("lo"), (half("v") - half("lo")) / (half("hi") - half("lo"))).otherwise(0.0)
        between = (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")) & ~F.isnan(number)
        # values that are no number stand behind all others, in a bin of their own
        bin_ = F.when(F.isnan(number), bins).when(between, F.least(F.floor(share * bins), F.lit(bins - 1)))
        cells = inside.withColumn("bin", bin_).where(F.col("bin").isNotNull() & (F.lit(first) | (F.col("bin") < bins) | F.isnan(F.col("lo").cast("double"))))
        summed = cells.groupBy("of", "p", "left", "bin").agg(F.sum("c").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("c").over(Window.partitionBy("of", "p").orderBy("bin"))  # over bins, not over values
        held = summed.withColumn("upto", upto).where((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("c") <= F.col("left")))
        wanted, first = settle(held.select("of", "p", (F.col("left") - F.col("upto") + F.col("c")).alias("left"), "lo", "hi")), False
    return wanted.select("of", "p", F.col("lo").alias("v"))


def histogram(rows: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """bin, n of equal width between least and greatest value; the last bin is closed, empty bins are listed."""
    known = rows.select(F.col(value).cast("double").alias("v")).where("v is not null")
    ends = known.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where("lo is not null")
    at = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins))))
    counted = known.join(F.broadcast(ends)).groupBy(at.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))  # ends is one row
    spine = rows.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return spine.join(counted, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def top_labels(rows: DataFrame, key: str, label: Column, k: int = 12) -> DataFrame:
    """The k most frequent labels of each key with the key's total and its number of other labels."""
    counts = rows.groupBy(key, label.alias("label")).agg(F.count(F.lit(1)).alias("n"))
    per = Window.partitionBy(key)
    rank = F.row_number().over(per.orderBy(F.desc("n"), "label"))
    ranked = counts.select("*", rank.alias("rank"), F.sum("n").over(per).alias("total"), F.greatest(F.count(F.lit(1)).over(per) - k, F.lit(0)).alias("other_kinds"))
    return ranked.where(F.col("rank") <= k)
