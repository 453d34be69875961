"""Organisation hierarchies: a small table of item, middle and major joined to facts that are counted first."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convolens.functions.answer_checks import nfkc, squeeze

#: Fixed value: the bucket of values that the hierarchy does not hold.
UNMAPPED = "(미분류)"


def rollup(rows: DataFrame, item: str, tree: DataFrame, level: str) -> DataFrame:
    """level, n: rows per node of a level; tree has one row per item. Facts are counted before the join."""
    counted = rows.groupBy(F.col(item).alias("item")).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(tree.select("item", level), "item", "left").groupBy(F.coalesce(level, F.lit(UNMAPPED)).alias(level)).agg(F.sum("n").alias("n"))


def coverage(rows: DataFrame, item: str, tree: DataFrame) -> DataFrame:
    """kind, item: values of the log that the tree lacks (unmapped) and items of the tree that the log lacks (unused)."""
    seen, known = rows.select(F.col(item).alias("item")).where("item is not null").distinct(), tree.select("item").distinct()
    unmapped, unused = seen.join(known, "item", "left_anti"), known.join(seen, "item", "left_anti")
    return unmapped.select(F.lit("unmapped").alias("kind"), "item").unionByName(unused.select(F.lit("unused").alias("kind"), "item"))


def match_rates(rows: DataFrame, columns: list[str], tree: DataFrame) -> DataFrame:
    """field, n, matched: how many rows of each candidate column the tree's items cover; distinct values meet the tree."""
    melted = rows.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "field", "item").where("item is not null")
    counted = melted.groupBy("field", "item").agg(F.count(F.lit(1)).alias("n"))
    marked = counted.join(tree.select("item", F.lit(True).alias("hit")).distinct(), "item", "left")
    return marked.groupBy("field").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("matched"))


def gaps(rows: DataFrame, need: str, unit: str, question: str, order: str) -> DataFrame:
    """need, n, units (sorted, joined), n_units and the first question of each missing topic."""
    units = F.collect_set(F.col(unit).cast("string"))
    return rows.where(F.coalesce(need, F.lit("")) != "").groupBy(need).agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.array_sort(units), " · ").alias("units"),
        F.size(units).cast("long").alias("n_units"),
        F.min_by(question, order).alias("question"),
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """item, middle, major of a hierarchy file: a list of classes under whatever key, with subclasses and their items.

    Blank items and items that are no text are skipped; of repeated items the last one counts. A hierarchy is small,
    so the driver reads it.
    """
    with open(path, encoding="utf-8") as file:
        raw = json.load(file)
    classes = raw if isinstance(raw, list) else next((v for v in raw.values() if isinstance(v, list)), [])
    rows = {item.strip(): (middle.get("name", ""), major.get("name", "")) for major in classes for middle in major.get("subclasses") or [] for item in middle.get("items") or [] if isinstance(item, str) and item.strip()}
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], "item string, middle string, major string")


def attach(rows: DataFrame, field: str, tree: DataFrame) -> DataFrame:
    """rows with middle and major of a field's value, compared without white space and case; unmapped where it has none."""
    key = lambda c: F.lower(squeeze(nfkc(F.col(c))))
    dim = tree.select(key("item").alias("__item"), "middle", "major").dropDuplicates(["__item"])
    out = rows.withColumn("__item", key(field)).join(F.broadcast(dim) if dim.count() <= 100_000 else dim, "__item", "left").drop("__item")
    return out.withColumns({c: F.coalesce(c, F.lit(UNMAPPED)) for c in ("middle", "major")})


def detect_field(rows: DataFrame, columns: list[str], tree: DataFrame, least: float = 0.5) -> str | None:
    """The candidate column whose values the tree covers best, at least to this share; the first of equals; None if none does."""
    rates = {r["field"]: r["matched"] / r["n"] for r in match_rates(rows, columns, tree).collect() if r["n"]}
    best = max(columns, key=lambda c: rates.get(c, 0.0))
    return best if rates.get(best, 0.0) >= least else None


def cascade(rows: DataFrame, field: str, tree: DataFrame, major: set[str] | None = None, middle: set[str] | None = None) -> tuple[DataFrame, dict[str, list[str]]]:
    """(rows under the chosen nodes, the options that each level still offers). None does not narrow; choices that a level above rules out fall away."""
    placed = attach(rows, field, tree)
    observed = placed.groupBy("major", "middle", F.col(field).alias("item")).agg(F.count(F.lit(1)).alias("n"))  # one row per item
    under = observed if major is None else observed.where(F.col("major").isin(*sorted(major)) if major else F.lit(False))
    names = lambda df, c: [r[0] for r in df.select(c).distinct().orderBy(c).collect()]
    options = {"major": names(observed, "major"), "middle": names(under, "middle")}
    chosen = None if middle is None else sorted(middle & set(options["middle"]))
    under = under if chosen is None else under.where(F.col("middle").isin(*chosen) if chosen else F.lit(False))
    options["item"] = names(under, "item")
    return placed.where(F.col(field).isin(*options["item"]) if options["item"] else F.lit(False)), options
