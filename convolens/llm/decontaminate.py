"""Benchmark decontamination: a broadcast hash set of test n-grams over training token windows, DataFrame functions only.

Words are normalised; every run of n consecutive words of a test item is a window, and an item of fewer words is one
window. The distinct windows are broadcast by their 64-bit hash. One scan of the documents hashes the window at every
word, looks it up, and compares the words of each hit, so that a collision of hashes is no hit. A document's hits are
gathered in the task that holds it; only one row a document is shuffled, and no text. Windows that are more than
BROADCAST_BYTES are cut by hash into parts, and the documents are scanned once for each part, one after the other.

Null texts have no words. Rows that repeat a doc_id are told apart by their texts; fully equal rows get equal rows.
Very long texts are read whole: their hits are as many as their words at most. Items that repeat an id are one item;
items without an id mark words but are not counted. Empty documents give an empty result, an empty benchmark hits
nothing. Extra columns of any name are ignored by `decisions` and kept by `clean`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convolens.llm.common import BROADCAST_BYTES, attach, discard, materialise, text_of

#: What separates words, in lower-cased text and in text as it is.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
BETWEEN_CASED = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Greatest cost of a window's row in the broadcast set, besides its words.
ROW_BYTES = 64


def words(text: str) -> Column:
    """The lower-cased words of a text column."""
    return F.array_remove(F.split(F.translate(text_of(text), CAPITALS, SMALL), f"{BETWEEN}+"), "")


def item_windows(items: DataFrame, n: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct item_id (as string), window (array of words)."""
    own = items.select(F.col(item_id).cast("string").alias("item_id"), words(text).alias("words")).where(F.size("words") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - (n - 1), F.lit(1)))).alias("start")
    return own.select("item_id", "words", starts).select("item_id", F.slice("words", F.col("start"), n).alias("window")).distinct()


def _key(window: Column) -> Column:
    return F.xxhash64(window)


def _looked_up(docs: DataFrame, windows: DataFrame, lengths: list[int], marks: bool) -> DataFrame:
    """doc_id, digest, n_words, and hit: start, stop, window_id of every occurrence of a window, in order of the scan.

    With `marks` every row of docs has one more row, without a hit.
    """
    # one generator for all lengths: a second one would hold a copy of the words for every place of the first
    first, k = -1 if marks else 0, len(lengths)
    last = F.greatest((F.size("words") - (min(lengths) - 1)) * k - 1, F.lit(first))
    at = docs.select("doc_id", "digest", "words", F.explode(F.sequence(F.lit(first), last)).alias("number"))
    n = F.element_at(F.array(*map(F.lit, lengths)), F.greatest(F.col("number"), F.lit(0)) % k + 1) if k > 1 else F.lit(lengths[0])
    at = at.withColumns({"start": F.when(F.col("number") < 0, -1).otherwise(F.expr(f"cast(number div {k} as int)")), "n": n})
    at = at.withColumn("key", F.when((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.size("words")), _key(F.slice("words", F.greatest(F.col("start"), F.lit(0)) + 1, F.col("n")))))
    found = at.join(F.broadcast(windows), "key", "left" if marks else "inner")
    same = F.col("window") == F.slice("words", F.greatest(F.col("start"), F.lit(0)) + 1, F.col("n"))
    hit = F.when(same, F.struct("start", (F.col("start") + F.col("n")).alias("stop"), "window_id")).alias("hit")
    return found.where((F.col("start") < 0) | same).select("doc_id", "digest", F.size("words").cast("long").alias("n_words"), (F.col("start") < 0).cast("long").alias("rows"), hit)


def _spans(hits: str) -> Column:
    """Start and stop of the runs of words that the hits cover."""
    empty = F.array().cast("array<struct<start:int,stop:int>>")

    def add(spans: Column, hit: Column) -> Column:
        last = F.element_at(spans, -1)
        joined = F.concat(F.slice(spans, 1, F.size(spans) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], hit["stop"]).alias("stop"))))
        return F.when((F.size(spans) > 0) & (hit["start"] <= F.try_element_at(spans, F.lit(-1))["stop"]), joined).otherwise(F.concat(spans, F.array(F.struct(hit["start"].alias("start"), hit["stop"].alias("stop")))))

    return F.aggregate(F.array_sort(hits), empty, add)


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(text_of(text), 256))


def decisions(docs: DataFrame, items: DataFrame, n: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: doc_id, digest (SHA-256 of the text), n_words, n_hit, n_items, items_sha256, spans (runs of hit words from start up to stop)."""
    of_items = materialise(item_windows(items, n, item_id, item_text), "item-windows")
    windows = materialise(of_items.select("window").distinct().select(F.monotonically_increasing_id().alias("window_id"), _key(F.col("window")).alias("key"), "window"), "windows")
    bytes_, lengths = windows.agg(F.sum(F.octet_length(F.array_join("window", " ")) + ROW_BYTES), F.collect_set(F.size("window"))).first()
    parts = max(1, -(-(bytes_ or 0) // BROADCAST_BYTES))
    own = docs.select(F.col(doc_id).alias("doc_id"), _digest(text).alias("digest"), words(text).alias("words"))
    found = []
    for part in range(parts):
        # one filter of the set after the other: each scan is written before the next broadcast is made
        one = windows if parts == 1 else windows.where(F.pmod("key", F.lit(parts)) == part)
        hits = _looked_up(own, one, sorted(lengths) or [n], part == 0)
        found.append(hits if parts == 1 else materialise(hits, "hits"))
    rows = reduce(DataFrame.unionByName, found).groupBy("doc_id", "digest", "n_words").agg(F.sum("rows").alias("rows"), F.collect_set("hit").alias("hits"))
    sets = F.array_sort(F.array_distinct(F.transform("hits", lambda x: x["window_id"])))
    flagged = materialise(rows.select("doc_id", "digest", "n_words", "rows", _spans("hits").alias("spans"), sets.alias("windows")).withColumn("set", F.sha2(F.array_join("windows", ","), 256)), "flagged")
    # documents that hold the same windows hold the same items: the items are gathered once for each set of windows
    per_set = flagged.where(F.size("windows") > 0).groupBy("set").agg(F.count(F.lit(1)).alias("documents"), F.any_value("windows").alias("windows"))
    named = of_items.join(windows, "window").select("window_id", "item_id")
    listed = per_set.select("set", "documents", F.explode("windows").alias("window_id")).join(named, "window_id").groupBy("set").agg(F.first("documents").alias("documents"), F.array_sort(F.collect_set("item_id")).alias("items"))
    listed = materialise(listed.select("set", "documents", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")), "listed")
    hit = attach(flagged.where(F.size("windows") > 0), listed, "set", flagged.count(), "documents").drop("documents")
    clean_ = flagged.where(F.size("windows") == 0).withColumns({"n_items": F.lit(0).cast("long"), "items_sha256": F.sha2(F.lit(""), 256)})
    n_hit = F.aggregate("spans", F.lit(0), lambda total, x: total + x["stop"] - x["start"]).cast("long")
    out = hit.unionByName(clean_).select("doc_id", "digest", "n_words", n_hit.alias("n_hit"), "n_items", "items_sha256", "spans", F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("row"))
    discard(*[x for x in found if parts > 1])
    return out.drop("row")


def clean(docs: DataFrame, items: DataFrame, n: int = 10, whole: bool = False, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs, with all their columns, without what occurs in the benchmark.

    With `whole` documents that hold a window go. Otherwise the words of windows go, each with what separates it from
    the word before, and the text that is left may be empty; texts without hits, null ones too, stay as they are.
    """
    hit = decisions(docs, items, n, doc_id, text, item_id, item_text).where("n_hit > 0").select(F.col("doc_id").alias("id"), "digest", "spans").distinct()
    kept = docs.select(F.struct("*").alias("doc"))
    found = (F.col(f"doc.{doc_id}").eqNullSafe(F.col("id"))) & (_digest(f"doc.{text}") == F.col("digest"))
    if whole:
        return kept.join(hit, found, "left_anti").select("doc.*")
    pieces = F.regexp_extract_all(f"doc.{text}", F.lit(f"{BETWEEN_CASED}*(?:(?!{BETWEEN_CASED})[\\s\\S])+"), 0)
    stay = F.filter(pieces, lambda _, i: ~F.exists("spans", lambda x: (x["start"] <= i) & (i < x["stop"])))
    tail = F.regexp_extract(f"doc.{text}", f"{BETWEEN_CASED}*$", 0)
    cut = F.when(F.col("spans").isNull(), F.col(f"doc.{text}")).otherwise(F.concat(F.array_join(stay, ""), tail))
    return kept.join(hit, found, "left").select(F.col("doc").withField(text, cut).alias("doc")).select("doc.*")
