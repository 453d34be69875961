"""Exact deduplication by two-pass Bloom filtering, DataFrame functions only.

Pass 1 reduces every text to a digest and sets the bits of a filter that at least two rows hit. Pass 2 tests
every row against that filter: a row that fails is certainly unique and passes straight through; only rows that
pass are shuffled by digest and grouped. Where one filter for all rows would be too large to broadcast, the hash space
is cut into parts; rows are written once more, by part, and unique ones still never shuffle.

Null texts count as empty. Rows that repeat a doc_id are told apart, and exactly one row of a group stays. Very long
texts are read whole. Empty tables give empty results. Extra columns of any name are ignored by `decisions` and kept
by `keep_first`.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convolens.llm.common import SPACES, attach, materialise, scratch_dir, text_of

#: Filter bits for a row; two of them are set.
BITS_PER_ROW = 16
#: Greatest filter, which is broadcast. Where all rows need a larger one, the digests are cut into parts with a filter each.
BROADCAST_BYTES = 32 << 20


def normalised(column: str = "text") -> Column:
    """The text without ASCII white space, null as empty."""
    return F.translate(text_of(column), SPACES, "")


def _positions(digest: Column, bits: int) -> list[Column]:
    """Two bit positions from 1, one in each half of the filter."""
    half = bits // 2
    return [F.xxhash64(digest).bitwiseAND(F.lit(half - 1)) + 1, F.xxhash64(digest, F.lit(1)).bitwiseAND(F.lit(half - 1)) + 1 + half]


def _bit(bitmap: str, position: Column) -> Column:
    """Whether the bit of this position is set in its bucket's bitmap; null bitmaps have none."""
    at = F.bitmap_bit_position(position)
    value = F.conv(F.hex(F.substring(F.col(bitmap), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(value, at.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))


def _bits(n: int) -> int:
    return 1 << max(16, (BITS_PER_ROW * max(n, 1) - 1).bit_length())


def slices(rows: DataFrame, digest: str, n: int) -> list[tuple[DataFrame, int]]:
    """rows cut by digest into parts whose filters can each be broadcast, with about the number of rows of each.

    More than one part is written by the tasks that hold the rows, in a folder for each part, without a shuffle.
    """
    parts = -(-_bits(n) // 8 // BROADCAST_BYTES)
    if parts <= 1:
        return [(rows, n)]
    spark = rows.sparkSession
    path = f"{scratch_dir(spark)}/slices-{uuid.uuid4().hex}"
    cut = rows.select(F.struct("*").alias("row"), F.pmod(F.xxhash64(F.col(digest), F.lit(2)), F.lit(parts)).alias("slice"))
    cut.write.partitionBy("slice").parquet(path)
    table = spark.read.schema(cut.schema).parquet(path)
    return [(table.where(F.col("slice") == i).select("row.*"), -(-n // parts)) for i in range(parts)]


def repeat_filter(rows: DataFrame, digest: str, n: int) -> tuple[DataFrame, int]:
    """The second filter: for each bucket a bitmap of the positions hit by two rows or more. With its bits.

    This pass shuffles two numbers of eight bytes a row, less what map tasks add up, and no text.
    """
    bits = _bits(n)
    hits = rows.select(F.explode(F.array(*_positions(F.col(digest), bits))).alias("position")).groupBy("position").count()
    twice = hits.where("count > 1")
    return twice.groupBy(F.bitmap_bucket_number("position").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("position")).alias("bitmap")), bits


def possibly_repeated(rows: DataFrame, bitmaps: DataFrame, bits: int, digest: str) -> DataFrame:
    """row (a struct of all columns of rows) and maybe: false means that no other row has this digest."""
    first, second = _positions(F.col(f"row.{digest}"), bits)
    out = rows.select(F.struct("*").alias("row")).withColumns({"bucket1": F.bitmap_bucket_number(first), "bucket2": F.bitmap_bucket_number(second)})
    for i in (1, 2):
        # bitmaps of `bits` bits at most: `slices` keeps them within BROADCAST_BYTES
        out = out.join(F.broadcast(bitmaps.select(F.col("bucket").alias(f"bucket{i}"), F.col("bitmap").alias(f"bitmap{i}"))), f"bucket{i}", "left")
    return out.select("row", (_bit("bitmap1", first) & _bit("bitmap2", second)).alias("maybe"))


def _tested(parts: list[tuple[DataFrame, int]], digests: DataFrame | None = None) -> DataFrame:
    """`possibly_repeated` of all rows, each part by a filter over its digests (column sha); a single part's may be given.

    Of several parts each is written before the next filter is made, so one filter at a time is broadcast.
    """
    found = []
    for rows, n in parts:
        bitmaps, bits = repeat_filter(digests if digests is not None and len(parts) == 1 else rows.select("sha"), "sha", n)
        tested = possibly_repeated(rows, materialise(bitmaps, "repeats"), bits, "sha")
        found.append(tested if len(parts) == 1 else materialise(tested, "tested"))
    return reduce(DataFrame.unionByName, found)


def decisions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal normalised texts the row with the most code points in its original text stays, then the smallest
    doc_id, then any one of fully equal rows.
    """
    digests = materialise(docs.select(F.col(doc_id).alias("doc_id"), F.sha2(normalised(text), 256).alias("sha"), F.length(text_of(text)).alias("length"), F.monotonically_increasing_id().alias("number")), "digests")
    n = digests.count()
    tested = _tested(slices(digests, "sha", n))
    single = tested.where(~F.col("maybe")).select("row.doc_id", F.col("row.doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("row.sha").alias("text_sha256"))
    maybe = materialise(tested.where("maybe").select("row.*"), "maybe")
    best = F.min(F.struct((-F.col("length")).alias("length"), F.col("doc_id").alias("id"), F.col("number").alias("number")))
    groups = maybe.groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
    joined = attach(maybe, groups, "sha", n, "group_size")
    grouped = joined.select("doc_id", F.col("best.id").alias("keep_id"), "group_size", (F.col("number") == F.col("best.number")).alias("kept"), F.col("sha").alias("text_sha256"))
    return single.unionByName(grouped)


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the rows that `decisions` drops, with all their columns.

    Rows that the filter proves unique stay where they are; only possibly repeated rows shuffle. Each map task
    reduces its copies to one row for a digest before that.
    """
    tagged = docs.select(F.struct("*").alias("doc"), F.sha2(normalised(text), 256).alias("sha"))
    digests = materialise(tagged.select("sha"), "digests")
    n = digests.count()
    tested = _tested(slices(tagged, "sha", n), digests)
    order = F.struct(-F.length(text_of(f"row.doc.{text}")), F.col(f"row.doc.{doc_id}"))
    best = tested.where("maybe").groupBy("row.sha").agg(F.min_by("row.doc", order).alias("doc"))
    return tested.where(~F.col("maybe")).select("row.doc.*").unionByName(best.select("doc.*"))
