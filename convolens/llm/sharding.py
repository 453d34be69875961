"""Sharding by proportional stratified interleaving, law `rows`.

Rows are shuffled by a seeded hash within their source and ranked. Row number r of n in its source stands at the
fraction (r - 1/2) / n. In the order of these fractions every stretch of rows holds the sources in proportion, so
equal cuts of that order give shards that match the mixture and whose row counts differ by one at most.

No source is ever gathered: ranks come from counts by (source, hash bucket) and row numbers inside a bucket, and
positions from counts by fraction bucket and row numbers inside one.

Null sources form a source of their own. Null texts have 16 bytes and the CRC of an empty text. Equal texts may go
to different shards: the law `rows` leaves no room for a group larger than a shard. Repeated rows get slots of their
own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convolens.llm.common import materialise, text_of

#: Rows that one bucket should hold, and the fewest buckets.
BUCKET_ROWS, LEAST_BUCKETS = 50_000, 256


def interleave(docs: DataFrame, shards: int, seed: str = "shard", doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of docs."""
    skinny = materialise(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(text_of(text)) + 16).cast("long").alias("size"),
            F.crc32(text_of(text)).alias("text_crc32"),
            F.when(F.col(source).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(source).cast("string"))).alias("source"),
            F.md5(F.concat_ws(":", F.lit(seed), F.col(doc_id).cast("string"))).alias("draw"),
        ),
        "shard-rows",
    )
    n = skinny.count()
    buckets = max(LEAST_BUCKETS, n // BUCKET_ROWS)
    part = F.floor(F.conv(F.substring("draw", 1, 8), 16, 10).cast("long") * buckets / (1 << 32)).alias("bucket")
    drawn = skinny.withColumn("bucket", part)
    counts = drawn.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n"))
    by_source = Window.partitionBy("source")
    before = counts.select("source", "bucket", (F.sum("n").over(by_source.orderBy("bucket")) - F.col("n")).alias("before"), F.sum("n").over(by_source).alias("source_rows"))
    inside = Window.partitionBy("source", "bucket").orderBy("draw", "doc_id", "text_crc32", "size")
    ranked = drawn.withColumn("rank", F.row_number().over(inside)).join(before, ["source", "bucket"])
    placed = materialise(
        ranked.select("doc_id", "size", "text_crc32", "source", ((2 * (F.col("before") + F.col("rank")) - 1) / (2 * F.col("source_rows"))).alias("fraction")),
        "shard-fractions",
    ).withColumn("bucket", F.floor(F.col("fraction") * buckets))
    starts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("start"))
    inside = Window.partitionBy("bucket").orderBy("fraction", "source", "doc_id", "text_crc32", "size")
    position = placed.withColumn("rank", F.row_number().over(inside)).join(starts, "bucket").withColumn("position", F.col("start") + F.col("rank") - 1)
    shard = F.floor(F.col("position") * shards / F.lit(max(n, 1)))
    # shard s starts at the first position p with floor(p * shards / n) = s
    first = F.ceil(F.col("shard") * F.lit(max(n, 1)) / F.lit(shards))
    return position.withColumn("shard", shard).select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("position") - first).cast("long").alias("slot"))
