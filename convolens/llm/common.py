"""What the training-data operators share: shared-folder tables, skew-safe attachment, word rules."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words: \x20 and \x09-\x0D.
SPACES = " \t\n\x0b\x0c\r"
#: A key with more than this share of all rows is heavy; there are at most HEAVY_SHARE of them.
HEAVY_SHARE = 256
#: Keys of up to this many bytes, with 16 bytes of overhead each, are broadcast.
BROADCAST_BYTES = 48 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a temporary one only where a local session sets none (tests).

    Executors of a cluster could not read each other's temporary folders, so there an unset folder is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="convolens-")
    atexit.register(shutil.rmtree, own, True)
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes df as a table in the shared folder and reads it back.

    A lost executor then costs only its own running tasks. The table stays until `discard` or until the folder is
    cleared.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables of `materialise` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def arrow_rows(spark: SparkSession, n: int) -> Iterator[None]:
    """Python stages that are planned inside get batches of at most n rows and about 8 MB: for rows that may each be very large."""
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(n), "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
    before = {name: spark.conf.get(name) for name in limits}
    for name, value in limits.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def attach(rows: DataFrame, per_key: DataFrame, key: str, total: int, size: str) -> DataFrame:
    """Inner equi-join of rows with one row per key that does not gather a hot key in one task.

    per_key has the key's row count in column `size`. Keys above total / HEAVY_SHARE rows number at most
    HEAVY_SHARE, so they are broadcast; the rows of all other keys shuffle.
    """
    limit = max(1000, total // HEAVY_SHARE)
    heavy = per_key.where(F.col(size) > limit)
    light = per_key.where(F.col(size) <= limit)
    hot = rows.join(F.broadcast(heavy), key)
    rest = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key)
    return hot.unionByName(rest)


def within(rows: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Semi or anti join against distinct keys, broadcast only where a count of their bytes proves them small."""
    width = F.octet_length(F.col(key).cast("string")) if keys.schema[key].dataType.typeName() in ("string", "binary") else F.lit(8)
    size = keys.agg(F.sum(width + 16)).first()[0] or 0
    return rows.join(F.broadcast(keys) if size <= BROADCAST_BYTES else keys, key, how)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def unit_hash(*columns: Column) -> Column:
    """A seeded pseudo-random number in [0, 1) from the columns."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / F.lit(float(1 << 53))
