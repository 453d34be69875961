"""An equi-join that a hot key does not gather in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this share of all rows is heavy; there are at most so many of them.
HEAVY_SHARE = 256


def attach(rows: DataFrame, per_key: DataFrame, key: str, total: int, size: str) -> DataFrame:
    """Inner join of rows with one row a key, which has the number of its rows in column `size`.

    Heavy keys are HEAVY_SHARE at most, so their side is broadcast and their rows stay where they are.
    """
    limit = max(1000, total // HEAVY_SHARE)
    heavy, light = per_key.where(F.col(size) > limit), per_key.where(F.col(size) <= limit)
    hot = rows.join(F.broadcast(heavy), key)
    rest = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key)
    return hot.unionByName(rest)
