"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Candidates are dealt into blocks. A block sorts each dimension once; a query then reads the lists from the end that
its sign favours, scores every row met for the first time, and stops when the bound (the query times the values at
the present depth) is below its kth score, so that no unread row can replace a result or tie with one. The blocks'
results for a query are merged at the end.

Every query meets every candidate block, queries in blocks too: the query set is given, and memory is that of two
blocks. That work, rows times queries at worst, is what an exact search of a given query set asks for; the shuffle
holds every candidate once for each block of queries, and a block of wide vectors has fewer rows, so that it keeps
its size in bytes. Scores and scaled components that do not fit a long are an error, never wrapped. Vectors that are null or hold null or non-finite components take no part, nor do rows without an id. A
shorter vector counts as padded with zeros. Rows that repeat a query's id are not its candidates; other repeated rows
are candidates each; of repeated query ids the least vector asks. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convolens.llm.common import materialise

#: Most rows of a block of candidates and of queries, and most numbers of either; rows read from each list in the first round.
CANDIDATES, QUERIES, NUMBERS, FIRST = 16_384, 2048, 4 << 20, 32


class Lists:
    """A block of vectors with its rows sorted by every dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        self.order = np.argsort(self.vectors.T, axis=1, kind="stable")
        self.values = np.take_along_axis(self.vectors.T, self.order, axis=1)

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but those with the id `own`; ties to the smaller id."""
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = np.zeros(n, bool)
        ids, scores = np.empty(0, np.int64), np.empty(0, self.vectors.dtype)
        depth, step = 0, FIRST
        while depth < n:
            upto = min(n, depth + step)
            if len(up) + len(down):
                new = np.zeros(n, bool)
                new[self.order[up, n - upto : n - depth]] = True
                new[self.order[down, depth:upto]] = True
                rows = np.flatnonzero(new & ~seen)
                seen[rows] = True
                bound = query[up] @ self.values[up, n - upto] + query[down] @ self.values[down, upto - 1]
            else:
                rows, bound, upto = np.arange(n), 0, n
            got = self.vectors[rows] @ query
            fit = (self.ids[rows] != own) & (got >= scores[-1] if len(ids) == k else True)
            ids, scores = np.concatenate([ids, self.ids[rows[fit]]]), np.concatenate([scores, got[fit]])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k and bound < scores[-1]:
                break
            depth, step = upto, step * 2
        return ids, scores


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, x in zip(out, vectors, strict=True):
        row[: len(x)] = x
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> type:
    """float64 where every inner product is an integer below 2^53, int64 below 2^63, else whole numbers of any size."""
    top = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (a, b)]
    most = top[0] * top[1] * max(1, a.shape[1])
    return np.float64 if most < 2**53 else np.int64 if most < 2**62 else object


def block_top(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    found = []
    if len(queries) and len(candidates):
        width = max(candidates["vector"].map(len).max(), queries["vector"].map(len).max())
        asks, rows = _matrix(queries["vector"], width), _matrix(candidates["vector"], width)
        kind = _exact(asks, rows)
        lists = Lists(candidates["id"].to_numpy(np.int64), rows.astype(kind))
        for own, query in zip(queries["id"], asks.astype(kind), strict=True):
            ids, scores = lists.top(query, own, k)
            if any(abs(int(x)) >= 2**63 for x in scores[:1]) or any(abs(int(x)) >= 2**63 for x in scores[-1:]):
                raise OverflowError(f"a score of query {own} does not fit a long")
            found.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores.astype(np.int64)}))
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")


def quantised(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double; null where the vector takes no part. Beyond a long it is an error."""
    whole = lambda x: F.when(F.abs(x) < float(2**63), F.floor(x).cast("long")).otherwise(F.raise_error(F.lit("a scaled component does not fit a long")).cast("long"))
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: whole(x.cast("double") * scale)))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every query row."""
    rows = materialise(vectors.select(F.col(vec_id).cast("long").alias("id"), quantised(embedding, scale).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")).where("id is not null and vector is not null"), "vectors")
    asking = rows.where("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    most = max(1, NUMBERS // max(1, width or 1))  # rows of a block that hold so many numbers
    blocks, ask_blocks = max(1, -(-n // min(CANDIDATES, most))), max(1, -(-asking.count() // min(QUERIES, most)))
    deal = lambda n, *more: F.pmod(F.xxhash64("id", *more), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asking.select("id", "vector", deal(ask_blocks).alias("q"), every(blocks).alias("c"))
    right = rows.select("id", "vector", deal(blocks, F.col("vector")).alias("c"), every(ask_blocks).alias("q"))
    found = left.groupBy("q", "c").cogroup(right.groupBy("q", "c")).applyInPandas(lambda a, b: block_top(a, b, k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
