"""Hard negatives by product quantisation with stored residual norms.

A row's vector is cut into subspaces; each is stored as the number of its nearest centroid, and of what the centroids
leave the norm is stored, once for each of a few groups of subspaces. An anchor's inner products with all centroids
are a table, so that a row's sum of looked-up values is its score but for the product with the residual, which by
Cauchy-Schwarz is at most the sum over groups of the two norms' products. Score minus and plus that bound hold the
true score. A window of scores then discards what lies outside of it or below its first places for certain, and what
is left is scored by exact integers, best bound first, until no bound can beat the last place. So the answer is
exact, whatever the centroids; these are fitted on a bounded sample, a subspace in a task.

Rows are dealt into blocks by a hash, so that one label may hold any share of them, and every block of anchors meets
every block of rows: first for the positives, then, with their scores, for the negatives. The anchors are a given
set, so this is rows times anchors at worst, of looked-up values. A block has a bound on its numbers.

Rows without an id or a label, and vectors that are null or hold null or non-finite components, take no part. A
shorter vector counts as padded with zeros. Rows that repeat an anchor's id are neither its positives nor its
negatives; other repeated rows are rows each, ties between them in no order that shows; of repeated anchors the one
with the least label, then the least vector, asks. Scores beyond a long are an error. Where numbers are too large for
exact doubles every row is scored by whole numbers. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convolens.llm.common import materialise
from convolens.llm.topk import quantised

#: Components of a subspace, its centroids, groups of subspaces with a residual norm each.
PART, CENTROIDS, NORMS = 2, 256, 4
#: Rows that the centroids are fitted on at most, and rounds of the fit.
SAMPLE, ROUNDS = 4096, 6
#: Most rows of a block, most anchors of a block, most numbers of either, most looked-up scores at once.
ROWS, ANCHORS, NUMBERS, SCORES = 8192, 1024, 4 << 20, 2 << 20
#: Up to this size of a score its doubles are exact.
EXACT = float(1 << 52)


def fit_part(points: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Up to CENTROIDS whole-number centroids of points (rows) by k-means from evenly spaced distinct points."""
    distinct = np.unique(points, axis=0)
    at = distinct[np.linspace(0, len(distinct) - 1, min(CENTROIDS, len(distinct))).astype(int)].astype(np.float64)
    for _ in range(rounds):
        own = nearest(points, at)
        n = np.bincount(own, minlength=len(at))
        for d in range(points.shape[1]):
            at[:, d] = np.where(n > 0, np.bincount(own, points[:, d], len(at)) / np.maximum(n, 1), at[:, d])
    return np.rint(at)


def nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The number of the nearest centroid of each point."""
    out = np.empty(len(points), np.int64)
    half = (centroids**2).sum(axis=1) / 2
    for i in range(0, len(points), 8192):
        out[i : i + 8192] = np.argmin(half - points[i : i + 8192] @ centroids.T, axis=1)
    return out


def codebook(rows: DataFrame, width: int) -> list[np.ndarray]:
    """The centroids of every subspace, from the SAMPLE rows of least hash; each subspace is fitted in a task of its own."""
    some = rows.select("id", "vector").orderBy(F.xxhash64("id", "vector"), "id").limit(max(CENTROIDS, min(SAMPLE, NUMBERS // width)))
    parts = -(-width // PART)
    cut = some.select(F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda m: F.slice("vector", m * PART + 1, PART))).alias("part", "point"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        points = np.zeros((len(pdf), PART))
        for row, x in zip(points, pdf["point"], strict=True):
            row[: len(x)] = x
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "centroids": [fit_part(points).ravel()]})

    found = {r.part: np.array(r.centroids).reshape(-1, PART) for r in cut.groupBy("part").applyInPandas(fit, "part int, centroids array<double>").collect()}
    return [found.get(m, np.zeros((1, PART))) for m in range(parts)]


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), -(-width // PART) * PART), np.int64)
    for row, x in zip(out, vectors, strict=True):
        row[: len(x)] = x
    return out


class Codes:
    """A block of rows as codes and residual norms."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, book: list[np.ndarray]):
        self.ids, self.labels, self.vectors, self.book = ids, labels, vectors, book
        self.groups = np.array_split(np.arange(len(book)), min(NORMS, len(book)))
        self.codes = np.empty((len(book), len(ids)), np.uint8)
        self.norms = np.zeros((len(self.groups), len(ids)))
        for g, parts in enumerate(self.groups):
            for m in parts:
                points = vectors[:, m * PART : (m + 1) * PART].astype(np.float64)
                self.codes[m] = nearest(points, book[m])
                self.norms[g] += ((points - book[m][self.codes[m]]) ** 2).sum(axis=1)
        self.norms = np.sqrt(self.norms) * (1 + 1e-9)
        self.most = float(np.abs(vectors.astype(np.float64)).max(initial=0))

    def bounds(self, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of asks (rows) with all rows of the block."""
        q = asks.astype(np.float64)
        if max(self.most, np.abs(q).max(initial=0), *[np.abs(b).max(initial=0) for b in self.book]) ** 2 * 2 * q.shape[1] > EXACT:
            free = np.full((len(q), len(self.ids)), np.inf)
            return -free, free
        middle = np.zeros((len(q), len(self.ids)))
        for m, centroids in enumerate(self.book):
            middle += np.take(q[:, m * PART : (m + 1) * PART] @ centroids.T, self.codes[m], axis=1)
        own = np.stack([np.sqrt((q.reshape(len(q), -1, PART)[:, parts] ** 2).sum(axis=(1, 2))) for parts in self.groups], axis=1) * (1 + 1e-9)
        slack = np.ceil(own @ self.norms) + 1
        return middle - slack, middle + slack

    def exact(self, ask: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if self.most * float(np.abs(ask.astype(np.float64)).max(initial=0)) * len(ask) < EXACT:
            return (self.vectors[rows].astype(np.float64) @ ask.astype(np.float64)).astype(np.int64)
        out = self.vectors[rows].astype(object) @ ask.astype(object)
        if any(abs(int(x)) >= 2**63 for x in out):
            raise OverflowError("a score does not fit a long")
        return out.astype(np.int64)

    def first(self, ask: np.ndarray, low: np.ndarray, high: np.ndarray, fit: np.ndarray, k: int, least: int | None = None, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k first rows of `fit` with a score of least to most."""
        rows = fit if most is None else fit[low[fit] <= most]
        rows = rows if least is None else rows[high[rows] >= least]
        sure = low[rows] if least is None else low[rows][(low[rows] >= least) & (high[rows] <= most)]
        if len(sure) >= k:
            rows = rows[high[rows] >= np.partition(sure, -k)[-k]]
        rows = rows[np.argsort(-high[rows], kind="stable")]
        ids, scores, at, step = np.empty(0, np.int64), np.empty(0, np.int64), 0, 64
        while at < len(rows) and not (len(scores) == k and high[rows[at]] < scores[-1]):
            part = rows[at : at + step]
            got = self.exact(ask, part)
            good = np.ones(len(got), bool) if least is None else (got >= least) & (got <= most)
            ids, scores = np.concatenate([ids, self.ids[part[good]]]), np.concatenate([scores, got[good]])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores, at, step = ids[best], scores[best], at + step, step * 2
        return ids, scores


def window(positive: int) -> tuple[int, int]:
    """The least and the greatest score of a negative: 50 * positive <= 100 * score <= 95 * positive."""
    return -(-50 * positive // 100), 95 * positive // 100


def _search(asks: pd.DataFrame, rows: pd.DataFrame, width: int, book: list[np.ndarray], k: int) -> pd.DataFrame:
    """Of one block with one block: each anchor's k first positives, or, where it brings the scores of its positives, the k first negatives of each score."""
    found = []
    if len(asks) and len(rows):
        block = Codes(rows["id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), matrix(rows["vector"], width), book)
        vectors = matrix(asks["vector"], width)
        step = max(1, SCORES // len(rows))
        scores_of = asks["scores"] if "scores" in asks else [None] * len(asks)
        for i, (own, label, scores) in enumerate(zip(asks["id"], asks["label"], scores_of, strict=True)):
            if i % step == 0:
                low, high = block.bounds(vectors[i : i + step])
            lo, hi = low[i % step], high[i % step]
            if scores is None:
                fit = np.flatnonzero((block.labels == label) & (block.ids != own))
                wanted = [(None, block.first(vectors[i], lo, hi, fit, k))]
            else:
                widest = window(int(scores[0]))[0], window(int(scores[-1]))[1]
                fit = np.flatnonzero((block.labels != label) & (block.ids != own) & (lo <= widest[1]) & (hi >= widest[0]))
                wanted = [(s, block.first(vectors[i], lo, hi, fit, k, *window(int(s)))) for s in scores]
            found += [(np.full(len(ids), own), np.full(len(ids), s or 0), ids, got) for s, (ids, got) in wanted]
    columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.empty(0)] * 4
    return pd.DataFrame(dict(zip(["anchor_id", "positive_score", "id", "score"], columns, strict=True))).astype("int64")


def _everywhere(asks: DataFrame, rows: DataFrame, width: int, book: list[np.ndarray], k: int, n: int) -> DataFrame:
    """The k first of all rows for every anchor and positive score, blocks against blocks."""
    most = max(1, NUMBERS // width)
    blocks, ask_blocks = max(1, -(-n // min(ROWS, most))), max(1, -(-asks.count() // min(ANCHORS, most)))
    deal = lambda n, *more: F.pmod(F.xxhash64("id", *more), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asks.select("*", deal(ask_blocks).alias("a"), every(blocks).alias("b"))
    right = rows.select("*", deal(blocks, F.col("vector")).alias("b"), every(ask_blocks).alias("a"))
    own = lambda a, b: _search(a, b, width, book, k)
    found = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(own, "anchor_id long, positive_score long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("score"), "id")).cast("int")
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for every anchor and each of its
    first positives (rows of its label) the first rows of other labels whose score is 50 to 95 % of the positive's."""
    own = vectors.select(F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"), quantised(embedding, scale).alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    rows = materialise(own.where("id is not null and label is not null and vector is not null"), "vectors")
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    width = max(1, width or 1)
    book = codebook(rows, width)
    anchors = materialise(rows.where("asks").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("x")).select("id", "x.label", "x.vector"), "anchors")
    rows = rows.drop("asks")
    found = materialise(_everywhere(anchors, rows, width, book, positives, n).select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # below zero no score is at once 50 % and 95 %
    scores = found.where("positive_score >= 0").groupBy(F.col("anchor_id").alias("id")).agg(F.array_sort(F.collect_set("positive_score")).alias("scores"))
    asks = materialise(anchors.join(scores, "id"), "asks")
    chosen = _everywhere(asks, rows, width, book, negatives, n)
    out = found.join(chosen, ["anchor_id", "positive_score"])
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
