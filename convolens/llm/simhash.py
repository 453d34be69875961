"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits; the bit counts of the segments are a point with integer
coordinates. The Manhattan distance of two points is a lower bound of the Hamming distance of their fingerprints, so
a range join of the points at the wanted distance loses no link, and each candidate is then verified on its bits.

The range join works on a grid: the coordinates are dealt into groups, and a cell fixes the coordinates of all groups
but as many as the distance. Two points at that distance agree on at least so many groups, so they share a cell.
Equal fingerprints are one point, whatever the number of documents. Inside a cell links are found block against
block, and only a spanning set of them is emitted, never all pairs; cells with many points are dealt to several tasks
by pairs of blocks. Components come from star contraction in the shared folder.

Null and wordless texts have the fingerprint zero, which links like any other. Repeated rows each keep a row. Empty
tables give empty results. Extra columns are ignored by `link`, and kept by `keep_first`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convolens.llm import shingles
from convolens.llm.common import attach, discard, materialise, within
from convolens.llm.components import components

#: Points above which a cell is dealt to several tasks, by blocks of this many.
BLOCK = 4096
#: Points up to which 2, 3 and 4 groups fix a cell (with a distance of 3: 5, 6 and 7 groups).
FEW_POINTS = (2_000_000, 50_000_000)


def fingerprint(text: str | None, n: int = 3) -> int:
    """The SimHash of a text's word n-grams, XXH64 with seed 42, repeats included; ASCII capitals fold."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < n:
        return xxh64_intdigest(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    hashes = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends[n - 1 :].tolist(), strict=False)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.fromiter((fingerprint(x.as_py(), n) for x in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, fp long")


_EVEN = 0x5555555555555555


def _points(fp: Column) -> Column:
    """The 32 counts of two-bit segments in 64 bits: bit 2i is set if count i is 1 or more, bit 2i + 1 if it is 2.

    So the Manhattan distance of two points is the number of bits in which these differ.
    """
    low, high = fp.bitwiseAND(F.lit(_EVEN)), F.shiftright(fp, 1).bitwiseAND(F.lit(_EVEN))
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _points_of(fps: np.ndarray) -> np.ndarray:
    """`_points` of an array of unsigned longs."""
    low, high = fps & np.uint64(_EVEN), (fps >> np.uint64(1)) & np.uint64(_EVEN)
    return low | high | ((low & high) << np.uint64(1))


def _cells(distance: int, fixed: int) -> list[tuple[int, int]]:
    """(number, mask over the packed point) of each way to fix `fixed` of distance + fixed groups of coordinates."""
    groups = np.array_split(np.arange(32), distance + fixed)
    masks = [sum(3 << (2 * int(i)) for i in g) for g in groups]
    whole = [sum(c) for c in combinations(masks, fixed)]
    return [(i, m - (1 << 64) if m >= 1 << 63 else m) for i, m in enumerate(whole)]


def _near(a: np.ndarray, b: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the pairs of a and b at this Hamming distance or less; the Manhattan bound goes first."""
    parts = []
    one, two = _points_of(a), _points_of(b)
    step = max(1, 2_000_000 // max(1, len(b)))
    for at in range(0, len(a), step):
        i, j = np.nonzero(np.bitwise_count(one[at : at + step, None] ^ two[None, :]) <= distance)
        real = np.bitwise_count(a[at + i] ^ b[j]) <= distance
        parts.append((at + i[real], j[real]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.empty(0, np.int64),) * 2


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links i-j: each node with the least node of its tree."""
    top = np.arange(n)
    if len(i):
        while True:
            low = np.minimum(top[i], top[j])
            before = top.copy()
            np.minimum.at(top, i, low)
            np.minimum.at(top, j, low)
            top = top[top]
            if (top == before).all():
                break
    at = np.flatnonzero(top != np.arange(n))
    return list(zip(at.tolist(), top[at].tolist(), strict=True))


def _small_groups(keys: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside groups of equal keys (sorted): all shifts of the sorted rows at once, so small groups cost little."""
    found = []
    shift = 1
    at = np.arange(len(keys))
    points = _points_of(fps)
    while True:
        at = at[at + shift < len(keys)]
        at = at[keys[at] == keys[at + shift]]
        if not len(at):
            break
        near = at[np.bitwise_count(points[at] ^ points[at + shift]) <= distance]
        near = near[np.bitwise_count(fps[near] ^ fps[near + shift]) <= distance]
        found.append((near, near + shift))
        shift += 1
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 2


def _links_in_cells(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows (cell, fp, side) sorted by cell; side 0: one block by itself, 1 and 2: two blocks of a large cell."""
    held: list[np.ndarray] = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int8)]

    def solve(cell: np.ndarray, fp: np.ndarray, side: np.ndarray) -> pa.RecordBatch:
        fps = fp.view(np.uint64)
        starts = np.flatnonzero(np.diff(cell, prepend=cell[0] - 1))
        sizes = np.diff(starts, append=len(cell))
        large = np.repeat(sizes > 64, sizes)
        small = np.flatnonzero(~large)
        tree = _forest(len(small), *_small_groups(cell[small], fps[small], distance))
        out: list[tuple[int, int]] = [(small[a], small[b]) for a, b in tree]
        for start, size in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist(), strict=True):
            rows = np.arange(start, start + size)
            one, two = rows[side[rows] == 1], rows[side[rows] == 2]
            if len(one) or len(two):
                i, j = _near(fps[one], fps[two], distance)
                pairs_here = (one[i] - start, two[j] - start)
            else:
                i, j = _near(fps[rows], fps[rows], distance)
                pairs_here = (i[i < j], j[i < j])
            out += [(start + a, start + b) for a, b in _forest(size, *pairs_here)]
        a, b = np.array(out, np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

    for batch in batches:
        held = [np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held)]
        last = np.searchsorted(held[0], held[0][-1]) if len(held[0]) else 0  # the last cell may go on
        if last:
            yield solve(*[h[:last] for h in held])
            held = [h[last:] for h in held]
    if len(held[0]):
        yield solve(*held)


def near_links(points: DataFrame, distance: int = 3) -> DataFrame:
    """a, b: links that connect all of the distinct fps in `points` that are within the distance, directly or not."""
    n = points.count()
    fixed = 2 + sum(n > x for x in FEW_POINTS)
    cells = F.explode(F.array(*[F.xxhash64(F.lit(i), F.col("point").bitwiseAND(F.lit(m))) for i, m in _cells(distance, fixed)]))
    rows = points.select("fp", _points(F.col("fp")).alias("point")).select("fp", cells.alias("cell"))
    sizes = materialise(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("cell", "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "cell-sizes")
    shared = materialise(attach(rows, sizes, "cell", n * len(_cells(distance, fixed)), "n").drop("n"), "cells")
    discard(sizes)
    plain = shared.where("blocks = 1").select("cell", "fp", F.lit(0).cast("tinyint").alias("side"))
    # large cells: every pair of blocks is a cell of its own
    block = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = shared.where("blocks > 1").select("cell", "fp", block.alias("own"), other, "blocks")
    pair = F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).cast("tinyint")
    dealt = plain.unionByName(paired.select(pair.alias("cell"), "fp", side.alias("side")))
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(lambda x: _links_in_cells(x, distance), "a long, b long")


def link(docs: DataFrame, distance: int = 3, n: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp (signed long), component_id (the smallest doc_id that links reach) for every row."""
    prints = materialise(fingerprints(docs, n, doc_id, text), "prints")
    points = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "points")
    linked = components(near_links(points.select("fp"), distance))
    roots = materialise(points.join(linked.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first", "n"), "roots")
    of_root = roots.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("members"))
    per_fp = materialise(attach(roots, of_root, "root", roots.count(), "members").select("fp", "component_id", "n"), "components")
    return attach(prints, per_fp, "fp", prints.count(), "n").select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_first(docs: DataFrame, distance: int = 3, n: int = 3, doc_id: str = "doc_id", text: str = "text", similar: bool = False) -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id. Rows without a doc_id are kept.

    Texts are linked by their fingerprints, or with `similar` by a Jaccard similarity of 0.8 or more of their whole
    sets of five-word shingles: the same embedding and grid over the sets themselves, see `shingles`.
    """
    if similar:
        return shingles.keep_first(docs, doc_id, text)
    dropped = link(docs.where(F.col(doc_id).isNotNull()), distance, n, doc_id, text).where("doc_id != component_id").select(F.col("doc_id").alias(doc_id)).distinct()
    return within(docs, materialise(dropped, "dropped"), doc_id, "left_anti")
