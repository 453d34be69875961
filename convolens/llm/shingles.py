"""Near copies by the similarity of whole word-shingle sets, with the embedding of `simhash` for sets.

The fingerprint of a text is here the bit set of its five-word shingles among all 2^64 shingle hashes; two texts are
near copies if the Jaccard similarity of their sets is 4/5 or more, that is if their fingerprints differ in at most a
ninth of the bits that both hold together. A SimHash of 64 bits cannot tell that: at this similarity it differs in 10
bits on average and in 16 not rarely, where a bound on segment counts bars hardly any pair.

So the SimHash of a set (`_print`) proposes the pairs that it can tell: fingerprints within 3 bits by the segment counts
and grid of `simhash.near_links`. They are verified on the whole sets like all others, and so is what it misses, which
the same scheme finds over the wide fingerprint. There bits are dealt into segments, and as a difference changes one segment only, fingerprints at distance
d agree on all but d segments; so the segments are made d + 1 and more, and one that two texts share is a cell of the
grid. d comes from the size class of the larger text, so every text writes the cells of its own class and of the next.
A segment without bits is no cell, for most texts share it; texts where these could hide a link deal their bits anew
with another seed. In a cell every text first meets one leader; the Manhattan distance between bit counts of coarse
segments, a lower bound of the distance, bars most pairs, counts of as fine segments as the sets need bar nearly all
others that are no links, and what is left is verified on the whole sets. Cells are dealt by number once, packed, with
their nodes; only those that may link are written and joined. The counts
are kept modulo 4, where going round the shorter way can only make the bound less, so that many segments fit in few
bytes; in Gray code the way round is the number of differing bits. Only
cells whose texts these links have not connected go on. Those with the same largest component are put together, so a
text takes part once and not once a cell; each text outside of that component is held against all of the group, block
against block, and only pairs that the bound lets pass leave the task. That part still grows as the square of the number
of texts that agree on a cell without being near copies.

Words are cut and ASCII capitals folded as in `simhash.fingerprint`; a text of fewer words is one shingle, texts without
words are equal. Equal sets are one node. Repeated rows each keep a row. Very long texts are handled whole. Empty
tables give empty results; extra columns are ignored by `link` and kept by `keep_first`. Shingles and sets are told
apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convolens.llm.common import BROADCAST_BYTES, HEAVY_SHARE, arrow_rows, attach, discard, materialise, within
from convolens.llm.components import components

#: Words of a shingle; coarse segments of the bound (2^COARSE_BITS); seeds that a text tries before it uses empty segments as well.
WORDS, COARSE_BITS, SEEDS = 5, 8, 8
#: Code points of text (about) that a task looks at together.
BATCH = 1 << 19
#: Pairs of whole sets that a task gets at once.
SETS = 128
#: Cells that a task sorts at once, in about 120 bytes each; bits that a cell's number keeps on its way; groups that cells are dealt to, for each partition.
CELLS, KEY_BITS, DEALT = 1 << 18, 46, 4
#: Bytes of a pair in a broadcast table.
PAIR_BYTES = 32
#: Texts of a group above which it is dealt to several tasks, by pairs of blocks of about this many.
BLOCK = 256

U = np.uint64
_A, _B, _C = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * _B
    x = (x ^ (x >> U(27))) * _C
    return x ^ (x >> U(31))


def shingles(texts: list[str | None], n: int = WORDS) -> list[np.ndarray]:
    """For each text the distinct hashes of its word n-grams, ascending. A gram's hash combines those of its words."""
    from xxhash import xxh3_64_digest

    words = [(x or "").encode().lower().split() for x in texts]
    sizes = [len(x) for x in words]
    names = np.frombuffer(b"".join([xxh3_64_digest(w) for x in words for w in x]), ">u8").astype(U)
    grams = np.full(max(0, len(names) - n + 1), U(n))
    for i in range(n):
        grams = _mix(grams * _A + names[i : i + len(grams)])
    out, at = [], 0
    for size in sizes:
        if size >= n:
            out.append(np.unique(grams[at : at + size - n + 1]))
        else:
            one = np.full(min(size, 1), U(size))
            for name in names[at : at + size]:
                one = _mix(one * _A + name)
            out.append(one)
        at += size
    return out


def _node(own: np.ndarray) -> int:
    from xxhash import xxh3_64_intdigest

    return int(U(xxh3_64_intdigest(own.tobytes())).view(np.int64))


@lru_cache(maxsize=1)
def classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First set size of each class, greatest distance of a link whose larger text is of the class, number of segments.

    A text's links end in the next class at most: 5/4 of a size is below the class after the next. Sets smaller than
    4 link to equal ones only.
    """
    first = [4, 5]
    while first[-1] < 1 << 40:
        first.append(5 * (first[-1] - 1) // 4 + 1 if first[-1] > 4 else 5)
        if first[-1] <= first[-2]:
            first[-1] = first[-2] + 1
    low = np.array(first, np.int64)
    far = 2 * (low[1:] - 1) // 9
    return low[:-1], far, far + 2 + far // 8


def cells(sets: list[np.ndarray]) -> list[np.ndarray]:
    """For each set its cells as signed longs: the number of the cell and in the lowest bit whether it is of the own size class."""
    low, far, segments = classes()
    sizes = np.array([len(x) for x in sets], np.int64)
    own_class = np.searchsorted(low, sizes, "right") - 1
    out = []
    for step in (0, 1):
        keys: list[list[np.ndarray]] = [[] for _ in sets]
        open_ = np.flatnonzero(own_class >= 0)
        for seed in range(SEEDS):
            if not len(open_):
                break
            n, kind = sizes[open_], own_class[open_] + step
            g = segments[kind]
            bits = np.concatenate([sets[i] for i in open_])
            offset = np.cumsum(g) - g
            salted = _mix(bits + U((seed + 1) * int(_C) % 2**64))
            segment = ((salted >> U(32)) * np.repeat(g, n).astype(U) >> U(32)).astype(np.int64) + np.repeat(offset, n)
            total = int(g.sum())
            content, count = np.zeros(total, U), np.bincount(segment, minlength=total)
            np.add.at(content, segment, _mix(salted + _A))
            place = np.arange(total) - np.repeat(offset, g)
            key = _mix(content + _mix((np.repeat(kind, g) * SEEDS + seed).astype(U) * _A + place.astype(U)))
            empty = np.add.reduceat(count == 0, offset)
            sparse = empty >= g - far[kind]
            last = seed == SEEDS - 1
            for at, i in enumerate(open_):
                part = slice(offset[at], offset[at] + g[at])
                keys[i].append(key[part] if last and sparse[at] else key[part][count[part] > 0])
            open_ = open_[sparse]
        out.append([(np.concatenate(x) & ~U(1) | U(step == 0)).view(np.int64) if x else np.empty(0, np.int64) for x in keys])
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def _coarse(own: np.ndarray) -> bytes:
    """Bit counts of the coarse segments modulo 4, in Gray code: the low bits of all segments, then the high bits."""
    counts = np.bincount((own >> U(64 - COARSE_BITS)).astype(np.int64), minlength=1 << COARSE_BITS) & 3
    gray = counts ^ counts >> 1
    return np.packbits(np.concatenate([gray & 1, gray >> 1]).astype(bool)).tobytes()


def _words_of(coarse: list[bytes]) -> np.ndarray:
    """One row of longs for each text's coarse counts."""
    return np.frombuffer(b"".join(coarse), U).reshape(-1, (2 << COARSE_BITS) // 64)


def _least_distance(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Manhattan distance of coarse counts modulo 4, row by row: no more than the distance of the sets."""
    return np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)


def _fine(own: np.ndarray) -> bytes:
    """Bit counts modulo 4 of two to four segments a shingle, four counts to the byte: a sixteenth of the set or less."""
    bits = max(3, (2 * len(own)).bit_length())
    counts = np.bincount((own >> U(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint8) & 3
    return (counts.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8).tobytes()


def _fine_distance(one: bytes, two: bytes) -> int:
    """Manhattan distance of fine counts modulo 4: no more than the distance of the sets. Finer counts are folded to the other's segments."""
    x, y = ((np.frombuffer(c, np.uint8)[:, None] >> np.array([0, 2, 4, 6], np.uint8) & 3).ravel() for c in (one, two))
    while len(x) != len(y):
        x, y = ((c.reshape(-1, 2).sum(axis=1, dtype=np.uint8) & 3) if len(c) == max(len(x), len(y)) else c for c in (x, y))
    around = x - y & 3
    return int(np.minimum(around, 4 - around).sum(dtype=np.int64))


def _print(own: np.ndarray) -> int:
    """The SimHash of a set: 64 bits, set where over half of its shingles have them; no shingle gives zero."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(own), 65_536):
        ones += np.unpackbits(own[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(own), bitorder="little").view("<i8")[0])


def _sets(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches with the sets of their texts: about BATCH bytes or one text each."""
    for batch in batches:
        start, held, size = 0, [], 0
        for i, text in enumerate(batch.column(column)):
            held.append(text.as_py())
            size += len(held[-1] or "")
            if size >= BATCH:
                yield batch.slice(start, i + 1 - start), shingles(held)
                start, held, size = i + 1, [], 0
        if held:
            yield batch.slice(start), shingles(held)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> doc_id, node, size, coarse, fine, fp."""
    for batch, sets in _sets(batches, 1):
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([_node(x) for x in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int32()), pa.array([_coarse(x) for x in sets], pa.binary()), pa.array([_fine(x) for x in sets], pa.binary()), pa.array([_print(x) for x in sets], pa.int64())],
            names=["doc_id", "node", "size", "coarse", "fine", "fp"],
        )


def _runs(cell: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells (number, own, sure from the high bits on) and nodes, sorted and once each; first row of each number; whether it is wanted.

    A number is wanted if several nodes have it, one of them in its own class, or if any row says that it is sure.
    """
    order = np.lexsort((~cell & U(3), node, cell >> U(2)))
    cell, node = cell[order], node[order]
    number = cell >> U(2)
    new = np.append(True, (number[1:] != number[:-1]) | (node[1:] != node[:-1])) if len(cell) else np.empty(0, bool)
    cell, node, number = cell[new], node[new], number[new]
    first = np.flatnonzero(np.append(True, number[1:] != number[:-1])) if len(cell) else np.empty(0, np.int64)
    if not len(cell):
        return cell, node, first, new
    any_ = np.bitwise_or.reduceat(cell, first)
    several = np.diff(first, append=len(cell)) > 1
    return cell, node, first, several & (any_ & U(2) > 0) | (any_ & U(1) > 0)


def _dealt_cells(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """text -> group, cells, nodes: the cells of many texts, dealt by number, in about twelve bytes a cell.

    A number that the texts of one task prove wanted sends one row to its group, so a hot one gathers one row a task
    there; its other rows are sure, and dealt anywhere.
    """

    def flush(cell: list[np.ndarray], node: list[np.ndarray]) -> pa.RecordBatch:
        cells_, nodes, first, wanted = _runs(np.concatenate(cell), np.concatenate(node))
        sizes = np.diff(first, append=len(cells_))
        cells_ = cells_ | np.repeat(wanted, sizes).astype(U)
        spread = np.repeat(wanted, sizes)
        spread[first] = False
        salt = _mix(nodes.view(U) + cells_)
        group = (np.where(spread, salt, _mix(cells_ >> U(2))) % U(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        cells_, nodes, group = cells_[order], nodes[order], group[order]
        cuts = np.flatnonzero(np.diff(group, prepend=-1))
        ends = [*cuts[1:].tolist(), len(group)]
        # sorted numbers byte by byte: the high bytes repeat, so they compress
        planes = np.ascontiguousarray(cells_.view(np.uint8).reshape(-1, 8)[:, : (KEY_BITS + 2) // 8])
        return pa.RecordBatch.from_arrays(
            [pa.array(group[cuts].astype(np.int32)), pa.array([planes[a:b].T.tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()), pa.array([nodes[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary())],
            names=["group", "cells", "nodes"],
        )

    cell: list[np.ndarray] = []
    node: list[np.ndarray] = []
    held = 0
    for _, sets in _sets(batches, 0):
        for own, of in zip(cells(sets), sets, strict=True):
            own = own.view(U)
            cell.append(own >> U(64 - KEY_BITS) << U(2) | (own & U(1)) << U(1))
            node.append(np.full(len(own), _node(of), np.int64))
            held += len(own)
        if held >= CELLS:
            yield flush(cell, node)
            cell, node, held = [], [], 0
    if held:
        yield flush(cell, node)


def _wanted_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """group, cells, nodes of all rows of a partition -> key, node, own of the cells that are wanted.

    The rows wait in 16 bytes a cell; as each is sorted by number, ranges of numbers of about CELLS cells are taken from all of them.
    """
    width, cell, node = (KEY_BITS + 2) // 8, [], []
    for batch in batches:
        for x, y in zip(batch.column(1), batch.column(2), strict=True):
            nodes = np.frombuffer(y.as_py(), np.int64)
            whole = np.zeros((len(nodes), 8), np.uint8)
            whole[:, :width] = np.frombuffer(x.as_py(), np.uint8).reshape(width, -1).T
            cell.append(whole.view(U).ravel())
            node.append(nodes)
    parts = max(1, -(-sum(map(len, cell)) // CELLS))
    edges = np.array([(i << KEY_BITS) // parts for i in range(1, parts)], U)
    cuts = [[0, *np.searchsorted(x >> U(2), edges).tolist(), len(x)] for x in cell]
    for part in range(parts if cell else 0):
        some = [slice(c[part], c[part + 1]) for c in cuts]
        cells_, nodes, first, wanted = _runs(*(np.concatenate([x[s] for x, s in zip(of, some, strict=True)]) for of in (cell, node)))
        kept = np.repeat(wanted, np.diff(first, append=len(cells_)))
        cells_, nodes = cells_[kept], nodes[kept]
        for at in range(0, len(cells_), 1 << 16):
            key = cells_[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array((key >> U(2)).view(np.int64)), pa.array(nodes[at : at + (1 << 16)]), pa.array(key & U(2) > 0)], names=["key", "node", "own"])


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b, sizes, coarse_a, coarse_b -> the pairs a, b whose coarse counts do not bar them."""
    for batch in batches:
        one, two = (_words_of(batch.column(i).to_pylist()) for i in (3, 4))
        fits = 9 * _least_distance(one, two) <= batch.column(2).to_numpy()
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(fits))


def _pairs(one: DataFrame) -> DataFrame:
    """Distinct pairs a < b from rows with structs x and y (node, size, coarse, own) that may be similar enough."""
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    fits = (x("node") != y("node")) & (x("own") | y("own")) & (5 * F.least(x("size"), y("size")) >= 4 * F.greatest(x("size"), y("size")))
    rows = one.where(fits).select(F.least(x("node"), y("node")).alias("a"), F.greatest(x("node"), y("node")).alias("b"), (x("size") + y("size")).alias("sizes"), x("coarse").alias("coarse_a"), y("coarse").alias("coarse_b"))
    return rows.mapInArrow(_bounded, "a long, b long").distinct()


def _group_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, node, size, coarse, root, outside, side) sorted by group -> pairs a, b that the bound lets pass.

    side 0: one block by itself; 1 and 2: two blocks. One text of a pair is outside, and their roots differ.
    """

    def solve(rows: pa.Table) -> pa.RecordBatch:
        node, size, root, outside, side = (rows[c].to_numpy() for c in ("node", "size", "root", "outside", "side"))
        coarse = _words_of(rows["coarse"].to_pylist())
        size = size.astype(np.int64)
        whole = not side.any()
        one, two = (np.arange(len(node)),) * 2 if whole else (np.flatnonzero(side == 1), np.flatnonzero(side == 2))
        found = [(np.empty(0, np.int64),) * 2]
        step = max(1, 50_000 // max(1, len(two)))
        for at in range(0, len(one), step):
            x, y = one[at : at + step, None], two[None, :]
            fits = (outside[x] | outside[y]) & (root[x] != root[y]) & (5 * np.minimum(size[x], size[y]) >= 4 * np.maximum(size[x], size[y]))
            i, j = np.nonzero(fits & (x < y) if whole else fits)
            i, j = one[at + i], two[j]
            near = 9 * _least_distance(coarse[i], coarse[j]) <= size[i] + size[j]
            found.append((i[near], j[near]))
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j]))], names=["a", "b"])

    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = (pa.concat_tables([held, rows]) if held is not None else rows).combine_chunks()
        group = rows["group"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist()]
        for start, end in zip(cuts, cuts[1:], strict=False):
            yield solve(rows.slice(start, end - start))
        held = rows.slice(cuts[-1]) if len(group) else None  # the last group may go on
    if held is not None:
        yield solve(held)


def _among(apart: DataFrame) -> DataFrame:
    """Distinct pairs a < b that may be similar enough, of which one text at least is outside, from the texts of each group."""
    blocks = materialise(apart.groupBy("top").agg(F.count(F.lit(1)).alias("n")).select("top", "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "near-groups")
    rows = attach(apart, blocks, "top", apart.count(), "n")
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.xxhash64("top", F.least("own", "other"), F.greatest("own", "other")).alias("group")
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).cast("tinyint").alias("side")
    rows = rows.select(group, "node", "size", "coarse", "root", (F.col("root") != F.col("top")).alias("outside"), side)
    parts = int(apart.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "group").sortWithinPartitions("group").mapInArrow(_group_pairs, "a long, b long").distinct()


def _with_sets(pairs: DataFrame, own: DataFrame, side: str, other: str, total: int, few: bool = False) -> DataFrame:
    """pairs with the bits (its set or its counts) of the node of one side. Those of a node with many pairs are dealt to as many tasks as they need.

    Sets may be long, so none is broadcast: only the numbers of tasks of the HEAVY_SHARE nodes at most with so many pairs,
    and with `few` all pairs of other nodes, which then meet the sets where these are, without a shuffle.
    """
    limit = max(1000, total // HEAVY_SHARE)
    heavy = pairs.groupBy(side).count().where(F.col("count") > limit).select(side, F.ceil(F.col("count") / limit).cast("int").alias("parts"))
    heavy, parts = F.broadcast(materialise(heavy, "near-heavy")), F.coalesce("parts", F.lit(1))
    sets = own.select(F.col("node").alias(side), F.col("bits").alias(f"bits_{side}"))
    how = "inner" if few else "left"
    dealt = pairs.join(heavy, side, how).withColumn("part", F.pmod(F.xxhash64(other), parts).cast("int")).drop("parts")
    out = dealt.join(sets.join(heavy, side, how).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts"), [side, "part"]).drop("part")
    return out.unionByName(sets.join(F.broadcast(pairs.join(heavy, side, "left_anti")), side)) if few else out


def _with_both(pairs: DataFrame, own: DataFrame, total: int) -> DataFrame:
    """a, b, bits_a, bits_b: pairs with the bits of both nodes."""
    one = _with_sets(pairs, own, "b", "a", total, total * PAIR_BYTES <= BROADCAST_BYTES)
    return _with_sets(one, within(own, pairs.select(F.col("a").alias("node")).distinct(), "node"), "a", "b", total).select("a", "b", "bits_a", "bits_b")


def _nodes_of(pairs: DataFrame) -> DataFrame:
    # each side is reduced in the tasks that hold the pairs, before anything is a row a pair and side
    sides = pairs.select("a").distinct().unionByName(pairs.select(F.col("b").alias("a")).distinct())
    return materialise(sides.select(F.col("a").alias("node")).distinct(), "near-needed")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs a, b of nodes whose sets are similar enough; pairs that the fine counts bar meet no sets."""

    def fits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right = [9 * _fine_distance(x["fine"], y["fine"]) <= x["size"] + y["size"] for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(right, pa.bool_()))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in _sets(batches, 0):
            yield pa.RecordBatch.from_arrays([pa.array([_node(x) for x in own], pa.int64()), pa.array([x.tobytes() for x in own], pa.binary())], names=["node", "bits"])

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), U), np.frombuffer(y.as_py(), U)
                right.append(9 * len(np.intersect1d(x, y, assume_unique=True)) >= 4 * (len(x) + len(y)))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(right, pa.bool_()))

    needed = _nodes_of(pairs)
    counts = within(nodes, needed, "node").select("node", F.struct("size", "fine").alias("bits"))
    with arrow_rows(docs.sparkSession, SETS):
        left = materialise(_with_both(pairs, counts, pairs.count()).mapInArrow(fits, "a long, b long"), "near-bounded")
    discard(needed)
    needed = _nodes_of(left)
    ids = materialise(within(nodes, needed, "node").select(F.col("least").alias("doc_id")).distinct(), "near-texts")
    # texts of one node have the same set, whichever of them stays; repeated rows of one doc_id are rare
    own = materialise(within(docs, ids, "doc_id").select("text").mapInArrow(sets, "node long, bits binary").withColumn("number", F.monotonically_increasing_id()), "near-sets")
    least = own.groupBy("node").agg(F.min("number").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("node", "least")
    again = materialise(own.select("node", "number").join(least, "node").where("number != least").select("number"), "near-set-copies")
    once = within(within(own, again, "number", "left_anti"), needed, "node").select("node", "bits")
    with arrow_rows(docs.sparkSession, SETS):
        out = materialise(_with_both(left, once, left.count()).mapInArrow(similar, "a long, b long"), "near-links")
    discard(needed, ids, own, again, left)
    return out


def _print_pairs(nodes: DataFrame) -> DataFrame:
    """Distinct pairs a < b by the fingerprints: each node with one of equal fingerprint, and these along the links of `simhash.near_links`."""
    from convolens.llm import simhash

    own = materialise(nodes.where("size > 0").select("node", "fp"), "near-prints")
    points = materialise(own.groupBy("fp").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")), "near-points")
    equal = attach(own, points, "fp", own.count(), "n").select("node", "first")
    # near_links gives each point of a cell one link to the least of its tree, so a point has as many rows as cells at most but for that least one
    near = materialise(simhash.near_links(points.select("fp")).distinct(), "near-print-links")
    degrees = near.groupBy(F.col("b").alias("fp")).agg(F.count(F.lit(1)).alias("uses"))
    firsts = points.select("fp", "first")
    hubs = materialise(degrees.join(firsts, "fp").select(F.col("fp").alias("b"), F.col("first").alias("other"), "uses"), "near-print-hubs")
    linked = attach(near, hubs, "b", near.count(), "uses").join(firsts.select(F.col("fp").alias("a"), "first"), "a").select(F.col("first").alias("node"), F.col("other").alias("first"))
    return equal.unionByName(linked).where("node != first").select(F.least("node", "first").alias("a"), F.greatest("node", "first").alias("b")).distinct()


def _links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, root for every node that similar pairs link."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # one shuffle deals the cells by number, with their nodes; a task keeps those that may link, so no cell is joined or written before
    dealt = docs.select("text").mapInArrow(lambda x: _dealt_cells(x, DEALT * parts), "group int, cells binary, nodes binary").repartition(parts, "group")
    found = materialise(dealt.mapInArrow(_wanted_cells, "key long, node long, own boolean"), "near-found")
    rows = found.join(nodes.select("node", "size", "coarse"), "node").select("key", F.struct("node", "size", "coarse", "own").alias("x"))
    rows = materialise(rows, "near-rows")
    discard(found)
    total = rows.count()
    leaders = rows.groupBy("key").agg(F.min_by("x", F.struct(~F.col("x.own"), F.col("x.node"))).alias("y"), F.count(F.lit(1)).alias("n"))
    # SimHash proposes what its 64 bits can tell, the cells of the sets whatever else is similar; both are verified exactly
    tried = materialise(_print_pairs(nodes).unionByName(_pairs(attach(rows, leaders, "key", total, "n"))).distinct(), "near-pairs")
    found = _verified(tried, docs, nodes)
    linked = components(found)
    # cells that these links leave in several components: all rows outside the most common one, with all of the cell
    many = rows.groupBy("key").count().where("count > 2").select("key")
    in_cells = materialise(rows.join(many, "key", "left_semi").withColumn("node", F.col("x.node")), "near-cells")
    discard(rows)
    roots = attach(in_cells, linked.join(in_cells.groupBy("node").agg(F.count(F.lit(1)).alias("uses")), "node"), "node", total, "uses").drop("uses", "node").unionByName(
        in_cells.join(linked, "node", "left_anti").select("key", "x", F.col("node").alias("root"))
    )
    roots = materialise(roots, "near-roots")
    discard(in_cells)
    common = roots.groupBy("key", "root").count().groupBy("key").agg(F.max(F.struct("count", "root")).alias("top"), F.count(F.lit(1)).alias("roots"), F.sum("count").alias("n"))
    common = materialise(common.where("roots > 1").select("key", F.col("top.root").alias("top"), "n"), "near-open")
    # the cells of one most common component are one group, with each of their texts once
    apart = attach(roots, common, "key", total, "n").groupBy("top", F.col("x.node").alias("node")).agg(F.first("x.size").alias("size"), F.first("x.coarse").alias("coarse"), F.first("root").alias("root"))
    apart = materialise(apart, "near-apart")
    discard(roots, common)
    more = materialise(_among(apart).join(tried, ["a", "b"], "left_anti"), "near-more")
    discard(apart, tried)
    if not more.limit(1).count():
        return linked
    return components(found.unionByName(_verified(more, docs, nodes)))


def link(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, node, component_id (the smallest doc_id that links reach) for every row."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    read = materialise(docs.mapInArrow(_read, f"doc_id {kind}, node long, size int, coarse binary, fine binary, fp long"), "near-documents")
    counts = [F.first(c).alias(c) for c in ("size", "coarse", "fine", "fp")]
    nodes = materialise(read.groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"), *counts), "near-nodes")
    ids = materialise(read.select("doc_id", "node"), "near-nodes-of-documents")
    discard(read)
    roots = nodes.drop("size", "coarse", "fine", "fp").join(_links(docs, nodes), "node", "left").withColumn("root", F.coalesce("root", "node"))
    roots = materialise(roots, "near-roots-of-nodes")
    of_root = roots.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members"))
    per_node = materialise(attach(roots, of_root, "root", roots.count(), "members").select("node", "component_id", "n"), "near-components")
    return attach(ids, per_node, "node", ids.count(), "n").select("doc_id", "node", "component_id")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id. Rows without a doc_id are kept."""
    dropped = link(docs.where(F.col(doc_id).isNotNull()), doc_id, text).where("doc_id != component_id").select(F.col("doc_id").alias(doc_id)).distinct()
    return within(docs, materialise(dropped, "dropped"), doc_id, "left_anti")
