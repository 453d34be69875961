"""Mixing sources to target weights through a min-cost flow.

Documents are aggregated by membership pattern: the set of sources that hold their text. A flow from patterns to
source quotas carries words. Taking the words of a pattern's texts for the k-th time, through whichever of its sources,
costs more than for the k - 1st, so texts that several sources hold are repeated less, and repetition is spread and
used only where a quota needs it. The flow is then turned into copies of whole documents: all documents of a pattern
and source get the whole number of copies, and in the largest one of each source seeded documents get one more until
the rest of the flow is met.

The driver sees one row per pattern and source, never documents: about the number of sources where texts overlap
little, and at most the number of texts that several sources hold. Documents are drawn by cumulated sizes of hash
buckets, so a pattern with most of the rows is spread over many tasks; only its last, partly taken bucket is walked
row by row. A pattern of n rows has about sqrt(n) buckets, so both the list of buckets and a bucket grow as sqrt(n).

Null texts have no words. A null source is a source of its own, last in order. Repeated rows count each. Very long
texts are counted whole and taken whole. Empty tables give empty results. Extra columns of any name are ignored by
`mix` and kept by `apply_mix`.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict, deque

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convolens.llm.common import attach, materialise, text_of

#: Plans for up to this many patterns (short rows) are broadcast.
FEW_PATTERNS = 20_000


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sizes: dict[str | None, int], weights: tuple[float, ...] = (5, 2, 1), budget: float = 1.5, most: float = 2.0) -> dict[str | None, float]:
    """Each source's target words: its share by weight, at most `most` times its size, excess shared anew."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = budget * sum(sizes.values()), list(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > most * sizes[s]]
        if not over:
            return target | {s: unit * weight[s] for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ = [s for s in open_ if s not in target]
    return target


def _components(patterns: list[tuple]) -> list[list[tuple]]:
    """Patterns grouped so that groups share no source."""
    top: dict = {}

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for p in patterns:
        for s in p:
            top.setdefault(s, s)
            top[find(s)] = find(p[0])
    groups = defaultdict(list)
    for p in patterns:
        groups[find(p[0])].append(p)
    return list(groups.values())


def route(capacity: dict[tuple, int], quota: dict, most: int = 2, own: dict[tuple, int] | None = None) -> dict[tuple, dict]:
    """Words that each pattern gives to each of its sources: a maximum flow of least repetition cost.

    capacity: words of a pattern's distinct texts. Taking them for the k-th time costs 2k - 1 a word (the increments of
    k squared). own: words of the documents that (pattern, source) has by itself, which give to that source only, at
    most `most` times; without it a pattern's documents may give to any of its sources. Successive shortest paths, one
    group of patterns that share sources at a time.
    """
    flow: dict[tuple, dict] = {p: defaultdict(int) for p in capacity}
    for group in _components([p for p in capacity if p and capacity[p]]):
        edges: list[list] = []  # to, capacity, cost; the reverse edge follows
        out = defaultdict(list)

        def edge(a, b, most_words, cost, edges=edges, out=out):
            out[a].append(len(edges))
            edges.append([b, most_words, cost])
            out[b].append(len(edges))
            edges.append([a, 0, -cost])
            return len(edges) - 2

        used = {}
        for p in group:
            whole = capacity[p] if own is None else sum(own[p, s] for s in p)
            for k in range(1, -(-most * whole // capacity[p]) + 1):
                edge("in", ("p", p), capacity[p], 2 * k - 1)
            for s in p:
                used[p, s] = edge(("p", p), ("s", s), most * (capacity[p] if own is None else own[p, s]), 0)
        for s in dict.fromkeys(s for p in group for s in p):
            edge(("s", s), "out", quota[s], 0)
        while True:
            cost, via, queue = {"in": 0}, {}, deque(["in"])
            while queue:
                a = queue.popleft()
                for i in out[a]:
                    b, free, c = edges[i]
                    if free > 0 and cost[a] + c < cost.get(b, float("inf")):
                        cost[b], via[b] = cost[a] + c, i
                        queue.append(b)
            if "out" not in via:
                break
            path, at = [], "out"
            while at != "in":
                path.append(via[at])
                at = edges[via[at] ^ 1][0]
            words = min(edges[i][1] for i in path)
            for i in path:
                edges[i][1] -= words
                edges[i ^ 1][1] += words
        for (p, s), i in used.items():
            flow[p][s] += edges[i ^ 1][1]
    return flow


def settle(words: dict, size: dict, most: int) -> dict:
    """The words of one source's patterns as whole copies, but for the largest pattern that can take up the difference.

    So a source's words miss its quota by about one document, not by one for each pattern.
    """
    out, over = {}, 0
    for p in sorted(words, key=lambda p: (size[p], str(p))):
        wanted = min(max(words[p] + over, 0), most * size[p])
        out[p] = wanted if size[p] == max(size.values()) else size[p] * round(wanted / size[p]) if size[p] else 0
        over += words[p] - out[p]
    return out


def _walk(rows: pd.DataFrame) -> pd.DataFrame:
    """Takes whole documents in seeded order while they fit, then the smallest other one if that comes nearer."""
    rows = rows.sort_values(["draw", "doc_id", "size", "text_hash", "number"])
    left, taken, skipped = int(rows["rest"].iloc[0] - rows["before"].iloc[0]), [], []
    for i, size in enumerate(rows["size"]):
        fits = size <= left
        taken.append(fits)
        left -= size * fits
        if not fits:
            skipped.append((size, i))
    if skipped and abs(min(skipped)[0] - left) < left:
        taken[min(skipped)[1]] = True
    return rows[["number"]].assign(extra=[int(x) for x in taken])


def _members(docs: DataFrame, source: str) -> Column | None:
    """The sources of a document that belongs to several; null where the column holds one source."""
    return F.array_sort(F.array_distinct(F.col(source))) if dict(docs.dtypes)[source].startswith("array") else None


def _json(sources: Column) -> Column:
    return F.to_json(sources, {"ignoreNullFields": "false"})


def _keyed(docs: DataFrame, doc_id: str, text: str, source: str, seed: str) -> DataFrame:
    """docs as a struct `doc`, with own (their source or sources as JSON), text_hash and draw: values of the row alone."""
    members = _members(docs, source)
    own = _json(F.array(F.col(source).cast("string")) if members is None else members)
    return docs.select(F.struct("*").alias("doc"), own.alias("own"), F.xxhash64(text_of(text)).alias("text_hash"), F.md5(F.concat_ws(":", F.lit(seed), F.col(doc_id).cast("string"))).alias("draw"))


def _plan(docs: DataFrame, quota: dict | None, most: int, seed: str, doc_id: str, text: str, source: str, targets: dict) -> tuple:
    """(skinny rows, patterns of the texts that several sources hold, plan, its number of rows, number of documents).

    The plan has, for each pattern and own source, what its documents are taken: `whole` times all of them, and once
    more those of the buckets up to `full_upto` and some of the bucket `split`.
    """
    spark = docs.sparkSession
    skinny = _keyed(docs, doc_id, text, source, seed).select(F.col(f"doc.{doc_id}").alias("doc_id"), word_count(f"doc.{text}").alias("size"), "own", "text_hash", "draw")
    skinny = materialise(skinny.withColumn("number", F.monotonically_increasing_id()), "mix-rows")
    several = _members(docs, source) is not None
    n = skinny.count()
    texts = skinny.groupBy("text_hash").agg(F.array_sort(F.collect_set("own")).alias("owners"), F.count(F.lit(1)).alias("n"), F.max("size").alias("words")).where("size(owners) > 1")
    # a source's JSON is a list of one, so the lists of all owners make one list
    lists = F.flatten(F.transform("owners", lambda x: F.from_json(x, "array<string>")))
    texts = texts.select("text_hash", _json(F.array_sort(lists)).alias("pattern"), "n", "words")
    texts = materialise(texts.where(F.lit(not several)), "mix-texts")
    rows = _patterned(skinny, texts, n)
    found = rows.groupBy("pattern", "own").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    found.sort(key=lambda r: (r["pattern"], r["own"]))  # ties between equally cheap flows fall alike in every run
    alone = {r["pattern"]: r["words"] for r in texts.groupBy("pattern").agg(F.sum("words").alias("words")).collect()}
    sets = {r[x]: tuple(json.loads(r[x])) for r in found for x in ("pattern", "own")}
    size: dict = defaultdict(int)
    for r in found:
        for s in sets[r["own"]]:
            size[s] += r["size"]
    quota = source_targets(size, most=most, **targets) if quota is None else quota
    wanted = {s: round(quota.get(s, 0)) for s in size}
    by_own = {(r["pattern"], r["own"]): r for r in found}
    if several:
        flow = route({sets[p]: r["size"] for (p, _), r in by_own.items()}, wanted, most)
        words = {(p, o): sum(flow[sets[p]].values()) for p, o in by_own}
    else:
        own = {(sets[p], sets[o][0]): r["size"] for (p, o), r in by_own.items()}
        own |= {(p, s): 0 for p in {p for p, _ in own} for s in p if (p, s) not in own}
        flow = route({sets[p]: alone.get(p, r["size"]) for (p, _), r in by_own.items()}, wanted, most, own)
        words = {}
        for s in size:
            mine = {(p, o): r["size"] for (p, o), r in by_own.items() if sets[o] == (s,)}
            words |= settle({k: flow[sets[k[0]]][s] for k in mine}, mine, most)
    plan = []
    for (p, o), r in by_own.items():
        whole, rest = divmod(words[p, o], r["size"]) if r["size"] else (0, 0)
        first = sets[o][0] if sets[o] else None
        plan.append((p, o, int(whole), int(rest), math.isqrt(r["n"]) + 1, r["n"], size.get(first, 0), float(quota.get(first, 0))))
    plans = spark.createDataFrame(plan, "pattern string, own string, whole bigint, rest bigint, buckets bigint, n bigint, source_size bigint, target double")
    plans = plans.withColumn("group", F.concat_ws("\t", "pattern", "own")).drop("pattern", "own")
    rows = _grouped(rows, plans, len(plan), n)
    upto = F.sum("words").over(Window.partitionBy("group").orderBy("bucket"))
    sums = rows.groupBy("group", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("r"))
    sums = sums.withColumn("before", upto - F.col("words"))
    partly = (F.col("before") < F.col("r")) & (F.col("before") + F.col("words") > F.col("r"))
    ends = sums.groupBy("group").agg(
        F.coalesce(F.max(F.when(F.col("before") + F.col("words") <= F.col("r"), F.col("bucket"))), F.lit(-1)).alias("full_upto"),
        F.max(F.when(partly, F.col("bucket"))).alias("split"),
        F.max(F.when(partly, F.col("before"))).alias("before"),
    )
    return skinny, texts, materialise(plans.join(ends, "group"), "mix-plan"), len(plan), n


def _patterned(rows: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """rows with `pattern`: the sources that hold the row's text. Only texts of several sources are looked up."""
    shared = texts.select("text_hash", "pattern", "n")
    few = shared.count() <= FEW_PATTERNS
    if few:
        return rows.join(F.broadcast(shared.drop("n")), "text_hash", "left").withColumn("pattern", F.coalesce("pattern", "own"))
    # a text hash that several sources share goes by `attach`, so no common text is gathered
    with_it = attach(rows, shared, "text_hash", n, "n").drop("n")
    return with_it.unionByName(rows.join(shared.select("text_hash"), "text_hash", "left_anti").withColumn("pattern", F.col("own")))


def _grouped(rows: DataFrame, plans: DataFrame, groups: int, n: int) -> DataFrame:
    """rows with their group's plan and their bucket."""
    rows = rows.withColumn("group", F.concat_ws("\t", "pattern", "own"))
    rows = rows.join(F.broadcast(plans.drop("n")), "group") if groups <= FEW_PATTERNS else attach(rows, plans, "group", n, "n").drop("n")
    return rows.withColumn("bucket", F.floor(F.conv(F.substring("draw", 1, 8), 16, 10).cast("long") * F.col("buckets") / (1 << 32)))


def _extra(rows: DataFrame, split: DataFrame) -> DataFrame:
    """rows (outside of the split buckets) and split (with doc_id, size and number) with `copies`."""
    walked = split.select("group", "number", "doc_id", "size", "text_hash", "draw", "rest", "before").groupBy("group").applyInPandas(_walk, "number bigint, extra bigint")
    plain = rows.withColumn("copies", F.col("whole") + (F.col("bucket") <= F.col("full_upto")).cast("bigint"))
    names = [c for c in plain.columns if c in split.columns or c == "copies"]
    return plain.select(names).unionByName(split.join(walked, "number").withColumn("copies", F.col("whole") + F.col("extra")).select(names))


def mix(docs: DataFrame, quota: dict | None = None, most: int = 2, seed: str = "mix", doc_id: str = "doc_id", text: str = "text", source: str = "source", **targets) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken for every row of docs.

    source holds a string or, for documents of several sources, an array of strings. quota: words wanted by source;
    None computes it by `source_targets`. source_size and target are those of the document's (first) source.
    """
    skinny, texts, plan, groups, n = _plan(docs, quota, most, seed, doc_id, text, source, targets)
    rows = _grouped(_patterned(skinny, texts, n), plan, groups, n)
    in_split = F.coalesce(F.col("bucket") == F.col("split"), F.lit(False))
    out = _extra(rows.where(~in_split), rows.where(in_split))
    return out.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def apply_mix(docs: DataFrame, quota: dict | None = None, most: int = 2, seed: str = "mix", doc_id: str = "doc_id", text: str = "text", source: str = "source", **targets) -> DataFrame:
    """docs with every row repeated as often as the mix takes it; rows that it does not take go.

    How often follows from the row's own values and the plan, so it does not depend on the order or the partitions in
    which rows are read again. Only the split buckets' rows, about sqrt(n), are written with numbers and walked.
    """
    _, texts, plan, groups, n = _plan(docs, quota, most, seed, doc_id, text, source, targets)
    rows = _grouped(_patterned(_keyed(docs, doc_id, text, source, seed), texts, n), plan, groups, n)
    in_split = F.coalesce(F.col("bucket") == F.col("split"), F.lit(False))
    split = rows.where(in_split).withColumns({"doc_id": F.col(f"doc.{doc_id}"), "size": word_count(f"doc.{text}"), "number": F.monotonically_increasing_id()})
    out = _extra(rows.where(~in_split), materialise(split, "mix-split")).where("copies > 0")
    return out.select("doc", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
