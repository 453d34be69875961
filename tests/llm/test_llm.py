"""The training-data operators against brute force, round trips and held-out accuracy, with dirty rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import public_tokenizers
from convolens.llm import bpe, exact_dedup, langid, licenses, mixing, queries, sharding, simhash, substring, topk, toxicity

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}" for i in range(40_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a", 3, "x"),
    (2, "the quick  brown fox jumps over\tthe lazy dog", "en", "a", 3, None),
    (3, "The quick brown fox jumps over the lazy dog", "en", None, None, "x"),
    (4, None, None, "b", None, None),
    (5, "", None, "b", 0, None),
    (6, " \n\t ", "fr", "b", 0, None),
    (7, LONG, "en", "c", 9, None),
    (8, f"{LONG} tail", "en", "c", 9, None),
    (9, f"before {PASSAGE} after", "en", "a", 9, None),
    (10, f"other {PASSAGE} end of it", "en", "a", 9, None),
    (10, f"other {PASSAGE} end of it", "en", "a", 9, None),
    (11, "Ünïcode ☃ 漢字 text with  blanks", "de", "a", 9, None),
    (12, "one", "de", "é", 9, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_print(text):
    words = WORD.findall((text or "").encode().lower())
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    ones = Counter()
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams)) if grams else 0


def plain_components(prints):
    low = {d: d for d in prints}
    changed = True
    while changed:
        changed = False
        for a, x in prints.items():
            for b, y in prints.items():
                if (x ^ y).bit_count() <= 3 and low[b] > low[a]:
                    low[b] = low[a]
                    changed = True
    return low


def test_simhash_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {d: plain_print(t) for d, t in texts.items()}
    low = plain_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op2_simhash(spark, SF).collect()}
    assert got == {d: (f"{prints[d]:016x}", low[d]) for d in texts}


def test_simhash_dirty_rows(docs, none):
    rows = simhash.link(docs).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[i].component_id for i in (4, 5, 6)] == [4, 4, 4] and by_id[4].fp == 0
    assert [by_id[i].component_id for i in (1, 2, 3)] == [1, 1, 1]
    assert simhash.link(none).count() == 0
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and kept.where("doc_id in (2, 3, 5, 6)").count() == 0


def test_simhash_links_of_random_points(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 200, np.int64)
    points = {int(x) for x in base}
    for x in base.tolist():
        points.add(x ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(1, 5), False)))
    got = {tuple(sorted((r.a, r.b))) for r in simhash.near_links(spark.createDataFrame([(p,) for p in points], "fp long")).collect()}
    low = plain_components({p: p for p in points})
    top = {p: p for p in points}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in got:
        assert (a ^ b).bit_count() <= 3
        top[find(max(a, b, key=lambda x: -x))] = find(min(a, b, key=lambda x: -x))
    groups, wanted = defaultdict(set), defaultdict(set)
    for p in points:
        groups[find(p)].add(p)
        wanted[low[p]].add(p)
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in wanted.values()}


@pytest.mark.parametrize("few", [(0, 10**9), (0, 0)])
def test_simhash_links_by_finer_cells_and_blocks(spark, monkeypatch, few):
    monkeypatch.setattr(simhash, "FEW_POINTS", few)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    test_simhash_links_of_random_points(spark)


def test_manhattan_distance_of_points():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 2**63, 500).astype(np.uint64) for _ in range(2))
    counts = lambda x: np.stack([np.bitwise_count((x >> np.uint64(2 * i)) & np.uint64(3)) for i in range(32)]).astype(int)
    assert (np.bitwise_count(simhash._points_of(a) ^ simhash._points_of(b)) == np.abs(counts(a) - counts(b)).sum(axis=0)).all()
    assert (np.bitwise_count(simhash._points_of(a) ^ simhash._points_of(b)) <= np.bitwise_count(a ^ b)).all()


def test_topk_over_several_blocks_stops_early(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 40)
    monkeypatch.setattr(topk, "QUERIES", 3)
    test_topk_equals_brute_force(spark)
    rng = np.random.default_rng(8)
    lists = topk.Lists(np.arange(5000), rng.integers(-9, 9, (5000, 4)))
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray):
                read.append(len(at))
            return np.asarray(super().__getitem__(at))

    lists.vectors = lists.vectors.view(Counted)
    lists.top(np.array([900, 1, 0, 0]), -1, 5)
    assert 0 < sum(read) < 4000


def test_topk_of_huge_components(spark):
    schema = "vec_id long, embedding array<double>"
    rows = topk.top_k(spark.createDataFrame([(0, [3e6, 1.0]), (1, [3e6, 2.0]), (2, [2e6, 0.0])], schema), F.col("vec_id") == 0, 2).collect()
    scale = [int(x * 256) for x in (3e6, 1.0, 2.0, 2e6)]
    assert [(r.vec_id, r.score) for r in sorted(rows, key=lambda r: r.rank)] == [(1, scale[0] ** 2 + scale[1] * scale[2]), (2, scale[0] * scale[3])]
    for big in (3e7, 1e20):
        with pytest.raises(Exception, match="does not fit a long"):
            topk.top_k(spark.createDataFrame([(0, [big] * 2), (1, [big] * 2)], schema), F.col("vec_id") == 0).collect()


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8).round(1)], "x") for i in range(300)]
    rows += [(300, None, None), (301, [float("nan")] * 8, None), (302, [None] * 8, None), (303, [], None), (350, rows[0][1], None), (None, rows[0][1], None)]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string"), F.col("vec_id") % 50 == 0)
    v = {i: np.floor(np.array(e) * 256).astype(int) for i, e, _ in rows if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)}
    v[303] = np.zeros(8, int)
    wanted = set()
    for q in v:
        if q % 50 == 0:
            best = sorted((-int(v[q] @ v[c]), c) for c in v if c != q)[:5]
            wanted |= {(q, n, c, -s) for n, (s, c) in enumerate(best, 1)}
    assert {tuple(r) for r in found.collect()} == wanted
    assert topk.top_k(spark.createDataFrame(rows[:0], "vec_id long, embedding array<double>"), F.lit(True)).count() == 0


def test_exact_dedup_dirty_rows(docs, none):
    groups = defaultdict(list)
    for i, t, *_ in ROWS:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    wanted = Counter()
    for text, members in groups.items():
        sha, keep = hashlib.sha256(text.encode()).hexdigest(), min(members)[1]
        wanted.update((i, keep, len(members), sha) for _, i in members)
    rows = exact_dedup.decisions(docs).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == wanted
    assert sum(r.kept for r in rows) == len(groups)
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.decisions(none).count() == 0 and exact_dedup.keep_first(none).count() == 0


def test_exact_dedup_with_filters_for_parts_of_the_hash_space(docs, none, monkeypatch):
    clashing = docs.withColumns({c: F.lit("own") for c in ("sha", "maybe", "row", "doc", "bucket1", "bitmap1", "slice", "best")})
    whole, kept = Counter(exact_dedup.decisions(docs).collect()), Counter(exact_dedup.keep_first(clashing).collect())
    monkeypatch.setattr(exact_dedup, "BROADCAST_BYTES", 3000)
    assert len(exact_dedup.slices(docs.withColumn("sha", F.sha2("text", 256)), "sha", 13)) == 3
    assert Counter(exact_dedup.decisions(docs).collect()) == whole
    assert Counter((r.doc_id, r.sha, r.slice) for r in exact_dedup.keep_first(clashing).collect()) == Counter((r.doc_id, r.sha, r.slice) for r in kept.elements())
    assert exact_dedup.keep_first(none).count() == 0
    # one exchange, that of the possibly repeated rows: unique ones reach the result without
    plan = exact_dedup.keep_first(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def plain_removal(rows):
    seen, words = defaultdict(set), [(i, WORD.findall((t or "").encode())) for i, t, *_ in rows]
    for i, w in words:
        for at in range(len(w) - 49):
            seen[b" ".join(w[at : at + 50])].add(i)
    out = Counter()
    for i, w in words:
        gone = set()
        for at in range(len(w) - 49):
            if min(seen[b" ".join(w[at : at + 50])]) < i:
                gone.update(range(at, at + 50))
        kept = b" ".join(x for n, x in enumerate(w) if n not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_substring_dedup_dirty_rows(docs, none):
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(docs).collect())
    assert got == plain_removal(ROWS)
    assert substring.remove_repeats(none).count() == 0


def reference_encoding():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_tree_equals_whole_encoding():
    ranks, whole = reference_encoding()
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    rng = np.random.default_rng(7)
    pieces = ["word ", "a", "  ", "\n", "\n\n", " \t", "'s", "'", "é", "漢", "1234", "...", " ", "🙂", "\r\n", "I'll "]
    for size in (0, 1, 5, 40, 400):
        for _ in range(60):
            text = "".join(rng.choice(pieces, size))
            ids = codec.encode(text, leaf=16, window=3)
            assert ids == whole.encode_ordinary(text)
            assert codec.decode(ids, leaf=4) == text.encode()


def test_bpe_dirty_rows(docs, none):
    _, whole = reference_encoding()
    wanted = Counter()
    for i, t, *_ in ROWS:
        ids = whole.encode_ordinary(t or "")
        wanted[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    got = bpe.digests(docs, path, public_tokenizers.PATTERN).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == wanted
    assert bpe.digests(none, path, public_tokenizers.PATTERN).count() == 0


def test_sharding(spark, docs, none):
    for frame, n in ((docs, 4), (spark.read.parquet(f"{SF}/documents.parquet"), 40)):
        rows = sharding.interleave(frame, n).collect()
        assert len(rows) == frame.count()
        texts = Counter((r.doc_id, r.text) for r in frame.collect())
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
            {k: v for k, v in _sized(texts).items()}
        )
        slots = defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
        sizes = [len(slots[s]) for s in range(n)]
        assert max(sizes) - min(sizes) <= 1
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert sharding.interleave(none, 4).count() == 0


def _sized(texts):
    out = Counter()
    for (i, t), n in texts.items():
        b = (t or "").encode()
        out[i, len(b) + 16, zlib.crc32(b)] += n
    return out


def test_sharding_matches_the_mixture(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    source = {r.doc_id: r.source for r in frame.select("doc_id", "source").collect()}
    share = Counter(source.values())
    per = defaultdict(Counter)
    for r in sharding.interleave(frame, 10).collect():
        per[r.shard][source[r.doc_id]] += 1
    assert all(abs(per[s][x] - n / 10) <= 2 for s in per for x, n in share.items())


def test_targets_stop_at_the_cap():
    assert mixing.source_targets({"a": 10, "b": 1000, None: 1000}) == {"a": 20, "b": pytest.approx(1996.6667), None: pytest.approx(998.3333)}
    assert mixing.source_targets({}) == {}


def test_mixing(spark, docs, none):
    for frame in (docs, spark.read.parquet(f"{SF}/documents.parquet")):
        rows = mixing.mix(frame).collect()
        assert len(rows) == frame.count()
        sizes, source = Counter(), {r.doc_id: r.source for r in frame.collect()}
        for r in frame.collect():
            sizes[r.source] += len(WORD.findall((r.text or "").encode()))
        target = mixing.source_targets(sizes)
        taken, biggest = Counter(), Counter()
        for r in rows:
            s = source[r.doc_id]
            assert r.source_size == sizes[s] and r.target == pytest.approx(target[s]) and 0 <= r.taken <= 2 * r.size
            taken[s] += r.taken
            biggest[s] = max(biggest[s], r.size)
        assert all(abs(taken[s] - target[s]) <= biggest[s] for s in sizes)
        again = Counter((r.doc_id, r.taken) for r in mixing.mix(frame.repartition(5)).collect())
        assert again == Counter((r.doc_id, r.taken) for r in rows)
    assert mixing.mix(none).count() == 0 and mixing.apply_mix(none).count() == 0


def plain_targets(sizes):
    """The contract's targets by water filling: one source at a time is fixed at its cap."""
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped = set()
    while True:
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[x] for x in names if x not in capped) for s in names if s not in capped}
        over = [s for s in share if share[s] > 2 * sizes[s]]
        if not over:
            return share | {s: 2 * sizes[s] for s in capped}
        capped.add(max(over, key=lambda s: share[s] / max(sizes[s], 1e-9)))


def test_mix_meets_targets_computed_apart(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = frame.collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(WORD.findall((r.text or "").encode()))
    source, words = {r.doc_id: r.source for r in rows}, {r.doc_id: len(WORD.findall((r.text or "").encode())) for r in rows}
    found = mixing.mix(frame).collect()
    taken = Counter()
    for r in found:
        assert r.size == words[r.doc_id] and 0 <= r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
    for s, target in plain_targets(sizes).items():
        assert abs(taken[s] - target) <= max(5, 0.02 * target)


def test_mix_applied_to_rows_of_any_order(spark, docs):
    """Recomputed, joined and repartitioned inputs give each row the copies that `mix` gives it; names may clash."""
    extra = docs.withColumns({c: F.lit(7) for c in ("copies", "row", "number", "pattern", "own", "size", "group")})
    for frame in (extra, extra.repartition(5), extra.join(extra.select("doc_id").distinct(), "doc_id")):
        got = mixing.apply_mix(frame)
        assert sorted(got.columns) == sorted(frame.columns)
        wanted = Counter()
        for r in mixing.mix(docs).collect():
            wanted[r.doc_id] += r.copies
        assert Counter(r.doc_id for r in got.collect()) == +wanted
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(3)
    wanted = Counter({r.doc_id: r.copies for r in mixing.mix(frame).collect()})
    assert Counter(r.doc_id for r in mixing.apply_mix(frame).collect()) == +wanted


def test_texts_of_several_sources_are_repeated_less(spark):
    shared = [(i, f"both {i} " + "w " * 8, s) for s, at in (("a", 0), ("b", 100)) for i in range(at, at + 20)]
    shared = [(i, t if s == "a" else shared[i - 100][1], s) for i, t, s in shared]
    own = [(200 + i, f"only {i} " + "v " * 8, "ab"[i % 2]) for i in range(80)]
    frame = spark.createDataFrame(shared + own, "doc_id long, text string, source string")
    copies = {r.doc_id: r.copies for r in mixing.mix(frame, quota={"a": 450, "b": 450}).collect()}
    assert sum(copies.values()) == 90
    texts = Counter()
    for i, t, _ in shared:
        texts[t] += copies[i]
    # 80 texts of one source and 20 of both: 90 copies need no text twice but by the choice of seeded documents
    assert sum(copies[i] for i, *_ in own) >= 60 and sum(texts.values()) <= 30


def test_flow_is_the_cheapest():
    """Against all integer flows of small networks."""
    from itertools import product

    rng = np.random.default_rng(2)
    for _ in range(30):
        own = {(("a",), "a"): int(rng.integers(1, 3)), (("b",), "b"): int(rng.integers(1, 3)), (("a", "b"), "a"): int(rng.integers(1, 3)), (("a", "b"), "b"): int(rng.integers(1, 3))}
        capacity = {("a",): own[("a",), "a"], ("b",): own[("b",), "b"], ("a", "b"): int(rng.integers(1, 3))}
        quota = {s: int(rng.integers(0, 2 * sum(w for (_, x), w in own.items() if x == s) + 1)) for s in "ab"}
        flow = mixing.route(capacity, quota, 2, own)
        keys = list(own)

        def cost(words, capacity=capacity, keys=keys):
            total = Counter()
            for (p, _), w in zip(keys, words, strict=True):
                total[p] += w
            return sum(2 * (i // capacity[p] + 1) - 1 for p, w in total.items() for i in range(w))

        best = min(cost(x) for x in product(*[range(2 * own[k] + 1) for k in keys]) if all(sum(w for (_, t), w in zip(keys, x, strict=True) if t == s) == quota[s] for s in "ab"))
        got = [flow[p][s] for p, s in keys]
        assert all(sum(flow[p][s] for p, t in keys if t == s) == quota[s] for s in "ab") and cost(got) == best


def test_overlapping_sources_share_a_pattern():
    flow = mixing.route({("a",): 10, ("a", "b"): 10}, {"a": 15, "b": 5})
    assert sum(flow["a",].values()) == 10 and dict(flow["a", "b"]) == {"a": 5, "b": 5}


def test_language_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in queries.op3_langid(spark, sf).collect() if r.held_out and r.lang_pred != "und"]
    assert sum(lang[r.doc_id] == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_dirty_rows(spark, docs, none):
    model = langid.fit(docs)
    rows = langid.identify(docs, model).collect()
    assert len(rows) == len(ROWS) and all(r.lang_pred == "und" for r in rows if r.doc_id in (4, 5, 6))
    assert langid.identify(none, model).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, langid.fit(none)).collect()} == {"und"}


def test_toxicity_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [(r.predicted, label[r.doc_id]) for r in queries.op4_toxicity(spark, sf).collect() if r.held_out and r.doc_id in label]
    hit = sum(p and t for p, t in rows)
    assert hit >= 0.9 * sum(t for _, t in rows) and hit >= 0.9 * sum(p for p, _ in rows)


def test_toxicity_dirty_rows(docs, none):
    lexicon = toxicity.Lexicon({toxicity.fold("badword"): 3.0}, (toxicity.fold("badword test"),), 0.1)
    rows = toxicity.score(docs, lexicon).collect()
    assert len(rows) == len(ROWS) and {r.score for r in rows} == {0.0}
    scores = [toxicity.weigh(toxicity.fold(x), lexicon.automaton())[1] for x in ("a b4dw0rd b", "a bаdword", "a badword test", None, "")]
    assert scores == [1, 1, 0, 0, 0]
    assert toxicity.score(none, toxicity.fit(none.selectExpr("text", "1 as label"))).count() == 0


def test_licences(spark, docs, none):
    text = " ".join(licenses.SENTENCES[x] for x in ("mit-grant", "mit-notice", "mit-as-is", "mit-liability"))
    frame = spark.createDataFrame([(1, text), (2, "SPDX-License-Identifier: MIT\ncode"), (3, "Released under the MIT License! All rights reserved."), (4, None), (5, "")], "doc_id long, text string")
    got = {r.doc_id: (r.licence, r.licences, r.n_sentences) for r in licenses.scan(frame).collect()}
    assert got == {1: ("MIT", "MIT", 4), 2: ("MIT", "MIT", 1), 3: ("MIT", "MIT|proprietary", 2), 4: (None, "", 0), 5: (None, "", 0)}
    assert licenses.scan(docs).count() == len(ROWS) and licenses.scan(none).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    names = spark.read.parquet(f"{SF}/documents.parquet").columns
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = corpus_pipeline.materialise(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == names
        if name != "mixing":
            assert 0 < docs.count() <= before
    _, whole = reference_encoding()
    wanted = Counter((r.doc_id, len(whole.encode_ordinary(texts[r.doc_id] or ""))) for r in docs.collect())
    assert Counter((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF).collect()) == wanted


def test_substring_dedup_of_texts_longer_than_a_stretch(spark, monkeypatch):
    """Windows that cross stretches and batches, and a passage that one document holds twice."""
    rng = np.random.default_rng(11)
    words = [f"v{i}" for i in rng.integers(0, 10**6, 900)]
    twice = " ".join([*words[100:220], "middle", *words[100:220]])
    rows = [(1, " ".join(words)), (2, twice), (3, " ".join(["x", *words[340:700], "y", *words[40:95]])), (4, " ".join(["q"] * 700)), (5, " ".join(["q"] * 300 + words[200:251]))]
    for piece, batch in ((64, 100), (700, 333), (1 << 20, 1 << 17)):
        monkeypatch.setattr(substring, "PIECE", piece)
        monkeypatch.setattr(substring, "BATCH", batch)
        import pyarrow as pa

        both = pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
        keys = {i: set(a) for b in substring._read(iter([both])) for i, a in zip(b["doc_id"].to_pylist(), b["anchors"].to_pylist(), strict=True)}
        shared = pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "tag": [substring.tag(substring._sha(r[1])) for r in rows], "shared": [sorted(keys[r[0]]) for r in rows]})
        seen = defaultdict(set)
        for b in substring._emit(iter([shared])):
            for w, i, at in zip(b["window"].to_pylist(), b["doc_id"].to_pylist(), b["at"].to_pylist(), strict=True):
                seen[i].add((at, w))
        assert {i: len(x) for i, x in seen.items()} == {i: len(t.split()) - 49 for i, t in rows}
        if piece == 64:
            first, first_keys = seen, keys
        assert seen == first and keys == first_keys
        for i, t in rows:
            starts = np.array([0, 30, 200], np.int64)
            gone = set(range(80)) | set(range(200, 250))
            kept = [w for n, w in enumerate(t.split()) if n not in gone]
            assert substring.cut_words(t, starts) == (len(t.split()) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(frame).collect())
    assert got == plain_removal(rows)
