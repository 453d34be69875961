"""Hard negatives, spelling variants and decontamination against brute force, with dirty rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from convolens.llm import decontaminate, negatives, queries, variants

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# hard negatives


def plain_negatives(rows, k=5, m=3):
    usable = [(i, x, [math.floor(256 * y) for y in v]) for i, v, x in rows if i is not None and x is not None and v is not None and all(y is not None and math.isfinite(y) for y in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = set()
    for i, label, v in usable:
        if i % 50:
            continue
        others = sorted(((-score(v, w), j, x) for j, x, w in usable if j != i))
        for p, pid, _ in [o for o in others if o[2] == label][:k]:
            fit = [(-s, j) for s, j, x in others if x != label and 50 * -p <= 100 * -s <= 95 * -p][:m]
            out |= {(i, pid, r + 1, j, -p, s) for r, (s, j) in enumerate(fit)}
    return out


def mined(frame, **more):
    return sorted(tuple(r) for r in negatives.mine(frame, F.col("vec_id") % 50 == 0, F.col("label"), **more).collect())


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_negatives_equal_brute_force_on_the_table(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding], (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in queries.op11_negatives(spark, SF).collect()) == sorted(plain_negatives(rows))


def test_negatives_with_dirty_rows_ties_and_a_hot_label(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 64)
    draw = random.Random(5)
    rows = [(i, [draw.choice([0.0, 0.5, 1.0, -0.25]) for _ in range(draw.choice([3, 5]))], draw.choice([1, 1, 1, 2, 3])) for i in range(400)]
    rows += [(900, None, 1), (950, [1.0, None], 1), (1000, [1.0, float("nan")], 1), (1050, [float("inf")], 2), (1100, [1.0, 1.0], None), (None, [1.0], 1), (1150, [], 1), (1200, [0.0] * 5, 2)]
    assert mined(vectors(spark, rows)) == sorted(plain_negatives(rows))
    clash = vectors(spark, rows).withColumns({"id": F.lit("x"), "asks": F.lit(1), "vector": F.lit(2), "score": F.lit(3)})
    assert mined(clash.repartition(7)) == sorted(plain_negatives(rows))


def test_negatives_of_repeated_rows_are_rows_each(spark):
    rows = [(50, [1.0], 1), (1, [1.0], 1), (1, [1.0], 1), (2, [0.75], 2), (2, [0.75], 2), (50, [1.0], 1), (50, [0.5], 3)]
    assert mined(vectors(spark, rows)) == [(50, 1, 1, 2, 65536, 49152), (50, 1, 1, 2, 65536, 49152), (50, 1, 2, 2, 65536, 49152), (50, 1, 2, 2, 65536, 49152)]


def test_negatives_of_an_empty_table_and_of_numbers_beyond_doubles(spark):
    assert mined(vectors(spark, [])) == []
    big = 3e6 / 256
    rows = [(50, [big, big], 1), (1, [big, big], 1), (2, [big, big / 2], 2), (3, [big, big * 0.875], 2)]
    assert mined(vectors(spark, rows)) == sorted(plain_negatives(rows))
    with pytest.raises(Exception, match="does not fit a long"):
        mined(vectors(spark, [(50, [1e8], 1), (1, [1e8], 1)]))


def test_bounds_hold_every_score_whatever_the_centroids():
    draw = np.random.default_rng(3)
    rows, asks = draw.integers(-400, 400, (200, 10)), draw.integers(-400, 400, (20, 10))
    book = [draw.integers(-300, 300, (8, 2)).astype(float) for _ in range(5)]
    low, high = negatives.Codes(np.arange(200), np.zeros(200), rows, book).bounds(asks)
    assert ((low <= asks @ rows.T) & (asks @ rows.T <= high)).all()


# spelling variants


def plain_vocabulary(docs, every=97):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def apart(a, b):
    """Whether one inserted, deleted or replaced character makes b of a."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2 and apart(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: b for w, b in best.items() if words[b] >= 2 * words[w]}
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=str)


def test_variants_equal_brute_force_on_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((tuple(r) for r in variants.variants(frame, 97).collect()), key=str)
    assert got == plain_variants(plain_vocabulary(docs))


def test_variants_of_crowded_words_with_ties_chains_and_dirty_rows(spark):
    draw = random.Random(9)
    words = ["".join(draw.choice("abé") for _ in range(draw.choice([5, 6, 7]))) for _ in range(500)]
    chain = ["stone"] * 4 + ["stoney"] * 8 + ["stonney"] * 16 + ["stonneys"] * 40
    long = "x" * 200
    docs = [(1, " ".join(words)), (2, " ".join(words[:300]).upper()), (None, " ".join(chain)), (4, None), (5, ""), (6, "1 2 3"), (7, f"{long} {long} {long} {long}y {long}y {long}y {long}y {long}y {long}y"), (7, "ÀÉÎÕÜ àéîõü " * 3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"word": F.lit("w"), "n": F.lit(1), "run": F.lit("r")})
    expected = plain_variants(plain_vocabulary(docs))
    assert sorted((tuple(r) for r in variants.variants(frame, 97).collect()), key=str) == expected
    assert sorted((tuple(r) for r in variants.variants(frame.repartition(5), 97).collect()), key=str) == expected
    found = {x[0]: x for x in expected}
    assert found["stone"][:3] == ("stone", "stoney", "stonneys")
    assert found[long][1] == f"{long}y"


def test_variants_of_empty_tables(spark):
    assert variants.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# decontamination


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_hits(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        for i in range(max(1, len(w) - n + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for i in range(len(w)):
            for k in {len(x) for x in windows}:
                if i + k <= len(w) and tuple(w[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    found |= {str(x) for x in windows[tuple(w[i : i + k])] if x is not None}
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return sorted(out, key=str)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (10, "Q: short item?"), (2, "one two three four five six seven eight nine ten"), (3, ""), (4, None), (None, "nobody counts this one"), (5, "répété répété répété " * 5), (5, "Q: short item?")]
DOCS = [
    (1, "Before: One, two three-four five six seven eight nine TEN eleven after"),
    (2, "one two three four five six seven eight nine and no ten"),
    (3, "a q short item and again q, SHORT item"),
    (4, None),
    (5, ""),
    (6, " .,- "),
    (7, "nobody counts this one"),
    (8, "répété " * 40),
    (8, "RéPéTé " * 40),
    (9, "q short item q short item q short item"),
    (9, "q short item q short item q short item"),
    (None, "x one two three four five six seven eight nine ten eleven"),
    (11, "filler word " * 20_000 + "one two three four five six seven eight nine ten"),
]


def decided(docs, items):
    return sorted((tuple(r)[:1] + tuple(r)[2:6] for r in decontaminate.decisions(docs, items).collect()), key=str)


def frames(spark, docs=DOCS, items=ITEMS):
    more = {"words": F.lit("w"), "digest": F.lit("d"), "hits": F.lit(1), "spans": F.lit(2)}
    return spark.createDataFrame(docs, "doc_id long, text string").withColumns(more).repartition(3), spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit(1))


@pytest.mark.parametrize("limit", [None, 200])
def test_decontamination_equals_brute_force_in_one_part_and_in_several(spark, monkeypatch, limit):
    if limit:
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    assert decided(*frames(spark)) == plain_hits(DOCS, ITEMS)


def test_decontamination_of_empty_tables(spark):
    docs, items = frames(spark)
    assert decided(docs, items.limit(0)) == plain_hits(DOCS, [])
    assert decided(docs.limit(0), items) == []


def test_decontamination_drops_documents_or_spans(spark):
    docs, items = frames(spark)
    hit = {r.doc_id for r in decontaminate.decisions(docs, items).where("n_hit > 0").collect()}
    whole = decontaminate.clean(docs, items, whole=True)
    assert whole.columns == docs.columns
    assert {r.doc_id for r in whole.collect()} == {d for d, _ in DOCS} - hit
    cleaned = decontaminate.clean(docs, items)
    assert cleaned.columns == docs.columns
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    assert cleaned.count() == len(DOCS)
    assert texts[1] == "Before after"
    assert texts[2] == DOCS[1][1] and texts[4] is None and texts[6] == " .,- "
    assert texts[3] == "a and again" and texts[7] == ""
    assert {r.words for r in cleaned.collect()} == {"w"}


def test_no_python_runs_in_decontamination(spark):
    docs, items = frames(spark)
    assert not re.search("Python|Pandas|Arrow", decontaminate.decisions(docs, items)._jdf.queryExecution().executedPlan().toString())
