"""Suffix automaton, quantile selection, ranks over ranges and changed answers against plain versions."""

import math
import random
from collections import Counter, defaultdict
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from convolens.functions import citations
from convolens.operators import consistency, profile, ranks


def test_longest_common_part_equals_difflib():
    draw = random.Random(1)
    for _ in range(400):
        a, b = ("".join(draw.choice("abc☃") for _ in range(draw.randrange(30))) for _ in range(2))
        assert citations.longest_common(a, b) == SequenceMatcher(None, a, b, autojunk=False).find_longest_match().size


def test_ratios_of_dropped_quotes_and_complaints(spark):
    passages = ["theapprovaloftwomanagersisneeded", "another passage"]
    quotes = [(0, "approval of two managers"), (1, "approval of two managers"), (0, "approval of six managers"), (5, "two"), (0, None)]
    row = spark.createDataFrame([(passages, quotes)], f"p array<string>, e {citations.EVIDENCE}").select(citations.verify(F.col("e"), F.col("p")).alias("c"), citations.verify_complaint(F.lit("approval of six managers"), F.lit("the approval of two managers")).alias("v")).first()
    assert [(c.chunk_index, round(c.ratio, 3), c.index_corrected, c.reason) for c in row.c] == [(0, 1.0, False, None), (0, 1.0, True, None), (0, round(10 / 21, 3), False, "not_found"), (5, 1.0, False, "too_short"), (0, 0.0, False, "too_short")]
    assert (round(row.v.ratio, 3), row.v.verified) == (round(10 / 21, 3), False)
    none = spark.createDataFrame([(None, None), ([], [])], f"p array<string>, e {citations.EVIDENCE}").select(citations.verify(F.col("e"), F.col("p")).alias("c")).collect()
    assert [r.c for r in none] == [[], []]


def plain_profile(values):
    known = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    n = len(known)
    return [n, len(values) - n, known[0], *[known[min(n - 1, int(n * p))] for p in profile.QUANTILES], known[-1]]


def test_quantiles_of_hot_keys_are_selected(spark):
    draw = random.Random(2)
    rows = [("hot", draw.choice([draw.random(), 10.0 ** draw.randrange(-300, 300), -draw.random() * 1e308, 5.0, None])) for _ in range(3000)]
    rows += [(None, draw.gauss(0, 1e-9) + 7) for _ in range(1500)] + [("nan", draw.choice([float("nan"), draw.random()])) for _ in range(900)]
    rows += [("small", 1.0), ("small", None)]
    by = defaultdict(list)
    for k, v in rows:
        by[k].append(v)
    frame = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r[0]: list(r)[1:] for r in profile.numeric_profile(frame, "k", "v", hot=200).collect()}
    assert {k: list(map(repr, v)) for k, v in got.items()} == {k: list(map(repr, plain_profile(v))) for k, v in by.items()}
    only_null = spark.createDataFrame([("x", None)], "k string, v double")
    assert [tuple(r) for r in profile.numeric_profile(only_null, "k", "v", hot=0).collect()] == [("x", 0, 1, None, None, None, None, None, None)]


def test_ranks_over_many_labels_need_no_window_over_all(spark):
    counts = spark.range(200_000).select((F.col("id") % 997 + 1).alias("n"), F.concat(F.lit("l"), "id").alias("label"))
    got = ranks.ranked(counts, [F.desc("n"), F.col("label")])
    assert "SinglePartition" not in "".join(x for x in got._jdf.queryExecution().executedPlan().toString().split("\n") if "Window" in x)
    total = sum(i % 997 + 1 for i in range(200_000))
    expected = sorted(((-(i % 997 + 1), f"l{i}") for i in range(200_000)))
    sums, run = {}, 0
    for i, (n, label) in enumerate(expected):
        run -= n
        if i % 9973 == 0:
            sums[i + 1] = (label, run)
    found = {r.rank: (r.label, r.upto) for r in got.where((F.col("rank") - 1) % 9973 == 0).collect()}
    assert found == sums and got.first().total == total and got.select("rank").distinct().count() == 200_000
    assert ranks.ranked(counts.limit(0), [F.desc("n"), F.col("label")]).count() == 0


@pytest.mark.parametrize("hot", [False, True])
def test_changed_answers_against_plain(spark, hot):
    draw = random.Random(3)
    rows = [(draw.randrange(8), t, "hi" if hot and draw.random() < 0.5 else f"q{draw.randrange(12)}", draw.choice(["a", "b", "c", "", None])) for t in range(300)]
    rows += [(100, 1, "own", "x"), (100, 2, "own", "y"), (101, 1, "same", "x"), (102, 1, "same", "x"), (rows[0])]
    by = defaultdict(list)
    for conv, t, q, a in rows:
        if a:
            by[q].append((conv, t, a))
    expected = []
    for q, given in by.items():
        n = Counter(a for *_, a in given)
        convs = len({c for c, *_ in given})
        if len(n) > 1 and convs > 1:
            for conv, t, a in given:
                other = min((x for x in n if x != a), key=lambda x: (-n[x], x))
                place = min((c, u) for c, u, x in given if x == other)
                expected.append((conv, t, q, a, n[a], other, n[other], *place, len(n), convs))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, question string, answer string")
    assert sorted(tuple(r) for r in consistency.changed_answers(frame, F.col("question"), F.col("answer")).collect()) == sorted(expected)
