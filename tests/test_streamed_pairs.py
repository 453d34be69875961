"""Streamed follow-up pairs against the batch: shuffled arrival, restarts, late turns and the end of state."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from convolens.operators import turns as batch
from convolens.streaming import pairs

SCHEMA = "conv_id long, turn long, role string, text string, ts timestamp"
START = datetime(2026, 1, 1)


def log(rng, conversations=30):
    rows = []
    for conv in range(conversations):
        at = START + timedelta(minutes=rng.randrange(60))
        for turn in range(rng.randrange(2, 9)):
            at += timedelta(minutes=rng.randrange(1, 20))
            if rng.random() < 0.9:  # else a gap
                rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", None if rng.random() < 0.1 else f"c{conv}t{turn}", at))
                if rng.random() < 0.2:
                    rows.append(rows[-1])
    return rows


def run(spark, root, batches, late="1 hour", keep=24 * 60):
    """Writes each batch as a file and lets the query read what is there; every call goes on from the checkpoint."""
    seen = []
    for rows in batches:
        n = len(list((root / "in").glob("*.json"))) if (root / "in").exists() else 0
        frame = spark.createDataFrame(rows, SCHEMA).coalesce(1)
        frame.write.mode("append").json(str(root / "in"))
        stream = spark.readStream.schema(SCHEMA).json(str(root / "in"))
        query = pairs.pairs(stream, late=late, keep_minutes=keep).writeStream.format("parquet").option("path", str(root / "out")).option("checkpointLocation", str(root / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
        seen.append([p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]])
        assert n < len(list((root / "in").glob("*.json")))
    found = spark.read.schema(pairs.OUT).parquet(str(root / "out")).where("conv_id >= 0")
    return Counter(tuple(r) for r in found.collect()), seen


def of_batch(spark, rows):
    return Counter(tuple(r) for r in batch.pairs(spark.createDataFrame(rows, SCHEMA)).collect())


def end(hours=100):
    """A turn of another conversation that moves the watermark beyond every other."""
    return [(-1, 0, "system", "end", START + timedelta(hours=hours))]


def test_shuffled_arrival_gives_the_pairs_of_the_batch_over_restarts(spark, tmp_path):
    rng = random.Random(4)
    rows = log(rng)
    expected = of_batch(spark, rows)
    assert sum(expected.values()) > 10 and max(expected.values()) > 1
    shuffled = sorted(rows, key=lambda r: r[4] + timedelta(minutes=rng.randrange(-100, 100)))
    cuts = [shuffled[i : i + len(rows) // 3 + 1] for i in range(0, len(rows), len(rows) // 3 + 1)]
    # each part is a run of its own, which goes on from the checkpoint of the one before
    got, seen = run(spark, tmp_path, [*cuts, end()], late="4 hours")
    assert got == expected
    assert max(x["numRowsTotal"] for run_ in seen for x in run_) > 0


def test_state_ends_and_late_turns_are_counted(spark, tmp_path):
    minute = lambda m: START + timedelta(minutes=m)
    first = [(1, 1, "assistant", "a1", minute(0)), (2, 1, "assistant", "a1", minute(1)), (5, 2, "user", "early", minute(3))]
    later = [(1, 2, "user", "q2", minute(300))]
    too_late = [(5, 1, "assistant", "late", minute(2))]
    got, seen = run(spark, tmp_path, [first, later, too_late, end(1000), end(2000)], late="10 minutes", keep=60)
    assert got == Counter()  # one question came five hours after its answer, which was kept for one; one answer came too late
    assert sum(x["numRowsDroppedByWatermark"] for run_ in seen for x in run_) == 1
    assert seen[-1][-1]["numRowsTotal"] <= 4  # what the marker's own conversation holds is all that is left


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_ties_are_decided_alike_in_any_order(spark, tmp_path, order):
    ties = [(1, 1, "assistant", "a", START), (1, 1, "assistant", "b", START)]
    got, _ = run(spark, tmp_path, [[ties[i] for i in order], [(1, 2, "user", "q", START + timedelta(minutes=1)), (1, None, "user", "none", START), (2, 2, "user", "no time", None)], end()])
    assert got == Counter([(1, 2, "q", "b")])


def test_a_null_text_is_a_question_too(spark, tmp_path):
    got, _ = run(spark, tmp_path, [[(1, 1, "assistant", None, START), (1, 2, "user", None, START)], end()])
    assert got == Counter([(1, 2, None, None)])
