"""The store of answers: interrupted writes, runs side by side, compaction; counts taken while writing; table function; pivots."""

import threading

import pytest
from pyspark.sql import functions as F

from convolens.functions import evidence
from convolens.operators import crosstab, observed, selection
from convolens.plans import answers, judging


def counting(folder, wait=0.0):
    """A judge that notes every prompt in a folder that its workers share."""
    folder = str(folder)

    class Counting:
        name = "counting"

        def complete(self, system, user, *more, **options):
            import time
            import uuid
            from pathlib import Path

            from convolens.plans import judging

            Path(folder, uuid.uuid4().hex).write_text(user)
            time.sleep(wait)
            return judging.StubJudge({"observe": {"": {}}}).complete(system, user, *more, **options)

    return Counting()


def cases(spark, n):
    return spark.range(n).select(F.concat(F.lit("c"), "id").alias("case_id"), F.array().cast("array<string>").alias("pre_queries"), F.lit("a").alias("llm_ans_on_last_q"), (F.col("id") % 5).cast("string").alias("current_query"))


def test_a_write_that_was_cut_off_is_not_read_and_a_complete_one_is(spark, tmp_path):
    store, asked = str(tmp_path / "store"), tmp_path / "asked"
    asked.mkdir()
    judge = counting(asked)
    first = judging.ask(cases(spark, 20), "observe", judge, store)
    assert first.where("observe_reply.answer is not null").count() == 20 and len(list(asked.iterdir())) == 5
    (folder,) = answers.committed(spark, store)
    # the run ended right behind its write: the next one asks nothing
    assert judging.ask(cases(spark, 20), "observe", judge, store).count() == 20 and len(list(asked.iterdir())) == 5
    # a folder without its mark is as if it were not there
    (tmp_path / "store" / folder.rsplit("/", 1)[1] / "_SUCCESS").unlink()
    assert answers.read(spark, store).count() == 0
    judging.ask(cases(spark, 20), "observe", judge, store)
    assert len(list(asked.iterdir())) == 10


def test_runs_side_by_side_ask_once_and_compaction_keeps_one_answer(spark, tmp_path):
    store, asked = str(tmp_path / "store"), tmp_path / "asked"
    asked.mkdir()
    runs = [threading.Thread(target=lambda: judging.ask(cases(spark, 20), "observe", counting(asked, 0.05), store).count()) for _ in range(3)]
    for run in runs:
        run.start()
    for run in runs:
        run.join()
    assert len(list(asked.iterdir())) == 5
    before = sorted(map(tuple, answers.read(spark, store).collect()))
    answers.add(spark.createDataFrame([before[0], ("observe", "failed", None, "[observe] x", 0, 0)], answers.ANSWERS), store)
    assert answers.compact(spark, store) == 4 and len(answers.committed(spark, store)) == 1
    assert sorted(map(tuple, answers.read(spark, store).collect())) == before
    assert answers.compact(spark, store) == 0 and answers.compact(spark, str(tmp_path / "none")) == 0


def test_a_claim_of_a_dead_run_is_taken_over(spark, tmp_path):
    store = str(tmp_path)
    (tmp_path / "claim-observe").write_text("")
    with answers.claim(spark, store, "observe", stale=-1, wait=0.01):
        assert (tmp_path / "claim-observe").exists()
    assert not (tmp_path / "claim-observe").exists()


def test_counts_are_taken_in_the_pass_that_writes(spark, tmp_path):
    rows = spark.range(1000).withColumn("v", F.when(F.col("id") % 10 != 0, F.col("id") % 7))
    wanted = {"low": F.col("v") < 4, "even": F.col("id") % 2 == 0}
    kept, seen = observed.filtered(rows, wanted)
    kept.write.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, observed.steps(spark, seen, wanted).collect())) == sorted(map(tuple, selection.steps(rows, wanted).collect()))
    done = spark.createDataFrame([("x", None, 2), (None, "[observe] bad", 1), (None, "other", 0)], "classification string, error string, llm_calls long")
    out, counts = observed.outcome(done, judging.STAGES)
    assert out.count() == 3
    assert {k: counts.get[k] for k in ("n", "n_classified", "n_failed", "failed_observe", "failed_grounding", "llm_calls")} == {"n": 3, "n_classified": 1, "n_failed": 2, "failed_observe": 1, "failed_grounding": 0, "llm_calls": 3}


def test_evidence_rows_for_texts_and_lists(spark):
    evidence.register(spark)
    spark.createDataFrame([(1, ["abcdefghij", None], ["xxabcdefghiyy", None, "j"]), (2, None, ["a"]), (3, ["a"], None)], "id long, q array<string>, p array<string>").createOrReplaceTempView("quoted")
    got = [tuple(r) for r in spark.sql("SELECT id, e.* FROM quoted, LATERAL evidence(q, p) e").collect()]
    assert got == [
        (1, 0, "abcdefghij", 0, 9, "abcdefghi", 0.9, True), (1, 0, "abcdefghij", 1, 0, "", 0.0, False), (1, 0, "abcdefghij", 2, 1, "j", 0.1, False),
        (1, 1, None, 0, 0, "", 0.0, False), (1, 1, None, 1, 0, "", 0.0, False), (1, 1, None, 2, 0, "", 0.0, False),
    ]
    assert spark.sql("SELECT e.* FROM quoted, LATERAL evidence(q, 'abc', 0.05) e").columns == ["quote_no", "quote", "length", "part", "ratio", "kept"]


@pytest.mark.parametrize("rows", [[("a", "x"), ("a", "y"), ("b", "x"), (None, "z"), ("a", None)], []])
def test_pivot_and_shares_with_nulls_and_empty(spark, rows):
    frame = spark.createDataFrame(rows, "axis string, label string")
    table = [tuple(r) for r in crosstab.pivot(frame, "axis", "label", ["y", "x"]).collect()]
    cells = {(r.axis, r.label, r.level): (r.n, round(r.share, 3)) for r in crosstab.shares(frame, "axis", "label").collect()}
    if rows:
        assert table == [("■ 전체", 1, 2, 2, 5), ("a", 1, 1, 1, 3), (None, 0, 0, 1, 1), ("b", 0, 1, 0, 1)]
        assert cells["a", "x", 0] == (1, 0.333) and cells[None, "z", 0] == (1, 1.0) and cells["a", None, 1] == (3, 0.6) and cells[None, None, 3] == (5, 1.0)
    else:
        assert table == [("■ 전체", 0, 0, 0, 0)]
