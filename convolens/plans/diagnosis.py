"""The older run: what the user still needs, whether the passages hold it, whether the answer used them, one label a case."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convolens.operators.stages import settle
from convolens.plans import classify

#: Complaints about content, which passages can settle; fixed values.
CONTENT = ("content_gap", "wrong_content")
STEPS = ("need", "sufficiency", "grounding")
#: Labels that ask for more documents; fixed values.
LACKING = ("rag_insufficient", "rag_partial")


def diagnose(cases: DataFrame, judge, cache: str | None = None) -> DataFrame:
    """cases with need, judgment, citation, grounding, label, n_chunks, error and the calls and tokens spent.

    Only complaints about content go on to the passages, and only sufficient verdicts with a kept quote to the answer.
    A case without passages is asked like any other. An error of one step is the case's result: it has no label.
    """
    rows = classify._step(settle(cases), F.lit(True), "need", judge, cache).withColumn("obs", F.col("need_reply.answer"))
    rows = classify._step(rows, F.col("obs.complaint_type").isin(*CONTENT), "sufficiency", judge, cache)
    rows = classify.grounded(rows.withColumn("judgment", F.col("sufficiency_reply.answer")), judge, cache)
    rows = rows.withColumn("error", F.coalesce(*[F.col(f"{s}_reply.error") for s in STEPS]))
    label = classify.decide(F.col("judgment.verdict"), F.col("n_kept"), F.col("grounding"), F.col("obs.complaint_type"))
    spent = lambda field: sum([F.coalesce(F.col(f"{s}_reply.{field}").cast("long"), F.lit(0)) for s in STEPS], F.lit(0).cast("long")).alias(field)
    return rows.select(
        *cases.columns, F.col("obs").alias("need"), "judgment", "citation", "grounding", F.when(F.col("error").isNull(), label).alias("label"),
        F.greatest(F.size("rag_chunks"), F.lit(0)).cast("long").alias("n_chunks"), "error", spent("called").alias("llm_calls"), spent("tokens_in"), spent("tokens_out"),
    )


def lacking(diagnosed: DataFrame, by: str = "dept") -> DataFrame:
    """The cases that ask for more documents: by, case_id, label, unmet need and what is missing, in the order of `by`."""
    rows = diagnosed.where(F.col("label").isin(*LACKING))
    return rows.select(by, "case_id", "label", F.col("need.unmet_need").alias("unmet_need"), F.col("judgment.missing").alias("missing")).orderBy(by, "case_id")
