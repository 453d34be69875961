"""From cases to classified turns: checks, three conditional judge steps, verified citations, routing, errors as data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convolens.functions import answer_checks, citations
from convolens.operators.stages import settle
from convolens.plans import judging, routing

#: Complaints about content, which passages can settle; fixed values.
CONTENT = ("content_missing", "content_wrong")
#: The judge's steps of a classification in order.
STEPS = ("observe", "sufficiency", "grounding")


def _reply(stage: str):
    return F.lit(None).cast(f"struct<answer:{judging.spark_type(judging.STAGES[stage]).simpleString()},error:string,called:boolean,tokens_in:bigint,tokens_out:bigint>").alias(f"{stage}_reply")


def _step(rows: DataFrame, wanted, stage: str, judge, cache: str | None) -> DataFrame:
    """rows with the stage's reply; only the wanted rows go to the judge, the others get none."""
    wanted = F.coalesce(wanted, F.lit(False))
    rest = rows.where(~wanted).select("*", _reply(stage))
    return settle(judging.ask(rows.where(wanted), stage, judge, cache).unionByName(rest))


def classify(cases: DataFrame, judge, cache: str | None = None) -> DataFrame:
    """cases with obs, checks (map), citation, complaint, judgment, grounding, classification, error, llm_calls, tokens.

    A service's outage message ends a case before any call. An error of one step ends its case with that error. What
    a step's judge said is checkpointed, so no call is made again for a lost executor or a later use of the result.
    """
    rows = settle(cases).withColumn("service_error", answer_checks.service_error_check(F.col("llm_ans_on_last_q")))
    rows = _step(rows, F.col("service_error.verdict") != "violated", "observe", judge, cache).withColumn("obs", F.col("observe_reply.answer"))
    content = (F.col("obs.question_domain") == "domain") & F.col("obs.complaint_target").isin(*CONTENT)
    has_passages = F.size("rag_chunks") > 0
    rows = _step(rows, content & has_passages, "sufficiency", judge, cache)
    # without a passage there is nothing to ask and nothing to cite
    empty = F.struct(F.lit("no passage was retrieved").alias("reasoning"), F.array().cast(citations.EVIDENCE).alias("evidence"), F.lit("insufficient").alias("verdict"), F.col("obs.unmet_need").alias("missing"))
    rows = rows.withColumn("judgment", F.when(content & ~has_passages, empty).otherwise(F.col("sufficiency_reply.answer")))
    rows = grounded(rows, judge, cache)
    rows = rows.withColumn("error", F.coalesce(*[F.col(f"{s}_reply.error") for s in STEPS]))
    rows = rows.withColumn("complaint", F.when(F.col("obs.complaint_target") == "none", citations.verify_complaint(answer_checks.nfkc(F.col("obs.complaint_quote")), answer_checks.nfkc(F.col("current_query")))))
    rows = _with_checks(rows)
    return settle(_routed(rows))


def grounded(rows: DataFrame, judge, cache: str | None) -> DataFrame:
    """rows with citation (the judgment's quotes verified), n_kept, and the grounding of sufficient verdicts with a kept quote."""
    folded = rows.withColumns({"__passages": _compared("rag_chunks"), "__evidence": _compared_quotes()})
    checked = citations.verify(F.col("__evidence"), F.col("__passages"))
    # quotes are given back as the judge wrote them
    as_written = F.zip_with("citation", F.col("judgment.evidence"), lambda c, e: c.withField("quote", e["quote"]))
    rows = folded.withColumn("citation", F.when(F.col("judgment").isNotNull(), checked)).withColumn("citation", as_written).drop("__passages", "__evidence")
    rows = rows.withColumn("n_kept", F.when(F.col("citation").isNotNull(), F.size(citations.kept(F.col("citation"))).cast("long")))
    return _step(rows, (F.col("judgment.verdict") == "sufficient") & (F.col("n_kept") > 0), "grounding", judge, cache).withColumn("grounding", F.col("grounding_reply.answer.answer_used_rag"))


def _compared(name: str):
    """A list of texts in compared form: NFKC of the joined list in one call."""
    return F.when(F.size(name) > 0, F.transform(F.split(answer_checks.nfkc(F.array_join(name, "\x00")), "\x00"), lambda c: F.lower(answer_checks.squeeze(c)))).otherwise(F.array().cast("array<string>"))


def _compared_quotes():
    evidence = F.col("judgment.evidence")
    plain = F.split(answer_checks.nfkc(F.array_join(F.transform(evidence, lambda e: F.coalesce(e["quote"], F.lit(""))), "\x00")), "\x00")
    return F.when(F.size(evidence) > 0, F.zip_with(evidence, plain, lambda e, q: F.struct(e["chunk_index"].alias("chunk_index"), q.alias("quote")))).otherwise(F.array().cast(citations.EVIDENCE))


def _with_checks(rows: DataFrame) -> DataFrame:
    answer, asked = F.col("llm_ans_on_last_q"), F.try_element_at("pre_queries", F.lit(-1))
    rows = rows.withColumns({"__answer": answer_checks.nfkc(answer), "__chunks": F.when(F.size("rag_chunks") > 0, F.split(answer_checks.nfkc(F.array_join("rag_chunks", "\x00")), "\x00")).otherwise(F.col("rag_chunks"))})
    found = answer_checks.run_all(answer, asked, F.col("rag_chunks"), F.col("obs.requested_language"), F.col("obs.requested_format"), F.col("obs.requested_length_kind"))
    found |= {"quoted_spans": answer_checks.quoted_check(F.col("__answer"), F.col("__chunks")), "injection": answer_checks.injection_check(F.col("__chunks"), F.col("__answer")), "service_error": F.col("service_error")}
    # a case that ended before the observation has the check that ended it and no other
    rows = rows.withColumns({f"__{name}": F.when(F.col("obs").isNotNull() | F.lit(name == "service_error"), check) for name, check in found.items()})
    entries = F.filter(F.array(*[F.struct(F.lit(name).alias("key"), F.col(f"__{name}").alias("value")) for name in found]), lambda e: e["value"].isNotNull())
    return rows.withColumn("checks", F.map_from_entries(entries)).drop("__answer", "__chunks", "service_error", *[f"__{name}" for name in found])


def _routed(rows: DataFrame) -> DataFrame:
    verdict = {name: F.try_element_at("checks", F.lit(name))["verdict"].alias(name) for name in routing.CHECKS}
    obs = {"answer_refused": "answer_refused", "unsupported_output": "requests_unsupported_output", "answerable": "question_answerable_as_asked", "self_contained": "question_self_contained", "multi_intent": "question_multi_intent", "multi_covered": "answer_covers_all_intents", "actionable": "answer_actionable", "target": "complaint_target", "domain": "question_domain"}
    inputs = rows.select(
        F.struct("*").alias("row"), *verdict.values(), *[F.col(f"obs.{v}").alias(k) for k, v in obs.items()], (F.col("obs.answer_used_history") == "ignored").alias("history_ignored"),
        (~F.col("complaint.verified")).alias("complaint_unverified"), F.col("judgment.verdict").alias("verdict"), F.col("grounding").alias("grounding"), "n_kept", F.size("rag_chunks").cast("long").alias("n_chunks"),
    )
    routed = routing.route(inputs)
    called = lambda field, zero: sum([F.coalesce(F.col(f"row.{s}_reply.{field}").cast("long"), F.lit(zero)) for s in STEPS], F.lit(0))
    keep = [F.col(f"row.{c}") for c in rows.columns if not c.endswith("_reply") and c != "n_kept"]
    done = F.col("row.error").isNull()
    return routed.select(
        *keep, F.when(done, F.struct(F.col("case").alias("case_id"), "confidence", "secondary")).alias("classification"),
        called("called", 0).alias("llm_calls"), called("tokens_in", 0).alias("tokens_in"), called("tokens_out", 0).alias("tokens_out"),
    )


def decide(judgment_verdict, n_kept, grounding, complaint):
    """The older truth table over complaint type, sufficiency and grounding; `error` where a needed judgment is missing."""
    effective = F.when(judgment_verdict.isin("sufficient", "partial") & (F.coalesce(n_kept, F.lit(0)) == 0), "insufficient").otherwise(judgment_verdict)
    return (
        F.when(complaint == "format_or_style", "out_of_scope")
        .when(complaint == "other", routing.UNCLASSIFIED)
        .when(judgment_verdict.isNull(), "error")
        .when(effective == "insufficient", "rag_insufficient")
        .when(effective == "partial", "rag_partial")
        .when(grounding.isNull(), "error")
        .when(grounding.isin("ignored", "contradicted"), "rag_sufficient_generation_failed")
        .otherwise("rag_sufficient_other")
    )
