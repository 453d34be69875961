"""Queries that run the engine from end to end over `conversations`, with independently written DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from convolens.functions import answer_checks as checks
from convolens.operators import contracts, crosstab, output, turns
from convolens.operators.stages import settle
from convolens.plans import catalogue, classify, diagnosis, judging


def _t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def length_check(spark, sf_dir):
    kind = F.get(F.array(*map(F.lit, checks.LENGTH_KINDS)), (F.col("doc_id") % 5).cast("int"))
    return _t(spark, sf_dir, "documents").select("doc_id", checks.length_check(F.col("text"), kind)["verdict"].alias("verdict"))


def engine_cases(spark, sf_dir):
    """Follow-ups as cases through checks, the stub judge and routing; the judge reads every complaint as wrong common knowledge."""
    rows = turns.pairs(_t(spark, sf_dir, "conversations")).select(
        F.concat_ws(":", "conv_id", "turn", F.xxhash64("question", "answer").cast("string")).alias("case_id"), F.col("conv_id").cast("string").alias("conversation_id"), "turn",
        F.array().cast("array<string>").alias("pre_queries"), F.col("answer").alias("llm_ans_on_last_q"), F.col("question").alias("current_query"), F.array().cast("array<string>").alias("rag_chunks"),
    ).na.fill("", ["llm_ans_on_last_q", "current_query"])
    told = {"complaint_target": "content_wrong", "question_domain": "general_knowledge", "question_self_contained": True, "question_answerable_as_asked": True, "answer_covers_all_intents": True}
    done = classify.classify(rows, judging.StubJudge({"observe": {"": told}}))
    cases = done.groupBy(F.col("classification.case_id").alias("case_id"), F.col("classification.confidence").alias("confidence"))
    return cases.agg(F.count(F.lit(1)).alias("n"), F.count("error").alias("errors"))


def engine_totals(spark, sf_dir):
    """One row of totals of a run in which the judge fails for every follow-up of an even turn."""
    rows = _t(spark, sf_dir, "conversations").where("role = 'user'").select(
        F.concat_ws(":", "conv_id", "turn").alias("case_id"), "turn", F.array().cast("array<string>").alias("pre_queries"), F.lit("Done.").alias("llm_ans_on_last_q"),
        F.concat(F.col("conv_id").cast("string"), F.when(F.col("turn") % 2 == 0, " FAILS ").otherwise(" "), F.col("turn").cast("string")).alias("current_query"), F.array().cast("array<string>").alias("rag_chunks"),
    )
    done = classify.classify(rows, judging.StubJudge({"observe": {"FAILS": {"fail": "no connection"}}}))
    return output.totals(done).select("n", "n_classified", "n_failed", "llm_calls")


def contract_report(spark, sf_dir):
    """Conversations written as logs, against the declared fields."""
    turn = F.struct("turn", F.col("text").alias("user_question"), F.col("role").alias("llm_response"), F.col("turn").cast("string").alias("llm_eval_score"), F.lit(1).alias("extra"))
    convs = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(turn).alias("turns"))
    user = F.struct(F.array(F.struct("turns")).alias("conversations"), F.col("conv_id").cast("string").alias("user_id"))
    found = contracts.report(convs.select(F.to_json(F.struct(F.array(user).alias("users"))).alias("value")))
    return found.select("layer", "field", "kind", "n", "rows", "note")


#: What the stub judge says of a reaction, a need, a passage or an answer that holds the word.
_NEEDS = {
    "need": {
        "KIND0": {"complaint_type": "format_or_style"}, "KIND1": {"complaint_type": "other"}, "KIND2": {"unmet_need": "NOTHING"}, "KIND3": {"unmet_need": "HALF"}, "KIND4": {"unmet_need": "ALL"},
        "KIND5": {"unmet_need": "CLAIMED"}, "KIND6": {"fail": "no connection"},
    },
    "sufficiency": {
        "NOTHING": {"verdict": "insufficient"}, "HALF": {"verdict": "partial", "evidence": [{"chunk_index": 0, "quote": "approval of two managers"}]},
        "ALL": {"verdict": "sufficient", "evidence": [{"chunk_index": 1, "quote": "approval of two managers"}]}, "CLAIMED": {"verdict": "sufficient", "evidence": [{"chunk_index": 0, "quote": "words that no passage has"}]},
    },
    "grounding": {"PASSED BY": {"answer_used_rag": "ignored"}},
}


def _diagnosed(spark, sf_dir):
    """Follow-ups with two passages each, the reaction's kind by the length of the answer; answers in even turns pass the passages by."""
    size, even = F.length(F.coalesce("answer", F.lit(""))), F.col("turn") % 2 == 0
    rows = turns.pairs(_t(spark, sf_dir, "conversations")).select(
        F.concat_ws(":", "conv_id", "turn").alias("case_id"), F.concat(F.lit("dept"), F.col("conv_id") % 4).alias("dept"), F.array().cast("array<string>").alias("pre_queries"),
        F.concat_ws(" ", "answer", F.when(even, "PASSED BY")).alias("llm_ans_on_last_q"), F.concat(F.coalesce("question", F.lit("")), F.lit(" KIND"), (size % 7).cast("string")).alias("current_query"),
        F.array(F.concat_ws(" ", "answer", F.lit("needs the approval of two managers")), F.coalesce("question", F.lit(""))).alias("rag_chunks"),
    )
    return settle(diagnosis.diagnose(rows, judging.StubJudge(_NEEDS)).select("case_id", "dept", "need", "judgment", F.coalesce("label", F.lit("error")).alias("label")))


def diagnosis_shares(spark, sf_dir):
    """Labels of the older run by department: counts, row shares, margins."""
    return crosstab.shares(_diagnosed(spark, sf_dir), "dept", "label")


def diagnosis_lacking(spark, sf_dir):
    """The cases of the older run that ask for more documents."""
    return diagnosis.lacking(_diagnosed(spark, sf_dir)).select("dept", "case_id", "label", "unmet_need")


QUERIES = {f.__name__: f for f in (length_check, engine_cases, engine_totals, contract_report, diagnosis_shares, diagnosis_lacking)}

_ABSENT = {name: [f.name for f in fields] for name, fields in contracts.LAYERS.items()}
_HELD = {"user": ["user_id"], "conversation": ["turns"], "turn": ["turn", "user_question", "llm_response", "llm_eval_score"]}
_MISSING = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{name}' AS field, 'missing' AS kind, n, n AS rows, '' AS note FROM {'t' if layer == 'turn' else 'c'}"
    for layer, names in _ABSENT.items()
    for name in names
    if name not in _HELD[layer]
)

_LABELS = f"""
    SELECT 'dept' || (conv_id % 4) AS dept, concat_ws(':', conv_id, turn) AS case_id, length(coalesce(answer, '')) % 7 AS kind, CASE length(coalesce(answer, '')) % 7
        WHEN 0 THEN 'out_of_scope' WHEN 1 THEN 'unclassified' WHEN 2 THEN 'rag_insufficient' WHEN 3 THEN 'rag_partial' WHEN 5 THEN 'rag_insufficient' WHEN 6 THEN 'error'
        ELSE CASE WHEN turn % 2 = 0 THEN 'rag_sufficient_generation_failed' ELSE 'rag_sufficient_other' END END AS label
    FROM ({catalogue._PAIRS})
"""

ORACLE_SQL = {
    "diagnosis_shares": f"""
        WITH d AS ({_LABELS}), g AS (SELECT dept, label, count(*) AS n, CAST(grouping(dept, label) AS BIGINT) AS level FROM d GROUP BY GROUPING SETS ((dept, label), (dept), (label), ()))
        SELECT dept, label, n, CASE level WHEN 0 THEN n / sum(CASE level WHEN 0 THEN n END) OVER (PARTITION BY dept) ELSE n / (SELECT count(*) FROM d) END AS share, level FROM g
    """,
    "diagnosis_lacking": f"""
        SELECT dept, case_id, label, CASE kind WHEN 2 THEN 'NOTHING' WHEN 3 THEN 'HALF' ELSE 'CLAIMED' END AS unmet_need FROM ({_LABELS}) WHERE label IN ('rag_insufficient', 'rag_partial')
    """,
    "length_check": "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'na' ELSE 'undetermined' END AS verdict FROM documents",
    "engine_cases": f"""
        WITH p AS ({catalogue._PAIRS}), t AS ({catalogue._truncated("SELECT conv_id, turn, answer AS text FROM p", "conv_id")})
        SELECT CASE verdict WHEN 'violated' THEN 'case8' ELSE 'case25' END AS case_id, CASE verdict WHEN 'violated' THEN 'high' ELSE 'low' END AS confidence, count(*) AS n, 0::BIGINT AS errors FROM t GROUP BY ALL
    """,
    "engine_totals": """
        SELECT count(*) AS n, count(*) FILTER (turn % 2 = 1) AS n_classified, count(*) FILTER (turn % 2 = 0) AS n_failed, count(DISTINCT (conv_id, turn)) AS llm_calls
        FROM conversations WHERE role = 'user'
    """,
    "contract_report": f"""
        WITH t AS (SELECT count(*) AS n FROM conversations), c AS (SELECT count(DISTINCT conv_id) AS n FROM conversations)
        SELECT * FROM ({_MISSING}
        UNION ALL SELECT 'turn', 'turn', 'range', (SELECT count(*) FROM conversations WHERE turn < 1), n, '' FROM t
        UNION ALL SELECT 'turn', 'user_question', 'missing', (SELECT CASE WHEN count(text) = 0 THEN count(*) ELSE 0 END FROM conversations), n, '' FROM t
        UNION ALL SELECT 'turn', 'user_question', 'null', (SELECT count(*) FROM conversations WHERE text = ''), n, '' FROM t
        UNION ALL SELECT 'turn', 'llm_eval_score', 'type', n, n, 'str' FROM t
        UNION ALL SELECT 'turn', 'extra', 'unknown', n, n, '' FROM t) WHERE n > 0
    """,
}
