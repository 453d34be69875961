"""Routing of a checked complaint to a failure case: ordered rules as one CASE expression, and the taxonomy as a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNCLASSIFIED, OUTSIDE = "unclassified", "out_of_taxonomy"

#: Failure type of the case ranges, confidences that differ from medium, cases no rule can reach.
TYPES = {"TYPE0": (0, 0), "TYPE1": (1, 6), "TYPE2": (7, 9), "TYPE3": (10, 17), "TYPE4": (18, 19), "TYPE5": (20, 24), "TYPE6": (25, 27), "TYPE7": (28, 29)}
HIGH, LOW = (6, 8, 9, 10, 12, 21, 24, 26), (25,)
UNDIAGNOSABLE = (5, 7, 19, 23)
#: The complaint targets that a request check can settle, with their cases and checks.
REQUESTS = {"format": "case12", "language": "case10", "length": "case11"}

#: What a row needs: verdicts of the checks, what was observed of the follow-up, and what the judge found.
CHECKS = ("service_error", "injection", "truncated", "pii", "quoted_spans", "arithmetic", "dates", "format", "language", "length", "python_syntax", "sql_shape")
FLAGS = ("answer_refused", "unsupported_output", "answerable", "self_contained", "multi_intent", "multi_covered", "history_ignored", "complaint_unverified", "actionable")
VALUES = ("target", "domain", "verdict", "grounding", "n_kept", "n_chunks")


def taxonomy(spark: SparkSession) -> DataFrame:
    """case, type, confidence, diagnosable: 30 rows."""
    kind = {n: t for t, (a, b) in TYPES.items() for n in range(a, b + 1)}
    rows = [(f"case{n}", kind[n], "high" if n in HIGH else "low" if n in LOW else "medium", n not in UNDIAGNOSABLE) for n in sorted(kind)]
    return spark.createDataFrame(rows, "case string, type string, confidence string, diagnosable boolean")


def _is(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def _not(name: str) -> Column:
    """Whether the flag is known to be false."""
    return F.coalesce(~F.col(name), F.lit(False))


def _broken(name: str) -> Column:
    return F.coalesce(F.col(name) == "violated", F.lit(False))


def _domain() -> Column:
    """Cases of a complaint about what the passages should have told."""
    lacking = F.col("verdict").isin("insufficient", "partial") | (F.coalesce(F.col("n_kept"), F.lit(0)) == 0)
    return (
        F.when(F.col("verdict").isNull(), UNCLASSIFIED)
        .when(lacking, F.when(F.coalesce(F.col("n_chunks"), F.lit(-1)) == 0, "case21").otherwise("case20"))
        .when(F.col("grounding").isNull(), "case20")
        .when(F.col("grounding") == "ignored", "case22")
        .when(F.col("grounding") == "contradicted", "case18")
        .when((F.col("grounding") == "used") & ~_is("actionable"), "case17")
        .otherwise("case13")
    )


def _rules() -> list[tuple[Column, Column | str]]:
    target, domain = F.col("target"), F.col("domain")
    any_broken = reduce(lambda a, b: a | b, [_broken(c) for c in CHECKS])
    request = reduce(lambda acc, t: acc.when((target == t) & (F.col(t) == "ok"), "case13").when(target == t, REQUESTS[t]), list(REQUESTS), F.when(F.lit(False), ""))
    return [
        (_broken("service_error"), "case9"),
        (_is("answer_refused"), "case28"),
        (_broken("injection"), "case29"),
        ((target == "none") & (_is("complaint_unverified") | any_broken), UNCLASSIFIED),
        (target == "none", "case0"),
        (_is("unsupported_output"), "case2"),
        (_not("answerable"), "case1"),
        (_broken("truncated"), "case8"),
        (target == "no_answer", UNCLASSIFIED),
        (target.isin(*REQUESTS), request),
        (target == "tone", "case16"),
        (target == "inconsistency", UNCLASSIFIED),
        (domain == "general_knowledge", "case25"),
        (domain == "calculation", "case26"),
        (domain.isin("code", "tool_usage"), "case27"),
        (domain == "domain", _domain()),
        (_is("history_ignored"), "case14"),
        (_is("multi_intent") & ~_is("multi_covered"), "case15"),
        (target == "other", OUTSIDE),
    ]


def primary() -> Column:
    """The first rule that holds; unclassified if none does."""
    out = F.when(F.lit(False), "")
    for condition, case in _rules():
        out = out.when(F.coalesce(condition, F.lit(False)), case)
    return out.otherwise(UNCLASSIFIED)


def confidence(case: Column) -> Column:
    """The taxonomy's confidence, but for requests without evidence (medium) and sums by what the checks found; low outside."""
    target = F.col("target")
    kept = reduce(lambda acc, t: acc.when(target == t, F.col(t)), list(REQUESTS), F.when(F.lit(False), ""))
    unproven = target.isin(*REQUESTS) & case.isin(*REQUESTS.values()) & ~F.coalesce(kept == "violated", F.lit(False))
    sums = F.when(_broken("arithmetic") | _broken("dates"), "high").otherwise("medium")
    listed = F.when(case.isin(*[f"case{n}" for n in HIGH]), "high").when(case.isin(*[f"case{n}" for n in LOW]), "low").when(case.startswith("case"), "medium").otherwise("low")
    return F.when(F.coalesce(unproven, F.lit(False)), "medium").when(case == "case26", sums).otherwise(listed)


def secondary(case: Column) -> Column:
    """Further cases that also hold, in their fixed order, without the primary one."""
    target, domain = F.col("target"), F.col("domain")
    other = lambda t: _broken(t) & F.coalesce(target != t, F.lit(True))
    found = [
        (_not("self_contained"), "case4"), (_is("multi_intent"), "case3"), (_broken("pii"), "case6"), (_broken("quoted_spans"), "case24"),
        (_broken("arithmetic") | _broken("dates"), "case26"), (_is("history_ignored"), "case14"), (_is("multi_intent") & ~_is("multi_covered"), "case15"),
        (other("format"), "case12"), (other("language"), "case10"), (other("length"), "case11"),
        ((_broken("python_syntax") | _broken("sql_shape")) & ~F.coalesce(domain.isin("code", "tool_usage"), F.lit(False)), "case27"),
    ]
    return F.filter(F.array(*[F.when(condition, name) for condition, name in found]), lambda x: x.isNotNull() & (x != case))


def route(rows: DataFrame) -> DataFrame:
    """rows with case, confidence and secondary; missing columns of CHECKS, FLAGS and VALUES count as null."""
    for name in (*CHECKS, "target", "domain", "verdict", "grounding"):
        rows = rows if name in rows.columns else rows.withColumn(name, F.lit(None).cast("string"))
    for name in FLAGS:
        rows = rows if name in rows.columns else rows.withColumn(name, F.lit(None).cast("boolean"))
    for name in ("n_kept", "n_chunks"):
        rows = rows if name in rows.columns else rows.withColumn(name, F.lit(None).cast("long"))
    return rows.withColumn("case", primary()).withColumns({"confidence": confidence(F.col("case")), "secondary": secondary(F.col("case"))})
