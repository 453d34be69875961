"""Tables over classified turns: the flat frame, health, narrowing, ordered cross tables, review order, label agreement."""

from __future__ import annotations

import glob
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convolens.operators import crosstab as crosstabs
from convolens.plans import routing, taxonomy

#: Points of a turn in the review order: dropped quotes, low confidence, no case, further cases.
SUSPECT = {"dropped": 4, "low": 3, "unclassified": 2, "secondary": 1}
#: Fixed value: the order of the levels of confidence.
LEVELS = ("high", "medium", "low")


def newest(folder: str, pattern: str = "*.json") -> str | None:
    """The result whose name sorts last; names begin with their time."""
    found = sorted(glob.glob(os.path.join(folder, pattern)))
    return found[-1] if found else None


def flat(users: DataFrame) -> DataFrame:
    """One row per turn of a nested result; a failed turn has the case `error`, absent owners `-`."""
    convs = users.select(F.monotonically_increasing_id().alias("user_no"), F.struct("*").dropFields("conversations").alias("u"), F.posexplode("conversations").alias("conv_no", "c"))
    rows = convs.select("user_no", "u", "conv_no", "c.conversation_id", F.posexplode("c.turns").alias("turn_no", "t"))
    of = lambda c: F.coalesce(F.col(c), F.lit("-"))
    cls, evidence = "t.classification", "t.classification.evidence"
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    size = lambda c: F.coalesce(F.size(F.col(c)), F.lit(0)).cast("long")
    return rows.select(
        of("u.user_id").alias("user_id"), of("u.db_dept_name").alias("dept"), of("u.db_position_name").alias("position"), of("u.db_job_name").alias("job_name"), of("conversation_id").alias("conversation_id"), F.col("t.turn").alias("turn"),
        F.coalesce(F.col(f"{cls}.case_id"), F.lit("error")).alias("case_id"), text(f"{cls}.case_name").alias("case_name"), text(f"{cls}.type_id").alias("type_id"), text(f"{cls}.type_name").alias("type_name"), text(f"{cls}.confidence").alias("confidence"),
        F.coalesce(F.transform(f"{cls}.secondary_cases", lambda x: x["case_id"]), F.array().cast("array<string>")).alias("secondary"),
        text(f"{evidence}.observation.resolved_question").alias("question"), text(f"{evidence}.observation.unmet_need").alias("need"), text(f"{evidence}.observation.complaint_target").alias("target"), text(f"{evidence}.observation.question_domain").alias("domain"),
        text(f"{evidence}.sufficiency.verdict").alias("verdict"), text(f"{evidence}.sufficiency.missing").alias("missing"), size(f"{evidence}.sufficiency.evidence").alias("n_quotes"), size(f"{evidence}.sufficiency.dropped_evidence").alias("n_dropped"),
        text(f"{evidence}.grounding.answer_used_rag").alias("grounding"), F.coalesce(F.col(f"{cls}.llm_calls"), F.lit(0)).alias("llm_calls"), F.col("t.llm_ans_on_last_q").alias("answer"), F.col("t.current_query").alias("reaction"),
        F.struct("user_no", "conv_no", "turn_no").alias("log_place"),
    )


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    """The flat frame of a written result; schema: that of `output.nest`, so no pass is spent on guessing it."""
    return flat(spark.read.schema(schema).json(path))


def narrow(rows: DataFrame, chosen: dict[str, set[str] | None], hide_low: bool = False, search: str = "") -> DataFrame:
    """rows where every chosen column has one of its values. None does not narrow, an empty set leaves nothing."""
    for column, values in chosen.items():
        if values is not None:
            rows = rows.where(F.col(column).isin(*sorted(values)) if values else F.lit(False))
    if search:
        rows = rows.where(F.contains(F.lower(F.concat_ws("\n", "question", "need", "missing", "answer", "reaction")), F.lit(search.lower())))
    return rows.where("confidence <> 'low'") if hide_low else rows


def _no_case() -> Column:
    return F.col("case_id").isin(routing.UNCLASSIFIED, routing.OUTSIDE)


def is_failure() -> Column:
    return ~F.col("case_id").isin(*taxonomy.NO_FAILURE, "error")


def health(rows: DataFrame) -> DataFrame:
    """One row: turns, dropped quotes, and turns of low confidence, without a case, with an outage, without a failure, with their shares."""
    tests = {"low": F.col("confidence") == "low", "unclassified": _no_case(), "outage": F.col("case_id") == "case9", "no_failure": F.col("case_id") == "case0", "error": F.col("case_id") == "error"}
    counted = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_dropped"), F.lit(0)).alias("n_dropped"), *[F.count_if(c).alias(k) for k, c in tests.items()])
    return counted.select("*", *[F.try_divide(F.col(k), F.col("n")).alias(f"{k}_share") for k in tests])


def failures(rows: DataFrame) -> DataFrame:
    """case_id, case_name, confidence, n of the failures."""
    return rows.where(is_failure()).groupBy("case_id", "case_name", "confidence").agg(F.count(F.lit(1)).alias("n"))


def stacked(rows: DataFrame) -> DataFrame:
    """type_name, case_id, n; a case without a type stands under its own name."""
    return rows.groupBy(F.when(F.col("type_name") == "", "(미분류)").otherwise(F.col("type_name")).alias("type_name"), "case_id").agg(F.count(F.lit(1)).alias("n"))


def kinds(rows: DataFrame) -> DataFrame:
    """case_id, n and the number of different departments."""
    return rows.groupBy("case_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("dept").alias("n_depts"))


def crosstab(rows: DataFrame, axis: str) -> DataFrame:
    """axis, one column for each case of the taxonomy's order, total; the grand total first, then rows by falling total.

    The columns are the 30 cases and the two outside, so no pass is spent on finding them. Cases that do not occur
    count 0.
    """
    columns = [f"case{i}" for i in range(30)] + [routing.OUTSIDE, routing.UNCLASSIFIED, "error"]
    counts = rows.rollup(axis).agg(F.grouping(axis).alias("all_rows"), *[F.count_if(F.col("case_id") == c).alias(c) for c in columns], F.count(F.lit(1)).alias("total"))
    return counts.orderBy(F.desc("all_rows"), F.desc("total"), axis).withColumn(axis, F.when(F.col("all_rows") == 1, "(all)").otherwise(F.col(axis))).drop("all_rows")


def case_order(spark: SparkSession) -> list[str]:
    """The cases by type and number, then those outside the taxonomy and errors."""
    rows = routing.taxonomy(spark).select("type", "case").collect()  # 30 rows
    return [r.case for r in sorted(rows, key=lambda r: (r.type, int(r.case[4:])))] + [routing.OUTSIDE, routing.UNCLASSIFIED, "error"]


def pivot(rows: DataFrame, axis: str, column: str = "case_id", values: list[str] | None = None) -> DataFrame:
    """Any column against the cases, the types, or another column whose values are given; see `crosstab.pivot`."""
    if values is None:
        cases = case_order(rows.sparkSession)
        values = cases if column == "case_id" else [f"TYPE{i}" for i in range(len(taxonomy.TYPE_NAMES))]
    return crosstabs.pivot(rows, axis, column, values)


def suspect_first(rows: DataFrame) -> DataFrame:
    """rows with `suspicion`: what a reviewer should look at first."""
    times = {"dropped": F.coalesce("n_dropped", F.lit(0)), "low": (F.col("confidence") == "low").cast("int"), "unclassified": _no_case().cast("int"), "secondary": (F.size("secondary") > 0).cast("int")}
    score = sum([n * SUSPECT[k] for k, n in times.items()], F.lit(0))
    return rows.withColumn("suspicion", score.cast("int")).orderBy(F.desc("suspicion"), "log_place")


def ordered(rows: DataFrame, order: str) -> DataFrame:
    """rows by one of five orders: suspect, dept (and case), case, confidence (low first) or log; ties in the log's order."""
    if order == "suspect":
        return suspect_first(rows)
    level = F.array_position(F.array(*map(F.lit, LEVELS)), F.col("confidence"))
    return rows.orderBy(*{"dept": [F.col("dept"), F.col("case_id")], "case": [taxonomy.sort_key(F.col("case_id"))], "confidence": [level.desc()], "log": []}[order], "log_place")


def gaps(rows: DataFrame) -> DataFrame:
    """need, n, units, n_units, question (the first in the log) of unmet needs that no passage covers (case20), the widest need first."""
    from convolens.operators import hierarchy

    lacking = rows.where("case_id = 'case20' and missing != ''")
    return hierarchy.gaps(lacking, "need", "dept", "question", "log_place").orderBy(F.desc("n_units"), F.desc("n"), "need")
