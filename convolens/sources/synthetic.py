"""A synthetic log that is the same for the same seed at every size: departments by template, two to four turns each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convolens.functions.answer_checks import OUTAGE

DEPARTMENTS = ("sales", "finance", "plant", "legal", "support")
#: Question, answer, passages and the reaction to it; what is planted is named in the answer or the reaction.
TEMPLATES = (
    ("how do I book travel", "Use the travel form and send it to your manager.", ["[Travel rules 3] Use the travel form and send it to your manager."], "that is not what I asked, which form"),
    ("list the steps as a table", "First this, then that.", ["[Guide] First this, then that."], "I wanted a table"),
    ("what is 12 * 12", "12 * 12 = 140 as far as I see.", [], "that sum is wrong"),
    ("when is the audit", "The audit is on 2026-02-30.", ["[Calendar] The audit is in March."], "this date cannot be right"),
    ("summarise the contract", OUTAGE[0], [], "no answer again"),
    ("who approves leave", 'The rules say "your direct manager approves every leave".', ["[Leave rules] your direct manager approves every leave request"], "thanks, next question"),
    ("my mail is a.b@example.com, why no access", "Access was given to", [], "the answer stops"),
    ("write sql for the totals", "```sql\nselect (a from t\n```", [], "this does not run"),
)


def _pick(values, seed: Column, *parts: Column) -> Column:
    return F.get(F.array(*values), F.pmod(F.xxhash64(seed, *parts), F.lit(len(values))).cast("int"))


def log(spark: SparkSession, users: int, seed: int = 7) -> DataFrame:
    """value: one JSON log per user. User number i is the same whatever the number of users."""
    rows = spark.range(users).withColumn("seed", F.lit(seed))
    template = lambda i: F.pmod(F.xxhash64("seed", "id", F.lit(i)), F.lit(len(TEMPLATES)))
    of = lambda i, part: F.get(F.array(*[F.to_json(F.array(*map(F.lit, t[part]))) if isinstance(t[part], list) and t[part] else F.lit("[]" if isinstance(t[part], list) else t[part]) for t in TEMPLATES]), template(i).cast("int"))

    def turn(i: int) -> Column:
        question = F.when(F.lit(i) == 1, of(1, 0)).otherwise(F.concat(of(i - 1, 3), F.lit(", "), of(i, 0)))
        rated = F.when(F.lit(i) > 1, F.lit("A"))
        return F.struct(
            F.lit(i).alias("turn"), F.format_string("2026-01-%02d 10:00:00", F.pmod("id", F.lit(28)) + 1).alias("timestamp"), question.alias("user_question"), of(i, 1).alias("llm_response"), of(i, 2).alias("retrieved_data"),
            F.lit("True").alias("trace_matched"), rated.alias("llm_eval_result"), F.when(F.lit(i) > 1, F.pmod(F.xxhash64("seed", "id", F.lit(100 + i)), F.lit(100))).alias("llm_eval_score"),
        )

    size = F.pmod(F.xxhash64("seed", "id", F.lit(50)), F.lit(3)).cast("int") + 2
    conv = F.struct(F.format_string("c%d", "id").alias("conversation_id"), F.slice(F.array(*[turn(i) for i in (1, 2, 3, 4)]), F.lit(1), size).alias("turns"))
    dept = _pick([F.lit(d) for d in DEPARTMENTS], F.col("seed"), F.col("id"), F.lit(1))
    user = F.struct(F.format_string("emp%d", "id").alias("user_id"), F.format_string("login%d", "id").alias("db_login_id"), dept.alias("db_dept_name"), F.lit("staff").alias("job_grade"), F.array(conv).alias("conversations"))
    return rows.select(F.to_json(F.struct(F.array(user).alias("users"))).alias("value"))
