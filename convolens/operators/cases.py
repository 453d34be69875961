"""Cases: follow-ups of a log paired with the answer they react to, its passages and the questions before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("user_id", "conversation_id")


def is_followup() -> Column:
    """Whether a turn was rated as a reaction: only such turns have an evaluation."""
    return F.coalesce(F.col("eval_result"), F.lit("")) != ""


def earlier_turns(keys: tuple[str, ...] = KEYS, order: str = "turn"):
    """All strictly earlier turns of the conversation; RANGE leaves out rows that repeat the turn's number."""
    return Window.partitionBy(*keys).orderBy(order).rangeBetween(Window.unboundedPreceding, -1)


def with_history(turns: DataFrame, question: Column, k: int, keys: tuple[str, ...], order: str, tie: str, name: str) -> DataFrame:
    """turns with the last k non-empty questions before each, oldest first; k <= 0 gives all.

    Every asking row holds itself and the k - 1 asking rows before it, and a turn looks up the latest such row, so
    work and memory grow with k and not with the square of the conversation.
    """
    asks = F.coalesce(question, F.lit("")) != ""
    own = Window.partitionBy(*keys, "__asks").orderBy(order, tie).rowsBetween(Window.unboundedPreceding if k <= 0 else 1 - k, 0)
    rows = turns.withColumn("__asks", asks).withColumn("__own", F.when(F.col("__asks"), F.struct(F.col(order), F.col(tie), F.collect_list(question).over(own).alias("list"))))
    latest = F.max("__own").over(earlier_turns(keys, order))
    return rows.withColumn(name, F.coalesce(latest["list"], F.array().cast("array<string>"))).drop("__asks", "__own")


def flags(turns: DataFrame) -> DataFrame:
    """turns with `multi_turn` (two rows or more) and `declared_multi_turn` (the one trace flag of the conversation, else null)."""
    whole = Window.partitionBy(*KEYS)
    declared = F.when(F.min("trace_matched").over(whole) == F.max("trace_matched").over(whole), F.max("trace_matched").over(whole))
    return turns.withColumns({"multi_turn": F.count(F.lit(1)).over(whole) >= 2, "declared_multi_turn": declared})


def paired(turns: DataFrame, history: int = 3) -> DataFrame:
    """turns with `prior` (the latest earlier turn), `has_prior` (it is turn - 1) and `pre_queries`."""
    of = ("turn", "ordinal", "user_question", "llm_response", "retrieved")
    prior = F.max(F.struct(*of)).over(earlier_turns())
    rows = with_history(turns, F.col("user_question"), history, KEYS, "turn", "ordinal", "pre_queries").withColumn("prior", prior)
    return rows.withColumn("has_prior", F.coalesce(F.col("prior.turn") == F.col("turn") - 1, F.lit(False)))


def to_cases(rows: DataFrame) -> DataFrame:
    """One case for each of the `paired` rows with a prior turn; owners' fields and recomputed scores are carried along."""
    more = [c for c in ("user_id_raw", "login_id", "dept", "job_grade", "job_name", "position", "eval_result", "emotion_result", "ordinal") if c in rows.columns]
    return rows.where("has_prior").select(
        F.concat_ws(":", "user_id", "conversation_id", F.col("turn").cast("string")).alias("case_id"), "user_id", "conversation_id", "turn", *more,
        "pre_queries", F.col("prior.llm_response").alias("llm_ans_on_last_q"), F.col("user_question").alias("current_query"), F.col("prior.retrieved").alias("rag_chunks"),
    )
