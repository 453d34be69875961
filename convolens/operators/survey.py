"""A survey of a log without any judge: what it declares and holds, retrieval, owners, integrity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convolens.operators import profile
from convolens.operators.cases import KEYS, is_followup


def shape(turns: DataFrame) -> DataFrame:
    """One row: users, conversations, turns and follow-ups."""
    per = turns.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.count_if(is_followup()).alias("f"))
    return per.agg(F.countDistinct("user_id").alias("users"), F.count(F.lit(1)).alias("conversations"), F.sum("n").alias("turns"), F.sum("f").alias("followups"))


def against_declared(turns: DataFrame, declared: DataFrame) -> DataFrame:
    """kind, declared, actual, same for users and turns; declared: one row of total_users and total_turns."""
    both = shape(turns).join(F.broadcast(declared))  # one row each
    cells = [F.struct(F.lit(k).alias("kind"), F.col(f"total_{k}").cast("long").alias("declared"), F.col(k).cast("long").alias("actual"), F.col(f"total_{k}").eqNullSafe(F.col(k)).alias("same")) for k in ("users", "turns")]
    return both.select(F.inline(F.array(*cells)))


def retrieval(turns: DataFrame) -> DataFrame:
    """Turns with and without passages, and the profile of the number of passages."""
    sizes = turns.select(F.lit("passages").alias("key"), F.size("retrieved").alias("n_passages"))
    empty = sizes.agg(F.count_if(F.col("n_passages") == 0).alias("empty"))
    return profile.numeric_profile(sizes, "key", "n_passages").join(F.broadcast(empty)).drop("key")  # one row each


def owners(turns: DataFrame, field: str, k: int = 8) -> DataFrame:
    """The k values of an owner's field with the most conversations."""
    convs = turns.groupBy(*KEYS).agg(F.first(field).alias(field))
    return profile.top_labels(convs.withColumn("key", F.lit(field)), "key", F.col(field), k).drop("key")


def issues(turns: DataFrame) -> DataFrame:
    """issue, user_id, conversation_id, turn (null: the whole conversation) of the five kinds of damage.

    trace_inconsistent: flags differ inside a conversation, or none of its turns has one; trace_mismatch: the flag contradicts the number of turns;
    turn_numbering: turns are not 1 to n; eval_on_first_turn; eval_missing: a later turn without a rating.
    """
    per = turns.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("turn").alias("d"), F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.min("trace_matched").alias("t0"), F.max("trace_matched").alias("t1"), F.min("ordinal").alias("ordinal")
    )
    of_conv = {"trace_inconsistent": F.col("t0").isNull() | (F.col("t0") != F.col("t1")), "trace_mismatch": (F.col("t0") == F.col("t1")) & (F.col("t0") != (F.col("n") >= 2)), "turn_numbering": (F.col("d") != F.col("n")) | (F.col("lo") != 1) | (F.col("hi") != F.col("n"))}
    of_turn = {"eval_on_first_turn": (F.col("turn") == 1) & is_followup(), "eval_missing": (F.col("turn") >= 2) & ~is_followup()}

    def marked(rows: DataFrame, tests: dict[str, Column], turn: Column) -> DataFrame:
        kinds = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in tests.items()]))
        return rows.select(F.explode(kinds).alias("issue"), *KEYS, turn.alias("turn"), "ordinal")

    return marked(per, of_conv, F.lit(None).cast("int")).unionByName(marked(turns, of_turn, F.col("turn")))


def integrity(turns: DataFrame, samples: int = 3) -> DataFrame:
    """issue, n, samples: the count of each kind and its first cases in log order."""
    found = issues(turns)
    counts = found.groupBy("issue").agg(F.count(F.lit(1)).alias("n"))
    first = found.withColumn("rank", F.row_number().over(Window.partitionBy("issue").orderBy("ordinal"))).where(F.col("rank") <= samples)
    name = F.concat_ws(":", "user_id", "conversation_id", F.col("turn").cast("string"))
    return counts.join(first.groupBy("issue").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", name.alias("name")))), lambda x: x["name"]), ", ").alias("samples")), "issue")


def report(turns: DataFrame) -> dict[str, DataFrame]:
    """All tables of the survey by name."""
    of_kind = lambda k: profile.top_labels(turns.where(is_followup()).withColumn("key", F.lit(k)), "key", F.col(f"{k}_result")).drop("key")
    numbers = reduce(DataFrame.unionByName, [turns.select(F.lit(k).alias("key"), F.col(f"{k}_score").alias("v")) for k in ("eval", "emotion")])
    return {
        "shape": shape(turns), "sizes": profile.histogram_of_sizes(turns.withColumn("key", F.struct(*KEYS)), "key"), "eval": of_kind("eval"), "emotion": of_kind("emotion"), "scores": profile.numeric_profile(numbers, "key", "v"),
        "eval_histogram": profile.histogram(turns, "eval_score"), "retrieval": retrieval(turns), "dept": owners(turns, "dept"), "job_grade": owners(turns, "job_grade"), "integrity": integrity(turns),
    }
