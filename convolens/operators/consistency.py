"""Equal questions of different conversations that got different answers (case19), with what was answered elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convolens.operators.joins import attach
from convolens.operators.stages import settle


def changed_answers(pairs: DataFrame, question: Column, answer: Column) -> DataFrame:
    """conv_id, turn, asked, answered, n_same, other, n_other, other_conv, other_turn, n_answers, n_conversations.

    pairs: conv_id, turn and what the two columns are made of; both must come in the form in which they are compared,
    and null or empty ones take no part. A row is given for every asking of a question that at least two
    conversations asked and that has two answers at least. `other` is the most frequent answer that differs from the
    row's own (ties: the smallest), other_conv and other_turn the first place that gave it.

    Askings are counted by question and answer in the map tasks first, and everything about a question is made from
    those counts, so a question that a third of all rows ask is never gathered.
    """
    rows = settle(pairs.select("conv_id", "turn", question.alias("asked"), answer.alias("answered")).where("asked != '' and answered != ''"))
    given = settle(rows.groupBy("asked", "answered").agg(F.count(F.lit(1)).alias("n_same"), F.min(F.struct("conv_id", "turn")).alias("place")))
    convs = rows.groupBy("asked", "conv_id").agg(F.count(F.lit(1)).alias("n")).groupBy("asked").agg(F.count(F.lit(1)).alias("n_conversations"), F.sum("n").alias("n_asked"))
    order = F.struct((-F.col("n_same")).alias("by"), F.col("answered").alias("other"), F.col("place").alias("at"))
    best = given.groupBy("asked").agg(F.min(order).alias("one"), F.count(F.lit(1)).alias("n_answers")).where("n_answers > 1").join(convs.where("n_conversations > 1"), "asked")
    best = settle(best)
    total = rows.count()
    # the first answer that is not the first one: counts of a question meet its best answer, and the least of the rest is taken
    second = attach(given, best.select("asked", "one", "n_answers"), "asked", given.count(), "n_answers").where(F.col("answered") != F.col("one.other")).groupBy("asked").agg(F.min(order).alias("two"))
    known = settle(best.join(second, "asked"))
    counted = attach(given.drop("place"), known.select("asked", "one", "two", "n_answers", "n_conversations", "n_asked"), "asked", given.count(), "n_answers")
    other = F.when(F.col("answered") == F.col("one.other"), F.col("two")).otherwise(F.col("one"))
    told = counted.select(F.struct("asked", "answered").alias("key"), "n_same", other.alias("x"), "n_answers", "n_conversations")
    out = attach(rows.select("conv_id", "turn", F.struct("asked", "answered").alias("key")), told, "key", total, "n_same")
    return out.select("conv_id", "turn", "key.asked", "key.answered", "n_same", F.col("x.other").alias("other"), (-F.col("x.by")).alias("n_other"), F.col("x.at.conv_id").alias("other_conv"), F.col("x.at.turn").alias("other_turn"), "n_answers", "n_conversations")
