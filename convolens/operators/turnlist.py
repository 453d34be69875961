"""Turn lists: explicit turns of a log, by raw or masked user id or by conversation alone; every miss is named."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convolens.operators import cases

REFS = "place long, conversation_id string, turn int, user_id string"


def read(spark: SparkSession, path: str) -> DataFrame:
    """place, conversation_id, turn, user_id of a JSON array, or of one JSON object a line; blank lines are skipped.

    A list is written by hand and short, so the driver reads it. Wrong lines are errors that name file and line.
    """
    with open(path, encoding="utf-8") as file:
        text = file.read()
    rows = []
    if text.lstrip().startswith("["):
        entries = [(f"{path}[{i}]", x) for i, x in enumerate(json.loads(text))]
    else:
        entries = []
        for i, line in enumerate(text.splitlines(), 1):
            if line.strip():
                try:
                    entries.append((f"{path}:{i}", json.loads(line)))
                except ValueError as e:
                    raise ValueError(f"{path}:{i}: {e}") from None
    for at, x in entries:
        if not isinstance(x, dict):
            raise ValueError(f"{at}: an object is needed, found {type(x).__name__}")
        conversation = x.get("conversation_id") or x.get("conv_id")
        if not conversation or x.get("turn") is None:
            raise ValueError(f"{at}: conversation_id and turn are needed, found {', '.join(sorted(x)) or 'nothing'}")
        rows.append((len(rows), str(conversation), int(x["turn"]), str(x["user_id"]) if x.get("user_id") else None))
    if not rows:
        raise ValueError(f"{path}: no turns")
    return spark.createDataFrame(rows, REFS)


def resolve(turns: DataFrame, refs: DataFrame) -> DataFrame:
    """refs with status ok, missing, no_turn, no_prior or ambiguous, and the owner's masked id where there is one.

    A user id may be raw or masked. Without one, or with one that fits nobody, the conversation id decides, if one
    user alone has it. The log is cut to the listed conversations first, so its texts do not shuffle.
    """
    listed = turns.join(F.broadcast(refs.select("conversation_id").distinct()) if refs.count() <= 100_000 else refs.select("conversation_id").distinct(), "conversation_id", "left_semi")
    convs = listed.groupBy("conversation_id", "user_id").agg(F.first("user_id_raw").alias("raw"), F.collect_set("turn").alias("turns"))
    joined = refs.alias("r").join(convs.alias("c"), F.col("r.conversation_id") == F.col("c.conversation_id"), "left")
    named = (F.col("r.user_id") == F.col("c.user_id")) | (F.col("r.user_id") == F.col("c.raw"))
    one = F.struct(F.col("c.user_id").alias("owner"), F.col("c.turns").alias("turns"))
    found = joined.groupBy("r.place", "r.conversation_id", "r.turn", "r.user_id").agg(F.count("c.user_id").alias("owners"), F.min(F.when(named, one)).alias("named"), F.min(F.when(F.col("c.user_id").isNotNull(), one)).alias("any"))
    found = found.withColumn("own", F.coalesce("named", F.when(F.col("owners") == 1, F.col("any"))))
    has = lambda n: F.coalesce(F.array_contains("own.turns", n), F.lit(False))
    status = F.when(F.col("owners") == 0, "missing").when(F.col("own").isNull(), "ambiguous").when(~has(F.col("turn")), "no_turn").when(~has(F.col("turn") - 1), "no_prior").otherwise("ok")
    return found.select("place", "conversation_id", "turn", F.col("user_id"), F.col("own.owner").alias("owner"), status.alias("status"))


def steps(status: DataFrame) -> DataFrame:
    """place, step, n_left, n_dropped of a turn list: all, those that the log lacks, those without a prior turn."""
    lost, first = F.col("status").isin("missing", "no_turn"), F.col("status") == "no_prior"
    counts = status.agg(F.count(F.lit(1)).alias("n"), F.count_if(lost).alias("lost"), F.count_if(first).alias("first"))
    row = lambda i, name, left, dropped: F.struct(F.lit(i).alias("place"), F.lit(name).alias("step"), left.alias("n_left"), dropped.alias("n_dropped"))
    n, gone, none = F.col("n"), F.col("lost"), F.col("first")
    out = counts.select(F.inline(F.array(row(0, "listed", n, F.lit(0).cast("long")), row(1, "not in the log", n - gone, gone), row(2, "no prior turn", n - gone - none, none))))
    return out.where("place = 0 or n_dropped > 0")


def select(turns: DataFrame, refs: DataFrame, history: int = 3, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(cases of the listed turns in list order and at most `limit` of them, status of every reference). Recorded scores stay as they are.

    An ambiguous reference is an error: the list has to name its user.
    """
    status = resolve(turns, refs)
    clash = status.where("status = 'ambiguous'").limit(1).collect()
    if clash:
        raise ValueError(f"conversation {clash[0].conversation_id} belongs to several users: name the user")
    fit = status.where("status = 'ok'")
    wanted = (fit.orderBy("place").limit(limit) if limit else fit).select("place", "conversation_id", F.col("owner").alias("user_id"), "turn")
    some = turns.join(wanted.select("conversation_id", "user_id").distinct(), ["conversation_id", "user_id"], "left_semi")
    rows = cases.to_cases(cases.paired(some, history))
    return rows.join(wanted, ["conversation_id", "user_id", "turn"]).orderBy("place"), status
