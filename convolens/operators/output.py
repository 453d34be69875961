"""Result sinks: classified turns as payloads nested under users and conversations, lines per case, summaries of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convolens.functions import citations
from convolens.plans import taxonomy

#: Fields of the observation that a result shows.
SHOWN = ("resolved_question", "unmet_need", "complaint_target", "question_domain", "question_self_contained", "question_multi_intent", "answer_refused", "complaint_quote")


def check_payload() -> Column:
    """The checks that had something to check; evidence only where there is some."""
    entries = F.transform(F.map_entries("checks"), lambda e: F.struct(e["key"].alias("name"), e["value"]["verdict"].alias("verdict"), e["value"]["detail"].alias("detail"), F.when(F.size(e["value"]["evidence"]) > 0, e["value"]["evidence"]).alias("evidence")))
    return F.filter(entries, lambda c: c["verdict"] != "na")


def evidence_payload() -> Column:
    """What a classification rests on. Shares are rounded to three places, half to even."""
    no_complaint = F.col("obs.complaint_target") == "none"
    observation = F.struct(*[F.col(f"obs.{c}") for c in SHOWN], F.when(no_complaint, F.col("complaint.verified")).alias("quote_verified"), F.when(no_complaint, F.bround("complaint.ratio", 3)).alias("quote_ratio"))
    kept = F.transform(citations.kept(F.col("citation")), lambda e: F.struct(e["chunk_index"].alias("chunk_index"), e["quote"].alias("quote"), F.bround(e["ratio"], 3).alias("ratio"), e["index_corrected"].alias("index_corrected")))
    dropped = F.transform(citations.dropped(F.col("citation")), lambda e: F.struct(e["quote"].alias("quote"), e["reason"].alias("reason")))
    sufficiency = F.struct(F.col("judgment.verdict").alias("verdict"), F.col("judgment.missing").alias("missing"), kept.alias("evidence"), dropped.alias("dropped_evidence"))
    return F.struct(
        F.when(F.col("obs").isNotNull(), observation).alias("observation"),
        F.when(F.col("judgment").isNotNull(), sufficiency).alias("sufficiency"),
        F.when(F.col("grounding").isNotNull(), F.struct(F.col("grounding").alias("answer_used_rag"))).alias("grounding"),
        check_payload().alias("checks"),
    )


def payload(results: DataFrame) -> DataFrame:
    """results with `payload`: the turn as it is written. A turn that failed has its error and nothing else."""
    rows = taxonomy.describe(results.withColumn("case_id_", F.col("classification.case_id")).withColumnRenamed("case_id", "key").withColumnRenamed("case_id_", "case_id"))
    secondary = F.transform("classification.secondary", lambda c: F.struct(c.alias("case_id")))
    done = F.col("error").isNull()
    block = F.struct(
        "error",
        *[F.when(done, c).alias(n) for n, c in {
            "case_id": F.col("case_id"), "case_name": F.col("case_name"), "type_id": F.col("type_id"), "type_name": F.col("type_name"), "category": F.col("category"), "confidence": F.col("classification.confidence"),
            "secondary_cases": secondary, "evidence": evidence_payload(), "llm_calls": F.col("llm_calls"), "answered_turn": F.col("turn") - 1,
        }.items()],
    )
    turn = F.struct("turn", "pre_queries", "llm_ans_on_last_q", "current_query", F.col("rag_chunks").alias("chunk_data"), block.alias("classification"))
    return rows.withColumn("payload", turn).drop("case_id", "case_name", "type_id", "type_name", "category").withColumnRenamed("key", "case_id")


def nest(results: DataFrame, raw_ids: bool = False) -> DataFrame:
    """One row per user: user columns and conversations, each with its turns by number; users and conversations in log order.

    user_id is the masked id unless `raw_ids` asks for the log's own. A conversation is one row of the first shuffle,
    a user one of the second.
    """
    rows = payload(results)
    key = F.coalesce("user_id_raw", "user_id") if raw_ids else F.col("user_id")
    owner = {"user_id_hashed": "user_id", "job_grade": "job_grade", "db_dept_name": "dept", "db_job_name": "job_name", "db_position_name": "position"}
    own = [F.min_by(c, "ordinal").alias(n) for n, c in owner.items()]
    convs = rows.withColumn("owner", key).groupBy("owner", "conversation_id").agg(F.min("ordinal").alias("first"), *own, F.array_sort(F.collect_list(F.struct("turn", "ordinal", "payload"))).alias("turns"))
    conv = F.struct("first", F.struct("conversation_id", F.transform("turns", lambda t: t["payload"]).alias("turns")).alias("c"))
    users = convs.groupBy(F.col("owner").alias("user_id")).agg(F.min("first").alias("first"), *[F.min_by(n, "first").alias(n) for n in owner], F.array_sort(F.collect_list(conv)).alias("convs"))
    return users.select("user_id", *owner, F.transform("convs", lambda x: x["c"]).alias("conversations"), "first")


def write_nested(results: DataFrame, path: str, raw_ids: bool = False) -> None:
    """JSON lines, one user each, in log order within and over the files."""
    nest(results, raw_ids).orderBy("first").drop("first").write.mode("overwrite").json(path)


def write_lines(results: DataFrame, path: str) -> None:
    """JSON lines, one case each."""
    payload(results).select("case_id", "user_id", "conversation_id", "payload.*").write.mode("overwrite").json(path)


def distribution(rows: DataFrame, label: Column, order: str = "ordinal") -> DataFrame:
    """label, n, share and rank by falling count; ties fall to the label that the log shows first."""
    counts = rows.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by = Window.orderBy(F.desc("n"), "first", "label")  # over counted labels only
    return counts.select("label", "n", (F.col("n") / F.sum("n").over(whole)).alias("share"), F.row_number().over(by).cast("long").alias("rank"))


def summary(results: DataFrame) -> dict[str, DataFrame]:
    """Distributions of the classified turns by case, type, confidence and secondary case; errors; totals."""
    done = taxonomy.describe(results.where("classification is not null").withColumn("case_id", F.col("classification.case_id")))
    failed = results.where("error is not null")
    return {
        "case": distribution(done, F.col("case_id")),
        "type": distribution(done, F.when(F.col("type_name") == "", "(미분류)").otherwise(F.col("type_name"))),
        "confidence": distribution(done, F.col("classification.confidence")),
        "secondary": distribution(done.select("ordinal", F.explode("classification.secondary").alias("s")), F.col("s")),
        "errors": failed.orderBy("ordinal").limit(5).select("case_id", "error"),
        "stages": failed.groupBy(F.regexp_extract("error", r"^\[(\w+)\]", 1).alias("stage")).agg(F.count(F.lit(1)).alias("n")),
        "false_alarms": distribution(done.where("case_id = 'case0'"), F.col("eval_result")).where("rank <= 3"),
        "totals": totals(results),
    }


def totals(results: DataFrame) -> DataFrame:
    """One row: turns, classified, failed, calls, tokens."""
    return results.agg(
        F.count(F.lit(1)).alias("n"), F.count("classification").alias("n_classified"), F.count("error").alias("n_failed"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("llm_calls", "tokens_in", "tokens_out")],
    )


def display_width(text: str) -> int:
    """Columns on a screen; wide characters take two."""
    import unicodedata

    return sum(2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def clip(text: str, width: int) -> str:
    """The text in exactly `width` columns."""
    while display_width(text) > width:
        text = text[:-1]
    return text + " " * (width - display_width(text))


def render(results: DataFrame, width: int = 80) -> str:
    """The summary as text of at most `width` columns; all distributions are short."""
    parts, lines = summary(results), []
    one = parts["totals"].first()
    lines.append(f"{one.n_classified} classified, {one.n_failed} failed of {one.n}; {one.llm_calls} calls, {one.tokens_in} tokens in, {one.tokens_out} out")
    for name in ("case", "type", "confidence", "secondary", "false_alarms"):
        rows = parts[name].where("rank <= 30").orderBy("rank").collect()
        lines += [f"[{name}]"] * bool(rows) + [f"  {clip(str(r.label), 40)}{r.n:>8} {r.share:>7.1%}" for r in rows]
    lines += [f"  {r.stage}: {r.n}" for r in parts["stages"].orderBy("stage").collect()] + [f"! {r.case_id}: {r.error}" for r in parts["errors"].collect()]
    return "\n".join(clip(x, width).rstrip() for x in lines)
