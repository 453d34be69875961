"""Queries that run the log's operators and the routing over whole tables, with independently written DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from convolens.functions import labels
from convolens.operators import filters, survey, turnlist
from convolens.plans import routing
from convolens.plans import taxonomy as taxonomies
from convolens.sources import conversation_log


def _t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _turns(spark, sf_dir):
    """`conversations` written as one JSON log each and flattened: 50 users in 4 departments, turns from 1, two of three later ones rated, flags that lack or differ."""
    conv, turn = F.col("conv_id"), F.col("turn")
    rated = F.when((turn > 0) & ((conv + turn) % 3 != 0), F.when(turn % 2 == 0, "Good").otherwise("Bad"))
    flag = F.when(conv % 5 != 0, F.when((conv % 5 == 1) & (turn % 2 == 0), "False").otherwise("True"))
    shown = F.struct((turn + 1).alias("turn"), F.col("text").alias("user_question"), F.col("role").alias("llm_response"), rated.alias("llm_eval_result"), flag.alias("trace_matched"))
    convs = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(shown).alias("turns"))
    user = F.struct(
        F.concat(F.lit("u"), conv % 50).alias("user_id"), F.concat(F.lit("d"), conv % 50 % 4).alias("db_dept_name"),
        F.array(F.struct(conv.cast("string").alias("conversation_id"), "turns")).alias("conversations"),
    )
    return conversation_log.flatten(convs.select(F.to_json(F.struct(F.array(user).alias("users"))).alias("value")))


def log_issues(spark, sf_dir):
    return survey.integrity(_turns(spark, sf_dir)).select("issue", "n")


def log_filter(spark, sf_dir):
    """Steps of a filter by department, turn and label."""
    table = labels.parse_table("A. Good -> 90\nB. Bad -> 10\n")
    spec = filters.parse({"state": {"org_tree": {"db_dept_name": {"d1": {}, "d2": {}}}, "turn": ["2-4 턴", "7 이상"], "eval_labels": ["Bad"]}}, table, {})
    return filters.select(_turns(spark, sf_dir), spec, table, {})[1].select("step", F.col("position").cast("long").alias("position"), "remaining", "dropped")


def log_refs(spark, sf_dir):
    """A turn list with the right user, with none and with one that nobody has, and conversations that the log lacks."""
    conv = F.col("conv_id")
    user = F.when(conv % 3 == 0, F.lit(None)).when(conv % 3 == 1, "nobody").otherwise(F.concat(F.lit("u"), conv % 50))
    listed = _t(spark, sf_dir, "conversations").where("turn % 2 = 0").select("conv_id", "turn").distinct()
    name = F.when(conv % 10 == 0, F.concat(F.lit("x"), conv)).otherwise(conv.cast("string"))
    refs = listed.select((conv * 1000 + F.col("turn")).alias("place"), name.alias("conversation_id"), (F.col("turn") + 1).cast("int").alias("turn"), user.alias("user_id"))
    return turnlist.resolve(_turns(spark, sf_dir), refs).select("place", "status")


_CHECK = ("ok",) * 9 + ("na", "undetermined", "violated")
_FLAG = (True, False, False, None)
#: The routing's inputs with the values that a line of `lineitem` draws from, by a number that its keys give.
_PICKS = {
    **dict.fromkeys(routing.CHECKS, _CHECK), **dict.fromkeys(("format", "language", "length"), ("ok", "violated", "na", "undetermined")),
    **dict.fromkeys(routing.FLAGS, _FLAG), "answerable": (True, True, True, False, None), "self_contained": (True, True, False, None), "answer_refused": (False,) * 9 + (True, None), "unsupported_output": (False,) * 9 + (True, None),
    "target": ("none", "no_answer", "format", "language", "length", "tone", "content_wrong", "content_missing", "content_vague", "inconsistency", "other"),
    "domain": ("domain", "domain", "general_knowledge", "calculation", "code", "tool_usage", "unclear"),
    "verdict": (None, "insufficient", "partial", "sufficient", "sufficient"), "grounding": (None, "ignored", "contradicted", "used"), "n_kept": (0, 1, 2, None), "n_chunks": (0, 3, None),
}


def _number(i: int) -> str:
    return f"(l_orderkey * 7 + l_linenumber) * {7919 + 2 * i} + {i} * 104729"


def route_lines(spark, sf_dir):
    """Every line of `lineitem` as an observed turn, routed; counts of each outcome."""

    def pick(i, values):
        place = F.expr(f"cast(({_number(i)}) % 1000003 div 7 % {len(values)} + 1 as int)")
        return F.element_at(F.array(*map(F.lit, values)), place)

    rows = _t(spark, sf_dir, "lineitem").select(*[pick(i, values).alias(name) for i, (name, values) in enumerate(_PICKS.items())])
    done = routing.route(rows)
    return done.groupBy("case", "confidence", F.array_join("secondary", ",").alias("secondary")).agg(F.count(F.lit(1)).alias("n"))


def taxonomy_of_orders(spark, sf_dir):
    """Orders with a case by their number, described and counted by case, type and category."""
    case = F.when(F.col("o_orderkey") % 37 < 31, F.concat(F.lit("case"), (F.col("o_orderkey") % 37).cast("string"))).otherwise("unclassified")
    rows = taxonomies.describe(_t(spark, sf_dir, "orders").select(case.alias("case_id")))
    return rows.groupBy("case_id", "type_id", "category").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (log_issues, log_filter, log_refs, route_lines, taxonomy_of_orders)}

_LOG = """
    SELECT conv_id % 50 AS u, conv_id AS c, turn + 1 AS turn, CASE WHEN turn > 0 AND (conv_id + turn) % 3 <> 0 THEN CASE WHEN turn % 2 = 0 THEN 'Good' ELSE 'Bad' END END AS label,
           CASE WHEN conv_id % 5 <> 0 THEN NOT (conv_id % 5 = 1 AND turn % 2 = 0) END AS flag FROM conversations
"""
_ANY = " OR ".join(f"{c} = 'violated'" for c in routing.CHECKS)


def _literal(values: tuple) -> str:
    return "[" + ", ".join("NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


_DRAWN = ", ".join(f"{_literal(values)}[({_number(i)}) % 1000003 // 7 % {len(values)} + 1] AS {name}" for i, (name, values) in enumerate(_PICKS.items()))

ORACLE_SQL = {
    "log_issues": f"""
        WITH t AS ({_LOG}),
        p AS (SELECT u, c, count(*) AS n, count(DISTINCT turn) AS d, min(turn) AS lo, max(turn) AS hi, count(DISTINCT flag) AS flags, bool_and(flag) AS flag FROM t GROUP BY u, c)
        SELECT * FROM (SELECT 'trace_inconsistent' AS issue, count(*) FILTER (flags <> 1) AS n FROM p
        UNION ALL SELECT 'trace_mismatch', count(*) FILTER (flags = 1 AND flag <> (n >= 2)) FROM p
        UNION ALL SELECT 'turn_numbering', count(*) FILTER (d <> n OR lo <> 1 OR hi <> n) FROM p
        UNION ALL SELECT 'eval_on_first_turn', count(*) FILTER (turn = 1 AND label IS NOT NULL) FROM t
        UNION ALL SELECT 'eval_missing', count(*) FILTER (turn >= 2 AND label IS NULL) FROM t) WHERE n > 0
    """,
    "log_filter": f"""
        WITH t AS ({_LOG}),
        f AS (SELECT *, EXISTS (SELECT 1 FROM t p WHERE p.u = t.u AND p.c = t.c AND p.turn = t.turn - 1) AS s1, u % 4 IN (1, 2) AS s2, turn BETWEEN 2 AND 4 OR turn >= 7 AS s3, label = 'Bad' AS s4 FROM t WHERE label IS NOT NULL),
        n AS (SELECT count(*) AS c0, count(*) FILTER (s1) AS c1, count(*) FILTER (s1 AND s2) AS c2, count(*) FILTER (s1 AND s2 AND s3) AS c3, count(*) FILTER (s1 AND s2 AND s3 AND s4) AS c4 FROM f)
        SELECT 'follow-up with a prior turn' AS step, 1 AS position, c1 AS remaining, c0 - c1 AS dropped FROM n UNION ALL SELECT 'dept', 2, c2, c1 - c2 FROM n
        UNION ALL SELECT 'turn', 3, c3, c2 - c3 FROM n UNION ALL SELECT 'eval label', 4, c4, c3 - c4 FROM n
    """,
    "log_refs": f"""
        WITH t AS ({_LOG})
        SELECT DISTINCT c * 1000 + turn - 1 AS place, CASE WHEN c % 10 = 0 THEN 'missing' WHEN NOT EXISTS (SELECT 1 FROM t p WHERE p.c = t.c AND p.turn = t.turn - 1) THEN 'no_prior' ELSE 'ok' END AS status
        FROM t WHERE turn % 2 = 1
    """,
    "route_lines": f"""
        WITH r AS (SELECT {_DRAWN} FROM lineitem),
        c AS (SELECT *, CASE WHEN service_error = 'violated' THEN 'case9' WHEN answer_refused THEN 'case28' WHEN injection = 'violated' THEN 'case29'
            WHEN target = 'none' THEN CASE WHEN complaint_unverified OR {_ANY} THEN 'unclassified' ELSE 'case0' END
            WHEN unsupported_output THEN 'case2' WHEN NOT answerable THEN 'case1' WHEN truncated = 'violated' THEN 'case8'
            WHEN target IN ('no_answer', 'inconsistency') THEN 'unclassified'
            WHEN target = 'format' THEN CASE format WHEN 'ok' THEN 'case13' ELSE 'case12' END WHEN target = 'language' THEN CASE language WHEN 'ok' THEN 'case13' ELSE 'case10' END
            WHEN target = 'length' THEN CASE length WHEN 'ok' THEN 'case13' ELSE 'case11' END WHEN target = 'tone' THEN 'case16'
            WHEN domain = 'general_knowledge' THEN 'case25' WHEN domain = 'calculation' THEN 'case26' WHEN domain IN ('code', 'tool_usage') THEN 'case27'
            WHEN domain = 'domain' THEN CASE WHEN verdict IS NULL THEN 'unclassified' WHEN verdict IN ('insufficient', 'partial') OR coalesce(n_kept, 0) = 0 THEN CASE n_chunks WHEN 0 THEN 'case21' ELSE 'case20' END
                WHEN grounding IS NULL THEN 'case20' WHEN grounding = 'ignored' THEN 'case22' WHEN grounding = 'contradicted' THEN 'case18' WHEN actionable THEN 'case13' ELSE 'case17' END
            WHEN history_ignored THEN 'case14' WHEN multi_intent AND NOT coalesce(multi_covered, false) THEN 'case15' WHEN target = 'other' THEN 'out_of_taxonomy' ELSE 'unclassified' END AS k FROM r),
        s AS (SELECT *, list_filter([CASE WHEN NOT self_contained THEN 'case4' END, CASE WHEN multi_intent THEN 'case3' END, CASE WHEN pii = 'violated' THEN 'case6' END, CASE WHEN quoted_spans = 'violated' THEN 'case24' END,
            CASE WHEN arithmetic = 'violated' OR dates = 'violated' THEN 'case26' END, CASE WHEN history_ignored THEN 'case14' END, CASE WHEN multi_intent AND NOT coalesce(multi_covered, false) THEN 'case15' END,
            CASE WHEN format = 'violated' AND target <> 'format' THEN 'case12' END, CASE WHEN language = 'violated' AND target <> 'language' THEN 'case10' END, CASE WHEN length = 'violated' AND target <> 'length' THEN 'case11' END,
            CASE WHEN (python_syntax = 'violated' OR sql_shape = 'violated') AND domain NOT IN ('code', 'tool_usage') THEN 'case27' END], lambda x: x IS NOT NULL AND x <> k) AS more FROM c)
        SELECT k AS "case", CASE WHEN k IN ('case10', 'case11', 'case12') THEN CASE WHEN CASE target WHEN 'format' THEN format WHEN 'language' THEN language ELSE length END <> 'violated' THEN 'medium' WHEN k = 'case11' THEN 'medium' ELSE 'high' END
            WHEN k = 'case26' THEN CASE WHEN arithmetic = 'violated' OR dates = 'violated' THEN 'high' ELSE 'medium' END WHEN k IN ('case8', 'case9', 'case21') THEN 'high' WHEN k = 'case25' OR k[1:4] <> 'case' THEN 'low' ELSE 'medium' END AS confidence,
            array_to_string(more, ',') AS secondary, count(*) AS n FROM s GROUP BY ALL
    """,
    "taxonomy_of_orders": """
        WITH o AS (SELECT o_orderkey % 37 AS i FROM orders)
        SELECT CASE WHEN i < 31 THEN 'case' || i ELSE 'unclassified' END AS case_id,
            CASE WHEN i = 0 THEN 'TYPE0' WHEN i <= 6 THEN 'TYPE1' WHEN i <= 9 THEN 'TYPE2' WHEN i <= 17 THEN 'TYPE3' WHEN i <= 19 THEN 'TYPE4' WHEN i <= 24 THEN 'TYPE5' WHEN i <= 27 THEN 'TYPE6' WHEN i <= 29 THEN 'TYPE7' ELSE '' END AS type_id,
            CASE WHEN i = 0 THEN 'category_0' WHEN i <= 6 THEN 'category_1' WHEN i <= 29 THEN 'category_2' ELSE '' END AS category, count(*) AS n FROM o GROUP BY ALL
    """,
}
