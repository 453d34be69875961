"""The registered queries of the engine with DuckDB SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convolens.functions import text_checks
from convolens.operators import crosstab, profile, turns


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def answer_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: follow-ups, the answers they react to, checks of both, counts by check and verdict."""
    checked = turns.pairs(_t(spark, sf_dir, "conversations")).select(text_checks.truncated(F.col("answer")).alias("truncated"), text_checks.pii(F.col("question")).alias("pii"))
    return checked.unpivot([], ["truncated", "pii"], "check", "verdict").groupBy("check", "verdict").agg(F.count(F.lit(1)).alias("n"))


def conv_roles(spark, sf_dir):
    return _t(spark, sf_dir, "conversations").groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("conv_id").alias("convs"))


def conv_length_hist(spark, sf_dir):
    return profile.histogram_of_sizes(_t(spark, sf_dir, "conversations"), "conv_id")


def conv_pairs(spark, sf_dir):
    return turns.pairs(_t(spark, sf_dir, "conversations"))


def conv_history3(spark, sf_dir):
    rows = turns.history(_t(spark, sf_dir, "conversations"), 3)
    return rows.select("conv_id", "turn", F.size("earlier").cast("long").alias("n_earlier"), F.array_join("earlier", "|").alias("earlier"))


def conv_integrity(spark, sf_dir):
    return turns.integrity(_t(spark, sf_dir, "conversations"))


def turn_buckets(spark, sf_dir):
    return turns.in_ranges(_t(spark, sf_dir, "conversations"), [(1, 2), (5, None)]).groupBy("turn").agg(F.count(F.lit(1)).alias("n"))


def truncation_check(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text_checks.truncated(F.col("text")).alias("verdict"))


def pii_check(spark, sf_dir):
    kinds = text_checks.pii_kinds(F.col("text"))
    return _t(spark, sf_dir, "documents").select("doc_id", kinds.alias("kinds"), F.when(kinds == "", "ok").otherwise("violated").alias("verdict"))


def numeric_profile(spark, sf_dir):
    return profile.numeric_profile(_t(spark, sf_dir, "events"), "event_type", "value")


def histogram10(spark, sf_dir):
    return profile.histogram(_t(spark, sf_dir, "events"), "value")


def label_dist_topk(spark, sf_dir):
    return profile.top_labels(_t(spark, sf_dir, "events"), "event_type", F.get_json_object("props", "$.k").cast("long"))


def mask_ids(spark, sf_dir):
    return _t(spark, sf_dir, "customer").select("c_custkey", text_checks.masked(F.col("c_name")).alias("masked"))


def _orders_by_nation(spark, sf_dir):
    customers = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority")
    nations = F.broadcast(_t(spark, sf_dir, "nation").select("n_nationkey", "n_name"))  # a fixed table of nations
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))


def expected_lift(spark, sf_dir):
    return crosstab.lift(_orders_by_nation(spark, sf_dir), "n_name", "o_orderpriority", least_lift=1.05)


def crosstab_totals(spark, sf_dir):
    return crosstab.totals(_orders_by_nation(spark, sf_dir), "n_name", "o_orderpriority")


def pareto(spark, sf_dir):
    return crosstab.pareto(_t(spark, sf_dir, "part").select("p_brand"), "p_brand")


QUERIES = {
    f.__name__: f
    for f in (answer_checks, conv_roles, conv_length_hist, conv_pairs, conv_history3, conv_integrity, turn_buckets, truncation_check, pii_check, numeric_profile, histogram10, label_dist_topk, mask_ids, expected_lift, crosstab_totals, pareto)
}

_PAIRS = """
    SELECT f.conv_id, f.turn, f.text AS question, p.text AS answer FROM conversations f
    JOIN conversations p ON p.conv_id = f.conv_id AND p.turn = f.turn - 1 WHERE f.role = 'user' AND p.role = 'assistant'
"""


def _truncated(rows: str, key: str) -> str:
    """SQL for key and verdict of rows(key, text)."""
    quote = lambda x: x.replace("'", "''")
    structural = " OR ".join(f"regexp_matches(last, '{x}')" for x in text_checks.STRUCTURAL)
    blank, sign = text_checks.BLANK, text_checks.PICTOGRAPH
    return rf"""
        SELECT {key}, CASE WHEN whole = '' THEN 'undetermined' WHEN bare = '' OR {structural} THEN 'ok'
            WHEN ((length(bare) - length(replace(bare, '```', ''))) // 3) % 2 = 1 THEN 'violated'
            WHEN contains('{quote(text_checks.CLOSERS)}', right(bare, 1)) THEN 'ok' WHEN bare <> whole THEN 'ok' ELSE 'violated' END AS verdict
        FROM (SELECT *, split_part(bare, chr(10), -1) AS last FROM
            (SELECT *, regexp_replace(regexp_replace(whole, '{sign}+\z', ''), '{blank}+\z', '') AS bare FROM
                (SELECT {key}, regexp_replace(coalesce(text, ''), '{blank}+\z', '') AS whole FROM ({rows}))))
    """


def _pii(text: str) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN regexp_matches(coalesce({text}, ''), '{x}') THEN '{name}' END" for name, x in text_checks.PII.items()) + ")"


_BY_NATION = "(SELECT n_name, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"
_AT = "list_extract(list_sort(list(value)), least(count(value) - 1, floor(count(value) * {p})::BIGINT) + 1) AS p{n}"

ORACLE_SQL = {
    "answer_checks": f"""
        WITH p AS ({_PAIRS}), t AS ({_truncated("SELECT conv_id, turn, answer AS text FROM p", "conv_id")})
        SELECT 'truncated' AS "check", verdict, count(*) AS n FROM t GROUP BY verdict
        UNION ALL SELECT 'pii', CASE WHEN {_pii("question")} = '' THEN 'ok' ELSE 'violated' END, count(*) FROM p GROUP BY 2
    """,
    "conv_roles": "SELECT role, count(*) AS n, count(DISTINCT conv_id) AS convs FROM conversations GROUP BY role",
    "conv_length_hist": "SELECT size, count(*) AS n FROM (SELECT conv_id, count(*) AS size FROM conversations GROUP BY conv_id) GROUP BY size",
    "conv_pairs": _PAIRS,
    "conv_history3": """
        SELECT conv_id, turn, len(e)::BIGINT AS n_earlier, coalesce(array_to_string(e, '|'), '') AS earlier FROM (
            SELECT conv_id, turn, CASE WHEN len(e) > 3 THEN e[-3:] ELSE e END AS e FROM (
                SELECT f.conv_id, f.turn, coalesce(list(p.text ORDER BY p.turn) FILTER (p.text <> ''), []) AS e FROM conversations f
                LEFT JOIN conversations p ON p.conv_id = f.conv_id AND p.turn < f.turn AND p.role = 'user'
                WHERE f.role = 'user' GROUP BY f.conv_id, f.turn))
    """,
    "conv_integrity": """
        WITH c AS (SELECT conv_id, count(*) AS n, count(DISTINCT turn) AS d, min(turn) AS lo, max(turn) AS hi FROM conversations GROUP BY conv_id)
        SELECT 'repeated_turn' AS issue, count(*) FILTER (d <> n) AS n FROM c
        UNION ALL SELECT 'turn_numbering', count(*) FILTER (hi - lo + 1 <> d OR lo <> 0) FROM c
        UNION ALL SELECT 'blank_text', count(*) FILTER (coalesce(trim(text), '') = '') FROM conversations
        UNION ALL SELECT 'unknown_role', count(*) FILTER (coalesce(role, '') NOT IN ('user', 'assistant', 'system')) FROM conversations
    """,
    "turn_buckets": "SELECT turn, count(*) AS n FROM conversations WHERE turn BETWEEN 1 AND 2 OR turn >= 5 GROUP BY turn",
    "truncation_check": _truncated("SELECT doc_id, text FROM documents", "doc_id"),
    "pii_check": f"SELECT doc_id, {_pii('text')} AS kinds, CASE WHEN {_pii('text')} = '' THEN 'ok' ELSE 'violated' END AS verdict FROM documents",
    "numeric_profile": f"""
        SELECT event_type, count(value) AS n, count(*) - count(value) AS missing, min(value) AS lo, max(value) AS hi,
            {", ".join(_AT.format(p=p, n=round(p * 100)) for p in (0.25, 0.5, 0.75, 0.9))} FROM events GROUP BY event_type
    """,
    "histogram10": """
        WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
        b AS (SELECT CASE WHEN hi = lo THEN 0 ELSE least(9, floor((value - lo) / ((hi - lo) / 10))) END::BIGINT AS bin FROM events, e WHERE value IS NOT NULL)
        SELECT s.bin, count(b.bin) AS n FROM range(10) s(bin) LEFT JOIN b USING (bin) GROUP BY s.bin
    """,
    "label_dist_topk": """
        WITH c AS (SELECT event_type, (props::JSON ->> 'k')::BIGINT AS label, count(*) AS n FROM events GROUP BY ALL)
        SELECT event_type, label, n, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, label) AS rank, (sum(n) OVER (PARTITION BY event_type))::BIGINT AS total,
            greatest(count(*) OVER (PARTITION BY event_type) - 12, 0) AS other_kinds FROM c QUALIFY rank <= 12
    """,
    "mask_ids": "SELECT c_custkey, CASE WHEN coalesce(c_name, '') = '' THEN 'unknown' ELSE 'u_' || substring(sha256(c_name), 1, 12) END AS masked FROM customer",
    "expected_lift": f"""
        WITH c AS (SELECT n_name, o_orderpriority, count(*) AS n FROM {_BY_NATION} GROUP BY ALL),
        w AS (SELECT *, sum(n) OVER (PARTITION BY n_name) AS r, sum(n) OVER (PARTITION BY o_orderpriority) AS k, sum(n) OVER () AS t FROM c)
        SELECT n_name, o_orderpriority, n, r * k / t AS expected, n / (r * k / t) AS lift, n / r AS row_share, k / t AS global_share,
            n >= 5 AND n / (r * k / t) >= 1.05 AS outlier FROM w
    """,
    "crosstab_totals": f"SELECT n_name, o_orderpriority, count(*) AS n, grouping_id(n_name, o_orderpriority)::BIGINT AS level FROM {_BY_NATION} GROUP BY CUBE (n_name, o_orderpriority)",
    "pareto": """
        SELECT p_brand, n, row_number() OVER o AS rank, sum(n) OVER o / sum(n) OVER () AS covered
        FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand) WINDOW o AS (ORDER BY n DESC, p_brand)
    """,
}
