"""Queries of the streamed pairs, the log reader, changed answers, citations, quantiles and ranks, with DuckDB SQL."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from convolens.functions import citations, evidence
from convolens.functions.answer_checks import squeeze
from convolens.operators import bi, consistency, crosstab, observed, profile, ranks
from convolens.operators.stages import folder, settle
from convolens.plans import catalogue
from convolens.sources import conversation_log, large_log
from convolens.streaming import pairs


def _t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def streamed_pairs(spark, sf_dir):
    """`conversations` as a stream of files, a minute a turn; the pairs come from the query's sink when it has read all."""
    path = f"{folder(spark)}/stream-{uuid.uuid4().hex}"
    turns = spark.readStream.schema(_t(spark, sf_dir, "conversations").schema).parquet(f"{sf_dir}/conversation[s].parquet")
    found = pairs.pairs(turns.withColumn("ts", F.timestamp_seconds(F.col("turn") * 60)), late="0 seconds")
    found.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(pairs.OUT).parquet(f"{path}/out")


def _damaged_users(spark, sf_dir):
    """A JSON text for each conversation: the first turn of every fourth is a bare string, every seventh has a list for a user."""
    turn = F.to_json(F.struct("turn", F.col("text").alias("user_question"), F.col("role").alias("llm_response")))
    shown = F.when((F.col("conv_id") % 4 == 0) & (F.col("turn") == 0), F.lit('"oops"')).otherwise(turn)
    convs = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_list(shown)), ",").alias("turns"))
    user = F.concat(F.lit('{"user_id":"u'), F.col("conv_id"), F.lit('","conversations":[{"conversation_id":"'), F.col("conv_id"), F.lit('","turns":['), F.col("turns"), F.lit("]}]}"))
    return convs.select("conv_id", F.when(F.col("conv_id") % 7 == 3, F.lit("[1]")).otherwise(user).alias("value"))


def log_damage(spark, sf_dir):
    """Logs of one user with planted damage: what is left out by level, and the turns that are kept."""
    users = _damaged_users(spark, sf_dir).select(F.concat(F.lit('{"users":['), "value", F.lit("]}")).alias("value"))
    kept = conversation_log.flatten(users).agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("level"), "n")
    return conversation_log.damage(users).unionByName(kept)


def large_log_turns(spark, sf_dir):
    """The same users in a few documents, written to the shared folder and cut into users by the tasks that read them."""
    users = _damaged_users(spark, sf_dir).where("value != '[1]'")

    def document(batches):
        first = True
        for batch in batches:
            lines = [('{"metadata":{"users":[{}]},"users":[' if first and i == 0 else ",") + v for i, v in enumerate(batch["value"])]
            first = first and not lines
            yield batch.assign(value=lines)[["value"]]
        if not first:
            yield pd.DataFrame({"value": ["]}"]})

    path = f"{folder(spark)}/documents-{uuid.uuid4().hex}"
    users.repartition(4, "conv_id").select("value").mapInPandas(document, "value string").write.text(path)
    rows = conversation_log.flatten(large_log.users(spark, path), file="place")
    return rows.groupBy("conversation_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("user_question")).alias("chars"))


def changed_answers(spark, sf_dir):
    """Questions told apart by their first word, so that many are asked again; answers by their first two."""
    first = lambda c, n: F.lower(F.substring_index(F.btrim(c), " ", n))
    return consistency.changed_answers(catalogue.conv_pairs(spark, sf_dir), first("question", 1), first("answer", 2))


def citation_ratios(spark, sf_dir):
    """A quote of each benchmark item, with one word replaced, against the texts of the documents with the same number modulo 40."""
    items = _t(spark, sf_dir, "benchmark").where("item_id < 40").select("item_id", F.concat(F.substring("text", 1, 30), F.lit(" zzz "), F.substring("text", 36, 14)).alias("quote"))
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    pairs_ = docs.join(F.broadcast(items), F.col("doc_id") % 40 == F.col("item_id"))  # 40 items
    compared = lambda c: F.lower(squeeze(F.col(c)))
    rows = pairs_.select("doc_id", compared("quote").alias("quote"), compared("text").alias("text"))
    share = citations.shares(F.array("quote"), F.array("text"))[0][0]
    return rows.select("doc_id", F.length("quote").cast("long").alias("n"), F.round(share * F.length("quote")).cast("long").alias("longest"))


def hot_quantiles(spark, sf_dir):
    """Quantiles of all prices under one key, selected in bins and not sorted."""
    rows = _t(spark, sf_dir, "lineitem").select(F.lit("all").alias("what"), F.when(F.col("l_orderkey") % 11 != 0, F.col("l_extendedprice")).alias("price"))
    return profile.numeric_profile(rows, "what", "price", hot=1000)


def label_ranks(spark, sf_dir):
    """Every word of the documents as a label, ranked by its count."""
    words = _t(spark, sf_dir, "documents").select(F.explode(F.split("text", " ")).alias("label")).where("label != ''")
    ranked = ranks.ranked(words.groupBy("label").agg(F.count(F.lit(1)).alias("n")), [F.desc("n"), F.col("label")])
    return ranked.select("label", "n", "rank", F.round(F.col("upto") / F.col("total"), 3).alias("covered"))


def pareto_cover(spark, sf_dir):
    """What the first 3, 5 and 10 part types cover."""
    counts = settle(_t(spark, sf_dir, "part").groupBy(F.col("p_type").alias("label")).agg(F.count(F.lit(1)).alias("n")))
    return ranks.cover(ranks.ranked(counts, [F.desc("n"), F.col("label")])).select(F.col("place").cast("long").alias("place"), "covered")


def label_shares(spark, sf_dir):
    """Priorities by nation with row shares, margins and the whole from one pass of grouping sets."""
    return crosstab.shares(catalogue._orders_by_nation(spark, sf_dir), "n_name", "o_orderpriority")


def case_pivot(spark, sf_dir):
    """Orders as classified turns, with a case by their number, against priorities; the columns in the taxonomy's order."""
    cases = F.concat(F.lit("case"), (F.col("o_orderkey") % 33).cast("string"))
    table = bi.pivot(_t(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("dept"), cases.alias("case_id")), "dept")
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy((F.col("dept") != "■ 전체").cast("int"), F.desc("total"), "dept"))  # a few departments
    return table.select("dept", "case0", "case7", "case29", "others", "total", place.cast("long").alias("place"))


def observed_steps(spark, sf_dir):
    """What two conditions left of `lineitem`, counted while the rows that pass are written."""
    wanted = {"returned": F.col("l_returnflag") == "R", "large": F.col("l_quantity") > 25}
    kept, seen = observed.filtered(_t(spark, sf_dir, "lineitem"), wanted)
    kept.write.parquet(f"{folder(spark)}/observed-{uuid.uuid4().hex}")
    return observed.steps(spark, seen, wanted)


def evidence_rows(spark, sf_dir):
    """Quotes of benchmark items against documents by a lateral join with the table function; the parts that both share."""
    evidence.register(spark)
    items = _t(spark, sf_dir, "benchmark").where("item_id < 40").select("item_id", F.array(F.substring("text", 1, 20), F.substring("text", 30, 25)).alias("quotes"))
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = docs.join(F.broadcast(items), F.col("doc_id") % 40 == F.col("item_id"))  # 40 items
    found = spark.sql("SELECT doc_id, e.* FROM {rows} AS r, LATERAL evidence(r.quotes, r.text) AS e", rows=rows)
    return found.select("doc_id", "quote_no", F.col("length").cast("long").alias("length"), "kept")


QUERIES = {f.__name__: f for f in (label_shares, case_pivot, observed_steps, evidence_rows, streamed_pairs, log_damage, large_log_turns, changed_answers, citation_ratios, hot_quantiles, label_ranks, pareto_cover)}

_SHOWN = "SELECT *, conv_id % 7 = 3 AS no_user, conv_id % 4 = 0 AND turn = 0 AS oops FROM conversations"

ORACLE_SQL = {
    "label_shares": """
        WITH r AS (SELECT n_name, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
        c AS (SELECT n_name, o_orderpriority, count(*) AS n, GROUPING(n_name, o_orderpriority) AS level FROM r GROUP BY CUBE (n_name, o_orderpriority))
        SELECT n_name, o_orderpriority, n, n / CASE level WHEN 0 THEN sum(n) FILTER (level = 0) OVER (PARTITION BY n_name) ELSE (SELECT count(*) FROM r) END AS share, level FROM c
    """,
    "case_pivot": """
        WITH t AS (SELECT o_orderpriority AS dept, o_orderkey % 33 AS c FROM orders),
        p AS (SELECT coalesce(dept, '■ 전체') AS dept, count(*) FILTER (c = 0) AS case0, count(*) FILTER (c = 7) AS case7, count(*) FILTER (c = 29) AS case29, count(*) FILTER (c > 29) AS others, count(*) AS total FROM t GROUP BY ROLLUP (dept))
        SELECT *, row_number() OVER (ORDER BY dept <> '■ 전체', total DESC, dept) AS place FROM p
    """,
    "observed_steps": """
        WITH c AS (SELECT count(*) AS a, count(*) FILTER (l_returnflag = 'R') AS b, count(*) FILTER (l_returnflag = 'R' AND l_quantity > 25) AS c FROM lineitem)
        SELECT 'returned' AS step, 1 AS position, b AS remaining, a - b AS dropped FROM c UNION ALL SELECT 'large', 2, c, b - c FROM c
    """,
    "evidence_rows": """
        WITH b AS (SELECT item_id, unnest([left(text, 20), substr(text, 30, 25)]) AS quote, unnest([0, 1]) AS quote_no FROM benchmark WHERE item_id < 40),
        s AS (SELECT DISTINCT item_id, quote_no, quote, substr(quote, i, k) AS part, k FROM b, (SELECT unnest(range(1, 26)) AS i), (SELECT unnest(range(1, 26)) AS k) WHERE i + k <= length(quote) + 1),
        m AS (SELECT doc_id, quote_no, quote, coalesce(max(k) FILTER (contains(coalesce(text, ''), part)), 0) AS length FROM documents JOIN s ON doc_id % 40 = item_id GROUP BY ALL)
        SELECT doc_id, quote_no, length, length(quote) >= 8 AND length / length(quote) >= 0.9 AS kept FROM m
    """,
    "streamed_pairs": catalogue._PAIRS,
    "log_damage": f"""
        WITH s AS ({_SHOWN})
        SELECT * FROM (SELECT 'kept' AS level, count(*) FILTER (NOT no_user AND NOT oops) AS n FROM s
        UNION ALL SELECT 'turn', count(*) FILTER (NOT no_user AND oops) FROM s
        UNION ALL SELECT 'user', count(DISTINCT conv_id) FILTER (no_user) FROM s) WHERE n > 0
    """,
    "large_log_turns": f"SELECT conv_id::VARCHAR AS conversation_id, count(*) AS n, sum(length(coalesce(text, '')))::BIGINT AS chars FROM ({_SHOWN}) WHERE NOT no_user AND NOT oops GROUP BY conv_id",
    "changed_answers": rf"""
        WITH p AS ({catalogue._PAIRS}),
        r AS (SELECT * FROM (SELECT conv_id, turn, lower(split_part(trim(question, ' '), ' ', 1)) AS asked, lower(array_to_string(string_split(trim(answer, ' '), ' ')[1:2], ' ')) AS answered FROM p) WHERE asked <> '' AND answered <> ''),
        g AS (SELECT asked, answered, count(*) AS n_same, arg_min(conv_id, (conv_id, turn)) AS other_conv, arg_min(turn, (conv_id, turn)) AS other_turn FROM r GROUP BY ALL),
        q AS (SELECT asked, count(DISTINCT answered) AS n_answers, count(DISTINCT conv_id) AS n_conversations FROM r GROUP BY asked HAVING count(DISTINCT answered) > 1 AND count(DISTINCT conv_id) > 1)
        SELECT r.conv_id, r.turn, r.asked, r.answered, a.n_same, o.answered AS other, o.n_same AS n_other, o.other_conv, o.other_turn, n_answers, n_conversations
        FROM r JOIN q USING (asked) JOIN g a ON a.asked = r.asked AND a.answered = r.answered JOIN g o ON o.asked = r.asked AND o.answered <> r.answered
        QUALIFY row_number() OVER (PARTITION BY r.conv_id, r.turn, r.asked, r.answered ORDER BY o.n_same DESC, o.answered) = 1
    """,
    "citation_ratios": r"""
        WITH b AS (SELECT item_id, lower(regexp_replace(left(text, 30) || ' zzz ' || substr(text, 36, 14), '\s+', '', 'g')) AS quote FROM benchmark WHERE item_id < 40),
        p AS (SELECT doc_id, quote, lower(regexp_replace(coalesce(text, ''), '\s+', '', 'g')) AS text FROM documents JOIN b ON doc_id % 40 = item_id),
        s AS (SELECT DISTINCT quote, substr(quote, i, k) AS part, k FROM (SELECT DISTINCT quote FROM b), (SELECT unnest(range(1, 60)) AS i), (SELECT unnest(range(1, 60)) AS k) WHERE i + k <= length(quote) + 1)
        SELECT doc_id, length(quote) AS n, coalesce(max(k) FILTER (contains(text, part)), 0) AS longest FROM p JOIN s USING (quote) GROUP BY ALL
    """,
    "hot_quantiles": """
        WITH v AS (SELECT CASE WHEN l_orderkey % 11 <> 0 THEN l_extendedprice END AS v FROM lineitem),
        r AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n FROM v WHERE v IS NOT NULL),
        q AS (SELECT max(n) AS n, min(v) AS lo, max(v) AS hi, max(v) FILTER (i = least(n - 1, floor(n * 0.25))) AS p25, max(v) FILTER (i = least(n - 1, floor(n * 0.5))) AS p50,
                     max(v) FILTER (i = least(n - 1, floor(n * 0.75))) AS p75, max(v) FILTER (i = least(n - 1, floor(n * 0.9))) AS p90 FROM r)
        SELECT 'all' AS what, n, (SELECT count(*) FROM v WHERE v IS NULL) AS missing, lo, p25, p50, p75, p90, hi FROM q
    """,
    "label_ranks": """
        WITH c AS (SELECT label, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS label FROM documents) WHERE label <> '' GROUP BY label)
        SELECT label, n, row_number() OVER w AS rank, round(sum(n) OVER w / sum(n) OVER (), 3) AS covered FROM c WINDOW w AS (ORDER BY n DESC, label)
    """,
    "pareto_cover": """
        WITH c AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) AS rank, count(*) AS n FROM part GROUP BY p_type)
        SELECT place, round(sum(n) FILTER (rank <= place) / sum(n), 3) AS covered FROM c, (SELECT unnest([3, 5, 10]) AS place) GROUP BY place
    """,
}
