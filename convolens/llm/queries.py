"""The registered queries of the training-data operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convolens.llm import bpe, decontaminate, exact_dedup, langid, licenses, mixing, negatives, sharding, simhash, substring, topk, toxicity, variants
from convolens.llm.common import table


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.link(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~held_out))
    return langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.fit(toxicity.labelled_sample(docs, table(spark, sf_dir, "labels"), hold_out=_toxic_held_out))
    return toxicity.score(docs.select("doc_id", _toxic_held_out(F.col("doc_id")).alias("held_out"), "text"), lexicon).drop("text")


def _toxic_held_out(doc_id):
    return langid.held_out(doc_id, 5, 0)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.interleave(table(spark, sf_dir, "documents"), 40)
    return shards.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, shifted)


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"), planted_every=97)


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decisions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {
    f.__name__: f
    for f in (op1_topk, op2_simhash, op3_langid, op4_toxicity, op5_mixing, op6_exact_dedup, op7_substring_dedup, op8_license_scan, op9_byte_bpe, op10_sharding, op11_negatives, op12_variants, op13_decontaminate)
}

ORACLE_SQL = {
    "op1_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, (row_number() OVER w)::INT AS rank, vec_id, score FROM s
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
    """,
    "op6_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER w = 1 AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
    """,
    "op7_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
        first AS (SELECT h, min(doc_id) AS least FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
        gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN first USING (h), (SELECT unnest(range(50)) AS k) WHERE doc_id > least),
        word AS (SELECT doc_id, w[p] AS word, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
        kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op8_license_scan": licenses.oracle(),
    "op11_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
              FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, s.vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, s.vec_id) QUALIFY row_number() OVER w <= 3
    """,
    "op12_variants": r"""
        WITH RECURSIVE crc AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
        runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
        bytes AS (SELECT run, n, list_transform(range(len(x) // 2), lambda k: ('0x' || x[2 * k + 1:2 * k + 2])::BIGINT) AS b
                  FROM (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, 'null') || ':' || run)) AS x FROM runs)),
        drawn AS (SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) AS h FROM bytes, crc),
        v AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM drawn)
              WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
        cut AS (SELECT word, n, left(word, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
        shorter AS (SELECT DISTINCT cut.word, cut.n, v.word AS other, v.n AS other_n FROM cut JOIN v ON v.word = cut.a || cut.b),
        near AS (SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM cut x JOIN cut y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
                 UNION ALL FROM shorter UNION ALL SELECT other, other_n, word, n FROM shorter),
        best AS (SELECT word, count(*) AS n_near, max(other_n) AS form_n, min(other) FILTER (other_n = most) AS form FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS most FROM near) GROUP BY word),
        f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * v.n THEN form END AS form, CASE WHEN form_n >= 2 * v.n THEN form_n END AS form_n FROM v LEFT JOIN best USING (word)),
        up AS (SELECT word, form AS top, 1 AS steps FROM f WHERE form IS NOT NULL UNION ALL SELECT up.word, f.form, steps + 1 FROM up JOIN f ON f.word = up.top WHERE f.form IS NOT NULL),
        ends AS (SELECT word, arg_max(top, steps) AS root FROM up GROUP BY word)
        SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM f LEFT JOIN ends USING (word)
    """,
    "op13_decontaminate": r"""
        WITH b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        bw AS (SELECT DISTINCT item, w[i:i + 9] AS win FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
        n AS (SELECT DISTINCT len(win) AS n FROM bw),
        dw AS (SELECT doc_id, i, n, w[i:i + n - 1] AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, n WHERE len(w) >= n)),
        hit AS (SELECT DISTINCT doc_id, i, n, item FROM dw JOIN bw USING (win)),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
}
