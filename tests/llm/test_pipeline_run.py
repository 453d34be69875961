"""The pipeline's run over planted toxic documents, exact copies and near copies against plain Python stages."""

import random
from collections import Counter, defaultdict

import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from convolens.llm import bpe, mixing
from test_near import SCHEMA, edited, plain_kept


def test_run_equals_plain_stages(spark, tmp_path):
    rng = random.Random(9)
    texts = [" ".join(f"w{i}q{rng.randrange(10**6)}" for _ in range(60)) for i in range(150)]
    toxic = [f"{t} vilebad {t[:50]}" for t in texts[:60]]
    near = [" ".join(edited(rng, t.split(), 1)) for t in texts[100:120]]
    copies = [t.replace(" ", "  ", 1) for t in texts[120:140]]
    rows = [(i, t, "en", "ab"[i % 2], len(t)) for i, t in enumerate([*texts, *toxic, *near, *copies])]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    bad = {i for i, t, *_ in rows if "vilebad" in t}
    spark.createDataFrame([(i, 1, int(i in bad)) for i, *_ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    groups = defaultdict(list)
    for i, t, *_ in rows:
        if i not in bad:
            groups["".join(t.split())].append((-len(t), i))
    text, source = {r[0]: r[1] for r in rows}, {r[0]: r[3] for r in rows}
    kept = plain_kept({i: text[i] for i in (min(x)[1] for x in groups.values())})
    assert len(kept) == 150
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    taken, sizes, words = Counter(r.doc_id for r in got), Counter(), Counter()
    for i in kept:
        sizes[source[i]] += len(text[i].split())
    for i, n in taken.items():
        words[source[i]] += n * len(text[i].split())
    assert set(taken) <= kept and max(taken.values()) <= 2
    assert all(abs(words[s] - t) <= 60 for s, t in mixing.source_targets(sizes).items())
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    assert all(r.n_tokens == len(whole.encode_ordinary(text[r.doc_id])) for r in got)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.materialise(stage(spark, docs, str(tmp_path)), f"plain-{name}")
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left == ({r[0] for r in rows} - bad if name == "toxicity" else {min(x)[1] for x in groups.values()} if name == "exact_dedup" else kept)


def test_stages_keep_columns_with_clashing_names_and_handle_dirty_rows(spark, tmp_path):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, words, "en", "a", 5), (1, words, "en", "a", 5), (2, None, None, None, None), (3, "", "en", "b", 0), (None, "no id here", "en", "b", 1), (5, f"{words} {words}", "en", "a", 9), (6, "x " * 50_000, "en", "c", 9)]
    clash = ["score", "predicted", "n_hits", "__tox", "doc", "doc_text", "sha", "row", "fp", "size", "taken", "copies"]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in clash})
    spark.createDataFrame([(1, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialise(stage(spark, docs, str(tmp_path)), f"clash-{name}")
        assert out.columns == docs.columns, name
        assert all(r[c] == c for r in out.select(*clash).collect() for c in clash), name
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.columns == docs.columns and empty.count() == 0, name
        left = out.select("doc_id").collect()
        assert len(left) == len(rows) if name == "toxicity" else len({r.doc_id for r in left}) == len(left) or name == "mixing", name
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
