"""Language spans against every labelling of a text; shards of reruns and of rows dealt anew."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from convolens.llm import langid, sharding

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string"
GERMAN, FRENCH, RUSSIAN = "der hund und die katze laufen über die straße", "le chien et le chat courent dans la rue", "собака и кошка бегут по улице"


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, text, lang, "a") for i in range(4) for text, lang in ((GERMAN, "de"), (FRENCH, "fr"), (RUSSIAN, "ru"))]
    return langid.fit(spark.createDataFrame(rows, SCHEMA))


def best_total(scores):
    """The greatest sum of word scores less switching penalties over all labellings."""
    n, k = scores.shape
    return max(sum(scores[i, x] for i, x in enumerate(way)) - langid.SWITCH * sum(a != b for a, b in zip(way, way[1:], strict=False)) for way in product(range(k), repeat=n))


def test_labels_are_the_best_of_all_labellings(model):
    rng = np.random.default_rng(1)
    words = [w for t in (GERMAN, FRENCH, RUSSIAN) for w in t.split()] + ["zzz", "la", "x"]
    texts = [" ".join(rng.choice(words, n)) for n in (1, 2, 3, 5, 6, 7, 7, 7)] + ["", "12 34", " ".join([*GERMAN.split()[:3], *FRENCH.split()[:4]])]
    labels, found = model.label(texts)
    scores = model.scores(found).astype(float)
    for i in range(len(texts)):
        own = found.text == i
        way = labels[own]
        if len(way):
            got = scores[own][np.arange(len(way)), way].sum() - langid.SWITCH * (np.diff(way) != 0).sum()
            assert got == pytest.approx(best_total(scores[own]), abs=1e-3)
    # a text's labels do not depend on the texts beside it
    alone = [langid.Model.label(model, [t])[0].tolist() for t in texts]
    assert alone == [labels[found.text == i].tolist() for i in range(len(texts))]


def test_spans_cut_a_mixed_text_where_the_language_changes(model):
    text = f"{GERMAN}. {RUSSIAN}! {FRENCH}?"
    found = langid.spans(model, text)
    assert [x[0] for x in found] == ["de", "ru", "fr"]
    assert [text[a:b] for _, a, b in found] == [GERMAN, RUSSIAN, FRENCH]
    assert langid.spans(model, "") == [] and langid.spans(model, "1 2 3") == []


def test_a_very_long_text_is_one_text(spark, model):
    long = " ".join([GERMAN] * 3000 + [RUSSIAN] * 1000)
    rows = spark.createDataFrame([(1, long, None, None), (1, long, None, None), (2, RUSSIAN, None, None)], SCHEMA)
    got = [(r.doc_id, r.lang_pred, r.n_spans) for r in langid.identify(rows, model).orderBy("doc_id").collect()]
    assert got == [(1, "de", 2), (1, "de", 2), (2, "ru", 1)]


def test_shards_of_reruns_and_of_rows_dealt_anew_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id % 3 = 0")).withColumn("shard", F.lit(-1)).withColumn("size", F.lit("big"))  # repeated rows, clashing names
    once, again, dealt = ([tuple(r) for r in sharding.interleave(x, 7).orderBy("shard", "slot").collect()] for x in (docs, docs, docs.repartition(5, F.rand(3))))
    assert once == again == dealt and len(once) == docs.count()
    assert [x[4] for x in once if x[3] == 0] == list(range(sum(x[3] == 0 for x in once)))


def test_rows_of_a_shard_follow_the_fractional_rank(spark):
    """By a plain version: seeded order inside each source, then all rows by (2 rank - 1) / (2 rows of the source)."""
    import hashlib

    rows = [(i, f"t{i}", None, s) for i, s in enumerate("a" * 40 + "b" * 13 + "c" * 7)] + [(60, None, None, None)]
    placed = []
    for source in ("a", "b", "c", None):
        own = sorted((r for r in rows if r[3] == source), key=lambda r: hashlib.md5(f"shard:{r[0]}".encode()).hexdigest())
        placed += [((2 * rank - 1) / (2 * len(own)), "-" if source is None else f"+{source}", r[0]) for rank, r in enumerate(own, 1)]
    want = [i for _, _, i in sorted(placed)]
    got = sharding.interleave(spark.createDataFrame(rows, SCHEMA), 6).orderBy("shard", "slot").collect()
    assert [r.doc_id for r in got] == want and [r.shard for r in got] == [p * 6 // 61 for p in range(61)]
