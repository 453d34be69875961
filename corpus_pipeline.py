"""The training-corpus pipeline: toxicity, exact dedup, near-dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir), works on every row that its predecessor kept, and returns a DataFrame. All
stages but the last return the columns of `documents`; the last returns one row for each document of the mix, as
often as the mix takes it. Between two stages `run` writes the rows to the shared folder and reads them again, so a
lost executor costs running tasks only.

Null and empty texts are never toxic; of all empty texts one row stays, which has no words, so the mix leaves it out
unless all of its source is taken. Repeated rows are copies of each other: one stays. Very long texts are handled
whole. A stage's rows go to Python in Arrow batches of a few MB, a setting that stays with the session. Further
columns of any name pass through every stage but the last. An empty `documents` passes through every stage as an empty
table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convolens.llm import bpe, exact_dedup, mixing, simhash, toxicity
from convolens.llm.common import materialise, table
from convolens.llm.langid import held_out

#: Bytes (about) of an Arrow batch between an executor and its Python workers, or one row. By default up to 10,000 rows
#: meet in one, once in memory outside of the executor's heap and once in the worker's.
BATCH_BYTES = "4m"


def _small_batches(spark: SparkSession) -> None:
    """For the plans of a stage, of which some run after it has returned; results don't depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below 0.5, by a lexicon learned from the labelled ones that are not held out."""
    _small_batches(spark)
    sample = toxicity.labelled_sample(docs, table(spark, sf_dir, "labels"), hold_out=lambda doc_id: held_out(doc_id, 5, 0))
    rows = docs.select(F.struct("*").alias("doc"), "text")
    return toxicity.score(rows, toxicity.fit(sample)).where("predicted = 0").select("doc.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that pairs with a five-word-shingle similarity of 0.8 or more link."""
    _small_batches(spark)
    return simhash.keep_first(docs, similar=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    _small_batches(spark)
    return mixing.apply_mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text."""
    _small_batches(spark)
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", tokenise),
]

#: SQL can express neither the lexicon nor the linked groups; tests hold the whole run against plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
