"""Spelling variants by pairless wildcard groups: words at one inserted, deleted or replaced character.

Words with the same position, prefix and suffix differ in the character at that position only, so they are one
another's replacements. Such a group is kept as its size and its first two words: a member's near words are the size
less one, and the best of them is the first word, or for the first word the second. A word without one of its
characters that is itself a word is near to it; the deletions join the vocabulary, and a word gets back the number
and the best of the longer words that lead to it. No pair of near words is ever a row between longer words and their
group, and a word's parts are added up.

A group cannot be large: its words are told apart by one character, so they are at most as many as the alphabet has
characters (of 116 here), and the longer words of a word at most that times its length and one. So no key is hot,
whatever the text; words are counted in the map tasks first. Roots come by doubling: every word points to its form,
and in each round to where that points; as a form is at least twice as frequent, 63 steps are the most.

Null texts have no runs; a null id counts as the text `null` where the planted deletions are drawn. Repeated rows
count again. Very long texts are read whole and words of any length are taken; a word of L characters has 2L keys,
and a longer one than LONGEST has its keys as digests, so that they stay short. Empty tables give an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convolens.llm.common import attach, discard, materialise, text_of

#: What separates runs in a text whose A-Z are lower-cased.
BETWEEN = r"[^a-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters from which a key is a digest.
LONGEST = 64
#: A sign that no run holds.
WILD = "*"


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, run: every run of letters with its A-Z lower-cased."""
    parts = F.split(F.translate(text_of(text), CAPITALS, SMALL), BETWEEN)
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(parts).alias("run")).where("run != ''")


def planted(every: int = 97, doc_id: str = "doc_id", run: str = "run") -> Column:
    """The run, without one of its characters where its checksum with the document's id says so."""
    h = F.crc32(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit(":"), F.col(run)).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % every == 0, cut).otherwise(F.col(run))


def vocabulary(words: DataFrame, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """word, n of the distinct values of column word that are long and frequent enough."""
    return words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _key(key: Column, length: Column) -> Column:
    return F.when(length > LONGEST, F.sha2(key, 256)).otherwise(key)


def _best(word: str, n: str) -> Column:
    """Orders by n, largest first, then by the word."""
    return F.struct((-F.col(n)).alias("order"), F.col(word).alias("word"))


def _replaced(words: DataFrame) -> DataFrame:
    """word, n_near, best of the words at one replaced character."""
    at = F.explode(F.sequence(F.lit(1), F.char_length("word"))).alias("at")
    key = F.concat(F.expr("substring(word, 1, at - 1)"), F.lit(WILD), F.expr("substring(word, at + 1)"))
    keys = words.select("word", "n", at).select("word", "n", _key(key, F.char_length("word")).alias("key"))
    group = Window.partitionBy("key")
    ranked = group.orderBy(F.desc("n"), "word")
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = _best("word", "n")
    seen = keys.select("word", F.count(F.lit(1)).over(group).alias("size"), F.row_number().over(ranked).alias("place"), F.first(order).over(whole).alias("one"), F.nth_value(order, 2).over(whole).alias("two"))
    return seen.where("size > 1").select("word", (F.col("size") - 1).alias("n_near"), F.when(F.col("place") == 1, F.col("two")).otherwise(F.col("one")).alias("best"))


def _indels(words: DataFrame) -> DataFrame:
    """word, n_near, best of the words with one character more or less."""
    cut = F.array_distinct(F.transform(F.sequence(F.lit(1), F.char_length("word")), lambda at: F.concat(F.substring("word", F.lit(1), at - 1), F.substring("word", at + 1, F.char_length("word")))))
    deletions = words.select(F.explode(cut).alias("word"), F.col("word").alias("longer"), F.col("n").alias("longer_n"))
    met = materialise(deletions.join(words, "word"), "deletions")
    shorter = met.select(F.col("longer").alias("word"), F.lit(1).cast("long").alias("n_near"), _best("word", "n").alias("best"))
    longer = met.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(_best("longer", "longer_n")).alias("best"))
    return shorter.unionByName(longer)


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where the forms (word, form) of a word lead at last. Forms must not lead in a circle."""
    step = materialise(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        total = step.count()
        into = step.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
        # where a root points on, with the number of words that point to it
        on = step.select(F.col("word").alias("at"), F.col("root").alias("next")).join(into.withColumnRenamed("root", "at"), "at").withColumnRenamed("at", "root")
        on = materialise(on, "roots-on")
        if on.limit(1).count() == 0:
            discard(on)
            return step
        moved = attach(step, on, "root", total, "n").select("word", F.col("next").alias("root"))
        still = step.join(on.select("root"), "root", "left_anti").select("word", "root")
        after = materialise(moved.unionByName(still), "roots")
        discard(step, on)
        step = after


def group(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of a vocabulary (word, n)."""
    words = materialise(words.select("word", "n"), "vocabulary")
    near = _replaced(words).unionByName(_indels(words)).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    taken = -F.col("best.order") >= 2 * F.col("n")
    found = words.join(near, "word", "left").select("word", F.when(taken, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(taken, -F.col("best.order")).alias("form_n"))
    found = materialise(found, "found")
    ends = roots(found.where("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, planted_every: int | None = None, least_length: int = 5, least_count: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`group` of the words of documents; with planted_every one of so many runs loses a character first."""
    own = runs(docs, doc_id, text).select((planted(planted_every) if planted_every else F.col("run")).alias("word"))
    return group(vocabulary(own, least_length, least_count))
