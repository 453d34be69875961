"""Toxicity from a weighted lexicon, matched by an Aho-Corasick automaton over folded text.

Folding: NFKC, lower case, homoglyphs of other scripts to Latin, digits and signs that stand for letters to those
letters (inside words that hold a letter), everything that is not a letter or digit to a blank. i, l and 1 fold
together, as a substituted 1 may mean either.

The lexicon is learned from labelled documents: words, and word beginnings for inflected or compounded forms, that
many toxic documents hold and other documents hardly ever do; the weight is a smoothed log odds ratio. Exception
phrases are two-word phrases around a lexicon word that labelled clean documents repeat and toxic ones do not; a hit
inside one does not count. Both can also be given.

A score is s / (s + tau), with s the summed weight of the hits normalised by the logarithm of the text's length; tau
comes from the labelled documents. Null and empty texts score 0. Ids, sources and languages are never read by a
score. Repeated rows are scored each; without labelled rows of both kinds every score is 0; extra columns are ignored.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convolens.llm.common import materialise, unit_hash

#: Labelled rows that are looked at to learn (about: a seeded share of them).
FIT_ROWS = 40_000
#: A term needs this many toxic documents, or the share of them if that is more, and this much higher a rate there.
SUPPORT, SHARE, LIFT = 5, 0.002, 25.0
#: Lengths of word beginnings; shortest whole word.
STEMS, SHORTEST = range(4, 9), 3

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ԝ": "w", "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i",
}
#: Digits and signs that stand for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "|": "i"}


class _Fold(dict):
    """A str.translate table: letters and digits stay, homoglyphs become Latin, all else becomes a blank."""

    def __missing__(self, code: int):
        char = chr(code)
        if char in HOMOGLYPHS:
            to = HOMOGLYPHS[char]
        elif char in SUBSTITUTES or char.isalnum():
            to = char
        else:
            to = None if unicodedata.category(char) in ("Mn", "Cf") else " "
        self[code] = to
        return to


_FOLD = _Fold()
_SUBSTITUTE = str.maketrans(SUBSTITUTES | {"l": "i"})
_LETTERS = str.maketrans({"l": "i", "@": " ", "$": " ", "|": " "})
_SIGNS = tuple(SUBSTITUTES)


def fold(text: str | None) -> str:
    """The text's folded words, each with one blank around it."""
    text = text or ""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower().translate(_FOLD)
    if any(x in text for x in _SIGNS):
        words = [w if w.isalpha() else w.translate(_SUBSTITUTE) if any(map(str.isalpha, w)) else w.translate(_LETTERS) for w in text.split()]
        return f" {' '.join(words)} ".replace("l", "i")
    return f" {' '.join(text.split())} ".replace("l", "i")


@dataclass
class Lexicon:
    """Terms with weights: " word " or " beginning". Exceptions: " word word "."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    tau: float = 1.0

    def automaton(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            machine.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            machine.add_word(phrase, (len(phrase), -1.0))
        if len(machine):
            machine.make_automaton()
        return machine


def weigh(folded: str, machine) -> tuple[float, int]:
    """The normalised weight of a folded text and its number of hits."""
    if not len(machine):
        return 0.0, 0
    hits: dict[int, float] = {}
    spans: list[tuple[int, int]] = []
    for end, (size, weight) in machine.iter(folded):
        start = end - size + 1
        if weight < 0:
            spans.append((start, end))
        else:
            hits[start] = max(weight, hits.get(start, 0.0))
    if spans:
        hits = {at: w for at, w in hits.items() if not any(a <= at < b for a, b in spans)}
    return (sum(hits.values()) / math.log2(8 + folded.count(" ")), len(hits)) if hits else (0.0, 0)


def _features(folded: str) -> set[str]:
    words = set(folded.split())
    out = {f" {w} " for w in words if len(w) >= SHORTEST and not w.isdigit()}
    for n in STEMS:
        out.update([f" {w[:n]}" for w in words if len(w) >= n])
    return out


def _counted(rows: DataFrame, count, schema: str) -> dict[tuple, int]:
    """Sums over all partitions of what `count` adds to a Counter for each (folded text, label)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                count(total, text, bool(label))
        yield pd.DataFrame([(*k, n) for k, n in total.items()], columns=[x.split()[0] for x in schema.split(", ")])

    names = [x.split()[0] for x in schema.split(", ")][:-1]
    return rows.mapInPandas(run, schema).groupBy(*names).agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """Learns from rows with text and label (0 or 1): about FIT_ROWS of them, at most.

    The texts are folded once; what follows reads that table.
    """

    @F.pandas_udf("string")
    def folded(texts: pd.Series) -> pd.Series:
        return pd.Series([fold(x) for x in texts], dtype=object)

    labelled = materialise(labelled.select(folded("text").alias("text"), "label"), "toxicity-sample")
    counts = labelled.agg(F.count_if(F.col("label") != 0).alias("toxic"), F.count_if(F.col("label") == 0).alias("clean")).first()
    toxic, clean = counts["toxic"], counts["clean"]
    if not toxic or not clean:
        return Lexicon(exceptions=tuple(fold(x) for x in exceptions))

    def in_toxic(total, folded, label):
        if label:
            total.update((x,) for x in _features(folded))

    least = max(SUPPORT, math.ceil(SHARE * toxic))
    support = {r["key"]: r["n"] for r in _counted(labelled.where("label = 1"), in_toxic, "key string, n long").where(F.col("n") >= least).collect()}

    def in_clean(total, folded, label, wanted=frozenset(support)):
        total.update((x,) for x in _features(folded) & wanted)

    against = {r["key"]: r["n"] for r in _counted(labelled.where("label = 0"), in_clean, "key string, n long").collect()}
    terms = {}
    for x, n in support.items():
        lift = (n / toxic) / ((against.get(x, 0) + 0.5) / (clean + 0.5))
        if lift >= LIFT:
            terms[x] = math.log(lift)
    terms = _prune(terms, support)

    def around(total, folded, label, terms=frozenset(terms), sizes=tuple(sorted({len(x) for x in terms}))):
        words = folded.split()
        marked = [any(w[:n] in terms for n in sizes) for w in (f" {w} " for w in words)]
        if any(marked):
            pairs = {f" {a} {b} " for a, b, i in zip(words, words[1:], range(len(words)), strict=False) if marked[i] or marked[i + 1]}
            total.update((x, "1" if label else "0") for x in pairs)

    per_label = [F.coalesce(F.sum(F.when(F.col("label") == x, F.col("n"))), F.lit(0)).alias(name) for x, name in (("0", "clean"), ("1", "toxic"))]
    pairs = _counted(labelled, around, "key string, label string, n long").groupBy("key").agg(*per_label)
    learned = [r["key"] for r in pairs.where("clean >= 3 and toxic = 0").collect()]
    lexicon = Lexicon(terms, tuple(dict.fromkeys([*learned, *map(fold, exceptions)])))

    def weights(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = lexicon.automaton()
        for batch in batches:
            s = [round(weigh(x, machine)[0], 3) for x in batch["text"]]
            yield pd.DataFrame({"s": s, "label": batch["label"].astype("int32")})

    points = labelled.mapInPandas(weights, "s double, label int").groupBy("s").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")).orderBy("s").collect()
    # the cut with the best F1: predicted are all texts with s of this value and more
    left_t, left_c, best = toxic, clean, (0.0, 1.0)
    before = 0.0
    for r in points:
        if r["s"] > 0:
            best = max(best, (2 * left_t / (left_t + left_c + toxic), -(before + r["s"]) / 2))
        before = r["s"]
        left_t, left_c = left_t - r["t"], left_c - r["c"]
    lexicon.tau = max(1e-3, -best[1])
    return lexicon


def _prune(terms: dict[str, float], support: dict[str, int]) -> dict[str, float]:
    """Of words and beginnings that the same documents hold the longest stays; then what a kept beginning covers goes."""
    longest = dict(terms)
    for x in sorted(terms, key=len, reverse=True):
        stem = x.rstrip(" ") if x.endswith(" ") else x[:-1]
        for n in range(len(stem), STEMS[0], -1):
            short = stem[:n]
            if short != x and short in longest and support[short] <= 1.02 * support[x]:
                del longest[short]
    kept: dict[str, float] = {}
    for x in sorted(longest, key=len):
        if not any(x[:n] in kept for n in range(STEMS[0] + 1, len(x))):
            kept[x] = longest[x]
    return kept


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", hold_out=None) -> DataFrame:
    """text and label of a seeded share of the labelled documents, about `limit`; hold_out(id column) bars rows.

    The ids of the sample are bounded by `limit` and broadcast, so texts do not shuffle.
    """
    ids = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).alias("label"))
    if hold_out is not None:
        ids = ids.where(~hold_out(F.col("__id")))
    n = ids.count()
    ids = ids.where(unit_hash(F.lit("fit"), F.col("__id")) < limit / max(n, limit))
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text"))
    return rows.join(F.broadcast(ids), "__id").select("text", F.col("label").cast("int").alias("label"))


@lru_cache(maxsize=4)
def _machine(terms: tuple, exceptions: tuple):
    return Lexicon(dict(terms), exceptions).automaton()


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """docs with score (0 to 1), predicted (1 if score >= 0.5) and n_hits; columns of these names are replaced."""
    terms, exceptions, tau = tuple(lexicon.terms.items()), lexicon.exceptions, lexicon.tau

    @F.pandas_udf("score double, n_hits int")
    def scored(texts: pd.Series) -> pd.DataFrame:
        machine = _machine(terms, exceptions)
        found = [weigh(fold(x), machine) for x in texts]
        return pd.DataFrame({"score": [s / (s + tau) for s, _ in found], "n_hits": pd.array([n for _, n in found], "int32")})

    rows = docs.drop("score", "predicted", "n_hits", "__tox").withColumn("__tox", scored(F.col(text)))
    return rows.withColumns({"score": F.col("__tox.score"), "predicted": (F.col("__tox.score") >= 0.5).cast("int"), "n_hits": F.col("__tox.n_hits")}).drop("__tox")
