"""Language identification of mixed text.

Every run of letters is a word. Its script (from fixed code point ranges) narrows the candidates to the languages
that were seen in that script; its score for each of them is the sum of log probabilities of its letter trigrams and
of the whole word, from hashed counts of labelled texts. A Viterbi pass with a switching penalty labels every word,
so a text falls into spans of one language; the text's language is the one with the most letters, and the score is
the share of letters that it has.

The model is learned from about FIT_ROWS labelled texts and is a few tables of fixed size. Null texts and texts
without a letter get `und` and score 0. Long texts are handled whole; the Viterbi pass walks all texts of a batch
together. Ids, sources and languages are never read by a prediction. Without any labelled text all is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convolens.llm.common import unit_hash

#: Labelled texts that are looked at to learn (about: a seeded share of them).
FIT_ROWS = 20_000
#: Hash buckets of trigrams and of words, in bits.
TRIGRAM_BITS, WORD_BITS = 16, 16
#: Cost of a change of language between two words, in units of log probability; cap on the evidence of one word.
SWITCH, MOST = 9.0, 6.0
#: A language is a candidate in a script that holds this share of its letters.
SCRIPT_SHARE = 0.005
#: Code points in one batch of the Viterbi pass, about.
BATCH = 4_000_000

#: First code points of ranges of one script (0: Latin and all else).
SCRIPTS = {
    "latin": (0x0,), "greek": (0x370, 0x1F00), "cyrillic": (0x400, 0x1C80), "armenian": (0x530,), "hebrew": (0x590,), "arabic": (0x600, 0xFB50, 0xFE70),
    "indic": (0x900,), "thai": (0xE00,), "georgian": (0x10A0,), "hangul": (0x1100, 0x3130, 0xAC00), "kana": (0x3040,), "han": (0x3400, 0xF900, 0x20000),
}
#: Where a range of Latin and other letters begins again.
BACK_TO_LATIN = (0x0E80, 0x1200, 0x1C90, 0x2000, 0x3200, 0xA000, 0xD7B0, 0xFB00, 0xFE00, 0xFF00, 0x10000, 0x30000)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point whether it is a letter, and its script's number."""
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    starts = sorted([(at, i) for i, ranges in enumerate(SCRIPTS.values()) for at in ranges] + [(at, 0) for at in BACK_TO_LATIN])
    script = np.zeros(0x110000, np.uint8)
    for at, i in starts:
        script[at:] = i
    return letter, script


@dataclass
class Words:
    """The words of a batch of texts: trigram hashes of all letters, and for each word where it is."""

    grams: np.ndarray  # of each letter
    first: np.ndarray  # of each word, in grams
    size: np.ndarray
    whole: np.ndarray  # hash of each word
    script: np.ndarray
    text: np.ndarray  # the text of each word
    begin: np.ndarray  # code point in the text


def words_of(texts: list[str]) -> Words:
    letter, script = _tables()
    lower = [(x or "").lower() for x in texts]
    codes = np.frombuffer("\n".join([*lower, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([0, *(len(x) + 1 for x in lower)])
    is_letter = letter[codes]
    at = np.flatnonzero(is_letter)
    clean = np.where(is_letter, codes, 0).astype(np.uint64)
    padded = np.concatenate([np.zeros(1, np.uint64), clean, np.zeros(1, np.uint64)])
    mix = padded[at] * np.uint64(0x9E3779B97F4A7C15) + padded[at + 1] * np.uint64(0xC2B2AE3D27D4EB4F) + padded[at + 2] * np.uint64(0x165667B19E3779F9)
    grams = ((mix ^ (mix >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - TRIGRAM_BITS)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    size = np.diff(first, append=len(at))
    if len(first):
        order = np.arange(len(at)) - np.repeat(first, size) + 1
        whole = np.add.reduceat((clean[at] + np.uint64(1)) * (order.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), first)
        whole = ((whole ^ (whole >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - WORD_BITS)
    else:
        whole = np.empty(0, np.uint64)
    text = np.searchsorted(starts, at[first], "right") - 1
    return Words(grams.astype(np.int64), first, size, whole.astype(np.int64), script[codes[at[first]]], text, at[first] - starts[text])


@dataclass
class Model:
    """Log probabilities of trigrams and words by language; which languages occur in which script."""

    langs: list[str]
    grams: np.ndarray
    words: np.ndarray
    scripts: np.ndarray

    def scores(self, w: Words) -> np.ndarray:
        """Of each word for each language; a language outside its script's candidates gets the least."""
        if not len(w.first):
            return np.empty((0, len(self.langs)), np.float32)
        out = np.add.reduceat(self.grams[w.grams], w.first, axis=0) + self.words[w.whole]
        out -= out.max(axis=1, keepdims=True)
        np.maximum(out, -MOST, out=out)
        allowed = self.scripts[w.script]
        out[~allowed & allowed.any(axis=1, keepdims=True)] = -10 * MOST
        return out

    def label(self, texts: list[str]) -> tuple[np.ndarray, Words]:
        """The language number of each word by a Viterbi pass over each text, and the words."""
        w = words_of(texts)
        if not self.langs:
            return np.zeros(len(w.first), np.int8), w
        scores = self.scores(w)
        n = np.bincount(w.text, minlength=len(texts))
        start = np.cumsum(n) - n
        by_size = np.argsort(-n, kind="stable")
        n, start = n[by_size], start[by_size]
        steps = int(n[0]) if len(n) else 0
        active = np.searchsorted(-n, -np.arange(1, steps + 1), "right")  # texts with that many words
        labels = np.zeros(len(w.first), np.int8)
        if not steps:
            return labels, w
        stay = np.ones((len(w.first), len(self.langs)), bool)
        came = np.zeros(len(w.first), np.int8)
        value = scores[start[: active[0]]]
        ends = [value]
        for t in range(1, steps):
            k = active[t]
            if k < len(value):
                ends.append(value[k:])
                value = value[:k]
            at = start[:k] + t
            best = value.argmax(axis=1)
            switched = value[np.arange(k), best][:, None] - np.float32(SWITCH)
            came[at], stay[at] = best, value >= switched
            value = np.maximum(value, switched) + scores[at]
        ends.append(value)
        # the last values of each text, shortest first in ends
        state = np.concatenate([x.argmax(axis=1) for x in reversed(ends[1:])]) if len(ends) > 1 else value.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            at = start[: active[t]] + t
            now = state[: active[t]]
            labels[at] = now
            if t:
                state[: active[t]] = np.where(stay[at, now], now, came[at])
        return labels, w


def _counts(batch: pd.DataFrame) -> pd.DataFrame:
    found = []
    for lang, rows in batch.groupby("lang"):
        w = words_of(rows["text"].tolist())
        letters = np.bincount(w.script, weights=w.size, minlength=len(SCRIPTS))
        for kind, n in (("g", np.bincount(w.grams, minlength=1 << TRIGRAM_BITS)), ("w", np.bincount(w.whole, minlength=1 << WORD_BITS)), ("s", letters)):
            at = np.flatnonzero(n)
            found.append(pd.DataFrame({"lang": lang, "kind": kind, "at": at, "n": n[at].astype(np.int64)}))
    return pd.concat(found) if found else pd.DataFrame({"lang": pd.Series(dtype=str), "kind": pd.Series(dtype=str), "at": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64")})


def fit(labelled: DataFrame, limit: int = FIT_ROWS, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learns from about `limit` rows that have a text and a language. The driver gets counts by hash bucket only."""
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    n = rows.count()
    rows = rows.where(unit_hash(F.lit("fit"), F.col(doc_id)) < limit / max(n, limit)).select(F.col(text).alias("text"), F.col(lang).alias("lang"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                yield _counts(batch.iloc[at : at + 500])

    counts = rows.mapInPandas(run, "lang string, kind string, at long, n long").groupBy("lang", "kind", "at").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())

    def by_lang(kind: str, size: int) -> np.ndarray:
        out = np.zeros((size, len(langs)))
        part = counts[counts["kind"] == kind]
        out[part["at"].to_numpy(np.int64), part["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64)] = part["n"]
        return out

    def log_p(n: np.ndarray, prior: float) -> np.ndarray:
        total = n.sum(axis=0, keepdims=True)
        smooth = prior / len(n) * total.mean() if len(langs) else 0.0
        return np.log((n + smooth + 1e-9) / (total + smooth * len(n) + 1e-9)).astype(np.float32)

    letters = by_lang("s", len(SCRIPTS))
    return Model(langs, log_p(by_lang("g", 1 << TRIGRAM_BITS), 0.02), 0.5 * log_p(by_lang("w", 1 << WORD_BITS), 0.2), letters >= SCRIPT_SHARE * np.maximum(letters.sum(axis=0, keepdims=True), 1))


def _batches(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, x in enumerate(texts):
        if held and held + len(x or "") > BATCH:
            yield start, i
            start, held = i, 0
        held += len(x or "")
    if start < len(texts):
        yield start, len(texts)


def _verdicts(model: Model, texts: list[str | None]) -> pd.DataFrame:
    labels, w = model.label(texts)
    k = max(1, len(model.langs))
    letters = np.bincount(w.text * k + labels, weights=w.size, minlength=len(texts) * k).reshape(len(texts), k)
    total = letters.sum(axis=1)
    best = letters.argmax(axis=1)
    known = (total > 0) & bool(model.langs)
    names = np.array([*model.langs, "und"], object)
    turns = np.bincount(w.text, weights=np.r_[1, (np.diff(labels) != 0) | (np.diff(w.text) != 0)] if len(labels) else None, minlength=len(texts))
    return pd.DataFrame({"lang": np.where(known, names[np.where(known, best, len(model.langs))], "und"), "score": np.where(known, letters.max(axis=1) / np.maximum(total, 1), 0.0), "n_spans": turns.astype(np.int32)})


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred, score (0 to 1) and n_spans; columns of these names are replaced."""

    @F.pandas_udf("lang string, score double, n_spans int")
    def verdict(texts: pd.Series) -> pd.DataFrame:
        rows = texts.where(texts.notna(), None).tolist()
        parts = [_verdicts(model, rows[a:b]) for a, b in _batches(rows)]
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"lang": [], "score": [], "n_spans": []})

    rows = docs.drop("lang_pred", "score", "n_spans", "__lang").withColumn("__lang", verdict(F.col(text)))
    return rows.withColumns({"lang_pred": F.col("__lang.lang"), "score": F.col("__lang.score"), "n_spans": F.col("__lang.n_spans")}).drop("__lang")


def spans(model: Model, text: str) -> list[tuple[str, int, int]]:
    """The spans of one text: language, first code point, code point after the last letter (of the lower-cased text)."""
    labels, w = model.label([text])
    out: list[tuple[str, int, int]] = []
    for label, begin, size in zip(labels, w.begin, w.size, strict=True):
        if out and out[-1][0] == model.langs[label]:
            out[-1] = (out[-1][0], out[-1][1], int(begin + size))
        else:
            out.append((model.langs[label], int(begin), int(begin + size)))
    return out


def held_out(doc_id: Column, modulus: int = 4, remainder: int = 2) -> Column:
    """Whether crc32 of the id as text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))
