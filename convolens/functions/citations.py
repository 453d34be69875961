"""Verification of cited passages: exact shares of a quote that stand unbroken in a passage, and index correction.

The longest common part comes from the suffix automaton of the quote, built once for all passages of a row, in Arrow
batches; its time is linear in the texts, whatever the ratio.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from convolens.functions.answer_checks import normalised, squeeze
from convolens.functions.text_checks import let

#: Share of a quote that must stand unbroken in a passage; characters below which a quote proves nothing.
THRESHOLD, SHORTEST = 0.9, 8
EVIDENCE = "array<struct<chunk_index:int,quote:string>>"
CHECKED = "array<struct<chunk_index:int,quote:string,ratio:double,index_corrected:boolean,reason:string>>"


def automaton(text: str) -> tuple[list[dict[str, int]], list[int], list[int]]:
    """The suffix automaton of a text: steps by character, the longest string of each state, and its suffix link."""
    steps, longest, link, last = [{}], [0], [-1], 0
    for c in text:
        new = len(steps)
        steps.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        at = last
        while at != -1 and c not in steps[at]:
            steps[at][c] = new
            at = link[at]
        if at != -1:
            to = steps[at][c]
            if longest[at] + 1 == longest[to]:
                link[new] = to
            else:
                clone = len(steps)
                steps.append(dict(steps[to]))
                longest.append(longest[at] + 1)
                link.append(link[to])
                while at != -1 and steps[at].get(c) == to:
                    steps[at][c] = clone
                    at = link[at]
                link[to] = link[new] = clone
        last = new
    return steps, longest, link


def longest_common(text: str, other: str, machine: tuple | None = None) -> int:
    """Length of the longest string that stands in both; linear in their lengths."""
    return len(longest_part(text, other, machine))


def longest_part(text: str, other: str, machine: tuple | None = None) -> str:
    """The longest string that stands in both, the first such in the other."""
    if text in other:
        return text
    steps, longest, link = machine or automaton(text)
    state = length = best = end = 0
    for at, c in enumerate(other, 1):
        while c not in steps[state] and state:
            state = link[state]
            length = longest[state]
        if c in steps[state]:
            state = steps[state][c]
            length += 1
            if length > best:
                best, end = length, at
    return other[end - best : end]


@F.pandas_udf(ArrayType(ArrayType(IntegerType())))
def _lengths(quotes: pd.Series, passages: pd.Series) -> pd.Series:
    """For every quote of a row the lengths of its longest common strings with the row's passages."""

    def row(qs, ps):
        out = []
        for q in qs if qs is not None else ():
            machine = None if not q or all(q in (p or "") for p in ps) else automaton(q)
            out.append([longest_common(q or "", p or "", machine) for p in ps])
        return out

    return pd.Series([row(qs, ps if ps is not None else ()) for qs, ps in zip(quotes, passages, strict=True)], dtype=object)


def shares(quotes: Column, passages: Column) -> Column:
    """array (by quote) of arrays (by passage) of the longest unbroken part's share of the quote; all in compared form."""
    return F.transform(F.arrays_zip(quotes.alias("q"), _lengths(quotes, passages).alias("n")), lambda x: F.transform(x["n"], lambda n: F.when(F.length(x["q"]) > 0, n / F.length(x["q"])).otherwise(0.0)))


def match_ratio(quote: Column, passage: Column) -> Column:
    """Length of the longest unbroken part of the quote in the passage, over the quote's; both are normalised first."""
    return shares(F.array(normalised(quote)), F.array(normalised(passage)))[0][0]


def verify(evidence: Column, passages: Column) -> Column:
    """evidence (chunk_index, quote) with ratio, index_corrected and reason, which is null for kept quotes.

    Give normalised passages. A quote is kept where the named passage holds nine tenths of it unbroken, or another
    one does, the best and first of them, whose index then replaces the given one. Quotes below eight characters and
    quotes that no passage holds are dropped with their reason and the best ratio that any passage gives. White space
    and case are folded; pass NFKC quotes.
    """
    given = F.coalesce(evidence, F.array().cast(EVIDENCE))
    texts = F.transform(given, lambda e: F.lower(squeeze(e["quote"])))

    def one(x: Column) -> Column:
        e, q, ratios = x["e"], x["q"], x["r"]
        row = lambda i, r, corrected, reason: F.struct(i.cast("int").alias("chunk_index"), e["quote"].alias("quote"), r.cast("double").alias("ratio"), F.lit(corrected).alias("index_corrected"), reason.cast("string").alias("reason"))
        named = F.when((e["chunk_index"] >= 0) & (e["chunk_index"] < F.size(ratios)), F.get(ratios, e["chunk_index"]))
        best = lambda b: F.when(b["r"] >= THRESHOLD, row(-b["i"], b["r"], True, F.lit(None))).otherwise(row(e["chunk_index"], F.coalesce(b["r"], F.lit(0.0)), False, F.lit("not_found")))
        ordered = F.array_max(F.transform(ratios, lambda r, i: F.struct(r.alias("r"), (-i).alias("i"))))
        return F.when(F.length(q) < SHORTEST, row(e["chunk_index"], F.coalesce(F.array_max(ratios), F.lit(0.0)), False, F.lit("too_short"))).when(F.coalesce(named >= THRESHOLD, F.lit(False)), row(e["chunk_index"], named, False, F.lit(None))).otherwise(let(ordered, best))

    return F.transform(F.arrays_zip(given.alias("e"), texts.alias("q"), shares(texts, passages).alias("r")), one)


def kept(checked: Column) -> Column:
    return F.filter(checked, lambda x: x["reason"].isNull())


def dropped(checked: Column) -> Column:
    return F.filter(checked, lambda x: x["reason"].isNotNull())


def verify_complaint(quote: Column, text: Column) -> Column:
    """struct of ratio and verified for a passage of the follow-up that is said to show the complaint."""
    q, t = F.lower(squeeze(quote)), F.lower(squeeze(text))
    ratio = shares(F.array(q), F.array(t))[0][0]
    return let(F.struct(F.length(q).alias("n"), ratio.alias("r")), lambda x: F.struct(x["r"].alias("ratio"), ((x["n"] >= SHORTEST) & (x["r"] >= THRESHOLD)).alias("verified")))
