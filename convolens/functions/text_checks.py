"""Deterministic checks of an answer's text as Catalyst expressions; each gives a verdict string."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, and signs that make up an emoji.
BLANK = r"[\x09-\x0D\x1C-\x20\x{85}\p{Z}]"
BLANK_CHARS = "".join(map(chr, [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
PICTOGRAPH = r"[\p{So}\x{FE0E}\x{FE0F}\x{200D}\x{1F3FB}-\x{1F3FF}]"
#: Characters that close a sentence.
CLOSERS = ".!?。」』】)]}…\"'`"
#: Last lines that end a text on purpose (table row, bullet, numbered item, fence).
STRUCTURAL = (r"^\s*\|.*\|\s*\z", r"^\s*[-*•·]\s+\S", r"^\s*(?:\d+[.)]|[①-⑳])\s+\S", r"```\z")
#: Personal data with clear anchors.
PII = {
    "resident_id": r"\b\d{6}[-\s]?[1-4]\d{6}\b",
    "mobile": r"\b01[016-9][-\s]?\d{3,4}[-\s]?\d{4}\b",
    "email": r"\b[\w.+-]+@[\w-]+\.[\w.]{2,}\b",
    "card": r"\b(?:\d{4}[-\s]){3}\d{4}\b",
    "account": r"\b\d{2,3}-\d{2,6}-\d{2,6}\b",
}


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row; a plain Python name would copy its expression at every use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def finding(verdict: Column, detail: Column | str, evidence: Column | None = None, most: int = 5) -> Column:
    """What a check gives: struct of verdict, detail and at most `most` pieces of evidence."""
    none, said = F.array().cast("array<string>"), F.lit(detail) if isinstance(detail, str) else detail
    if evidence is None:
        return F.struct(verdict.alias("verdict"), said.alias("detail"), none.alias("evidence"))
    shown = lambda v: F.when(v == "violated", F.slice(evidence, 1, most)).otherwise(none)
    return let(verdict, lambda v: F.struct(v.alias("verdict"), said.alias("detail"), shown(v).alias("evidence")))


def truncated_check(text: Column) -> Column:
    """Whether a text breaks off. Structural endings are accepted before open fences are looked for."""

    def judged(x: Column) -> Column:
        whole, bare, last = x["whole"], x["bare"], F.substring_index(x["bare"], "\n", -1)
        structural = reduce(lambda a, b: a | b, [last.rlike(p) for p in STRUCTURAL])
        fences = (F.length(bare) - F.length(F.replace(bare, F.lit("```"), F.lit("")))) / 3
        verdict = (
            F.when(whole == "", "undetermined")
            .when((bare == "") | structural, "ok")
            .when(fences.cast("long") % 2 == 1, "violated")
            .when(F.instr(F.lit(CLOSERS), F.right(bare, F.lit(1))) > 0, "ok")
            .when(bare != whole, "ok")
            .otherwise("violated")
        )
        return finding(verdict, "the last line", F.array(F.right(last, F.lit(40))))

    whole = F.rtrim(F.coalesce(text, F.lit("")), F.lit(BLANK_CHARS))
    bare = lambda w: F.rtrim(F.regexp_replace(w, rf"{PICTOGRAPH}+\z", ""), F.lit(BLANK_CHARS))
    return let(whole, lambda w: let(F.struct(w.alias("whole"), bare(w).alias("bare")), judged))


def truncated(text: Column) -> Column:
    """ok, violated or undetermined (blank)."""
    return truncated_check(text)["verdict"]


def pii_found(text: Column) -> Column:
    """map of kind to the number of matches, kinds without any left out; values are never given."""
    whole = F.coalesce(text, F.lit(""))
    counts = F.array(*[F.struct(F.lit(name).alias("key"), F.regexp_count(whole, F.lit(f"(?U){x}")).alias("value")) for name, x in PII.items()])
    return F.map_from_entries(F.filter(counts, lambda c: c["value"] > 0))


def pii_check(text: Column) -> Column:
    """Personal data: the detail names kinds and counts."""

    def judged(found: Column) -> Column:
        named = F.transform(F.map_entries(found), lambda e: F.concat(e["key"], F.lit(" "), e["value"].cast("string")))
        return finding(F.when(F.size(found) > 0, "violated").otherwise("ok"), F.array_join(named, ", "))

    return let(pii_found(text), judged)


def pii_kinds(text: Column) -> Column:
    """Names of the kinds of personal data in the text, joined by a comma; values are never given."""
    whole = F.coalesce(text, F.lit(""))
    return F.concat_ws(",", *[F.when(whole.rlike(f"(?U){x}"), F.lit(name)) for name, x in PII.items()])


def pii(text: Column) -> Column:
    return F.when(pii_kinds(text) == "", "ok").otherwise("violated")


def masked(value: Column) -> Column:
    """A stable pseudonym of an id; `unknown` where there is none."""
    return F.when(F.coalesce(value, F.lit("")) == "", "unknown").otherwise(F.concat(F.lit("u_"), F.substring(F.sha2(value, 256), 1, 12)))
