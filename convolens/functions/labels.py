"""Label tables as literals: tables read from text, resolution of a written label, expected scores over label probabilities."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convolens.functions.answer_checks import nfkc, squeeze, strip


@dataclass(frozen=True)
class Label:
    letter: str
    name: str
    score: float = 50.0
    group: str = ""
    aliases: tuple[str, ...] = ()


def parse_table(text: str) -> dict[str, Label]:
    """Labels of lines `A. name (alias, alias) -> score`; a line that begins with # names the group of those after it."""
    table, group = {}, ""
    for line in text.splitlines():
        if line.lstrip().startswith("#"):
            group = line.strip().lstrip("#").strip()
            continue
        found = re.match(r"\s*(?:[-*]\s*)?([A-Z])[.)]\s*(.+?)\s*(?:\(([^()]*)\)\s*)?(?:->|→)\s*(-?\d+(?:\.\d+)?)", line)
        if found:
            letter, name, aliases, score = found.groups()
            table[letter] = Label(letter, name, float(score), group, tuple(x.strip() for x in (aliases or "").split(",") if x.strip()))
    return table


def table_frame(spark: SparkSession, table: dict[str, Label]) -> DataFrame:
    """letter, name, score, group, aliases: the table as a dimension."""
    return spark.createDataFrame([(x.letter, x.name, x.score, x.group, list(x.aliases)) for x in table.values()], "letter string, name string, score double, group string, aliases array<string>")


def folded(name: str) -> str:
    """The form in which names are compared: NFKC, without white space, lower case."""
    return "".join(unicodedata.normalize("NFKC", name).split()).lower()


def _lookup(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def resolve(written: Column, names: dict[str, str], aliases: dict[str, tuple[str, ...]] | None = None) -> Column:
    """The letter of a written label: `A. whatever`, a lone letter, a name or an alias; null if none fits.

    names: letter to name. Where the letter before a dot is unknown, the name after it decides. The first in table
    order wins.
    """
    by_name: dict[str, str] = {}
    for letter, name in names.items():
        for x in (name, *(aliases or {}).get(letter, ())):
            by_name.setdefault(folded(x), letter)
    text, known = strip(written), lambda x: F.when(x.isin(*names), x)
    lead, rest = F.regexp_extract(text, r"(?s)\A([A-Z])[.)]\s*(.*)", 1), F.regexp_extract(text, r"(?s)\A([A-Z])[.)]\s*(.*)", 2)
    name = lambda x: F.try_element_at(_lookup(by_name), F.lower(squeeze(nfkc(x))))
    return F.coalesce(known(lead), known(F.when(F.length(text) == 1, F.upper(text))), name(written), F.when(lead != "", name(rest)))


def resolve_all(written: list[str], table: dict[str, Label]) -> tuple[set[str], list[str]]:
    """The letters of some written labels, and those that no label fits."""
    letters, unknown = set(), []
    by_name = {folded(x): t.letter for t in reversed(table.values()) for x in (*t.aliases, t.name)}
    for w in written:
        text = str(w).strip()
        lead = re.match(r"([A-Z])[.)]\s*(.*)", text, re.S)
        letter = lead.group(1) if lead and lead.group(1) in table else text.upper() if len(text) == 1 and text.upper() in table else by_name.get(folded(text)) or (by_name.get(folded(lead.group(2))) if lead else None)
        if letter:
            letters.add(letter)
        else:
            unknown.append(text)
    return letters, unknown


def expected_score(alternatives: Column, scores: dict[str, float], fallback: Column) -> Column:
    """sum(score * p) / sum(p) over alternatives (label, probability) in the table; the fallback where no mass is left."""
    table = _lookup(scores)
    usable = F.filter(alternatives, lambda a: F.try_element_at(table, a["label"]).isNotNull() & (F.coalesce(a["probability"], F.lit(0.0)) != 0))
    add = lambda acc, a: F.struct((acc["s"] + F.try_element_at(table, a["label"]) * a["probability"]).alias("s"), (acc["p"] + a["probability"]).alias("p"))
    whole = F.aggregate(usable, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("p")), add)
    return F.when(whole["p"] > 0, whole["s"] / whole["p"]).otherwise(fallback)
