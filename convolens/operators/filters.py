"""Filter files: a JSON state compiled to predicates over turns, with the count that each one leaves."""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convolens.functions import labels
from convolens.functions.labels import Label
from convolens.operators import cases, selection

#: Words that stand for any value.
ANY = ("전체", "all", "ALL", "", "*")


class LabelTableMissing(ValueError):
    """A filter asks for labels or scores while only placeholders are known."""


def as_set(value) -> set[str]:
    """The wanted values of a text, a list or a tree's first level; none where any value will do."""
    items = [] if value is None else [value] if isinstance(value, str) else list(value) if isinstance(value, (dict, list, tuple, set)) else [value]
    return {x for x in (str(v).strip() for v in items) if x not in ANY}


def as_range(value) -> tuple[float, float] | None:
    """Two numbers in order; anything else, a text too, is no range."""
    if not isinstance(value, (list, tuple)) or len(value) != 2:
        return None
    try:
        low, high = sorted(map(float, value))
    except (TypeError, ValueError):
        return None
    return low, high


def _number(value) -> float | None:
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


def turn_buckets(values) -> list[tuple[int, float]]:
    """Closed ranges of turn numbers of texts like `1-5 턴`, `6~10`, `51 턴 이상`, `3 이하`, `4`.

    Two numbers with a sign between them go first, wherever they stand, then a number that a bound follows; else a
    text with one number alone names that turn.
    """

    def of(text: str) -> tuple[int, float] | None:
        if span := re.search(r"(\d+)\s*[-~]\s*(\d+)", text):
            return tuple(sorted(map(int, span.groups())))
        if low := re.search(r"(\d+)\D*이상", text):
            return int(low[1]), math.inf
        if high := re.search(r"(\d+)\D*이하", text):
            return 1, int(high[1])
        numbers = re.findall(r"\d+", text)
        return (int(numbers[0]),) * 2 if len(numbers) == 1 else None

    return [found for text in map(str, values or []) if (found := of(text))]


@dataclass
class FilterSpec:
    name: str = "filter"
    sets: dict[str, set[str]] = field(default_factory=dict)
    turns: list[tuple[int, float]] = field(default_factory=list)
    dates: tuple[str, str] | None = None
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    letters: dict[str, set[str]] = field(default_factory=dict)
    scores: dict[str, float] = field(default_factory=dict)
    unknown_labels: list[str] = field(default_factory=list)


def parse(raw: dict, query: dict[str, Label], emotion: dict[str, Label], placeholders: bool = False) -> FilterSpec:
    """A filter of its JSON form, with the state at the root or under `state`.

    Labels that no table knows are listed and do not filter, and scores that are no numbers are skipped. With
    placeholder tables a filter over labels or scores is refused, as it would silently leave nothing or everything.
    """
    state = raw.get("state", raw)
    org, tree = state.get("org") or {}, state.get("org_tree") or {}
    spec = FilterSpec(str(raw.get("name") or "filter"))
    spec.sets = {"job_grade": as_set(state.get("role")), "dept": as_set(tree.get("db_dept_name")), "job_name": as_set(tree.get("db_job_name")), "position": as_set(org.get("db_position_name"))}
    spec.turns = turn_buckets(state.get("turn"))
    if state.get("use_date") and (state.get("start_date") or state.get("end_date")):
        spec.dates = (str(state.get("start_date") or "")[:10], str(state.get("end_date") or "")[:10])
    spec.ranges = {k: r for k in ("eval", "emotion") if (r := as_range(state.get(f"{k}_range")))}
    for kind, table in (("eval", query), ("emotion", emotion)):
        wanted = as_set(state.get(f"{kind}_labels"))
        spec.letters[kind], unknown = labels.resolve_all(sorted(wanted), table)
        spec.unknown_labels += unknown
    spec.scores = {x.letter: x.score for x in query.values()} | {str(k): n for k, v in (state.get("query_scores") or {}).items() if (n := _number(v)) is not None}
    if placeholders and (spec.ranges or spec.unknown_labels or any(spec.letters.values())):
        raise LabelTableMissing("label or score conditions need the real label tables")
    return spec


def load(path: str, query: dict[str, Label], emotion: dict[str, Label], placeholders: bool = False) -> FilterSpec:
    with open(path, encoding="utf-8") as file:
        return parse(json.load(file), query, emotion, placeholders)


def scored(turns: DataFrame, spec: FilterSpec, emotion: dict[str, Label]) -> DataFrame:
    """turns with eval_expected and emotion_expected: scores computed anew from the alternatives; the recorded one where there is none."""
    tables = {"eval": spec.scores, "emotion": {x.letter: x.score for x in emotion.values()}}
    return turns.withColumns({f"{k}_expected": labels.expected_score(F.col(f"{k}_alternatives"), t, F.col(f"{k}_score")) if t else F.col(f"{k}_score") for k, t in tables.items()})


def predicates(spec: FilterSpec, query: dict[str, Label], emotion: dict[str, Label]) -> dict[str, Column]:
    """The active conditions over scored, paired turns in their fixed order. A null score fails its range."""
    out = {"follow-up with a prior turn": F.col("has_prior")}
    out |= {name: F.col(name).isin(*sorted(wanted)) for name, wanted in spec.sets.items() if wanted}
    if spec.turns:
        out["turn"] = reduce(lambda a, b: a | b, [(F.col("turn") >= low) & (F.lit(True) if high == math.inf else F.col("turn") <= int(high)) for low, high in spec.turns])
    if spec.dates:
        day, (start, end) = F.substring("timestamp", 1, 10), spec.dates
        out["date"] = (day >= start if start else F.lit(True)) & (day <= end if end else F.lit(True))
    out |= {f"{k} score": F.coalesce(F.col(f"{k}_expected").between(*r), F.lit(False)) for k, r in spec.ranges.items()}
    for kind, table in (("eval", query), ("emotion", emotion)):
        if spec.letters.get(kind):
            letter = labels.resolve(F.col(f"{kind}_result"), {x.letter: x.name for x in table.values()}, {x.letter: x.aliases for x in table.values()})
            out[f"{kind} label"] = F.coalesce(letter, F.lit("")).isin(*sorted(spec.letters[kind]))
    return out


def candidates(turns: DataFrame, spec: FilterSpec, emotion: dict[str, Label], history: int = 3) -> DataFrame:
    """The follow-ups of a log, paired and scored: what the conditions look at."""
    return scored(cases.paired(turns, history).where(cases.is_followup()), spec, emotion)


def select(turns: DataFrame, spec: FilterSpec, query: dict[str, Label], emotion: dict[str, Label], limit: int | None = None, history: int = 3) -> tuple[DataFrame, DataFrame]:
    """(cases in log order and at most `limit` of them, one row per step with what it left and dropped)."""
    rows = candidates(turns, spec, emotion, history)
    wanted = predicates(spec, query, emotion)
    kept = selection.apply(rows, wanted)
    return cases.to_cases(kept.orderBy("ordinal").limit(limit) if limit else kept), selection.steps(rows, wanted)


def preview(turns: DataFrame, eval_labels: set[str] | None = None, emotion_labels: set[str] | None = None, most_eval: float | None = None, most_emotion: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(steps, the first five turns that stay) of conditions on the recorded labels and scores as they are written."""
    rows = cases.paired(turns, 1).where(cases.is_followup())
    wanted = {"follow-up with a prior turn": F.col("has_prior")}
    wanted |= {f"{k} label": F.col(f"{k}_result").isin(*sorted(v)) for k, v in (("eval", eval_labels), ("emotion", emotion_labels)) if v is not None}
    wanted |= {f"{k} score": F.col(f"{k}_score") <= v for k, v in (("eval", most_eval), ("emotion", most_emotion)) if v is not None}
    kept = selection.apply(rows, wanted)
    return selection.steps(rows, wanted), kept.orderBy("ordinal").limit(5).select("conversation_id", "turn", "eval_result", F.substring("user_question", 1, 52).alias("question"))
