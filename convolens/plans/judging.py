"""The judge stage: prompts, one call for each distinct prompt, a table of answers as cache, errors as data.

A judge is any picklable object with `name` and complete(system, user, schema) -> (text, input tokens, output
tokens). Only the columns that a prompt names reach it: no attribute of a user's organisation and no rating.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from convolens.functions.answer_checks import FORMAT_KINDS, LENGTH_KINDS
from convolens.plans import answers

#: The closed domains of an observation and of the two judgments.
TARGETS = ("none", "tone", "format", "language", "length", "content_missing", "content_wrong", "no_answer", "refusal", "inconsistency", "other")
DOMAINS = ("domain", "general_knowledge", "calculation", "code", "tool_usage", "unclear")
HISTORY_USE = ("not_needed", "used", "ignored")
COMPLAINTS = ("content_gap", "wrong_content", "format_or_style", "other")
VERDICTS, GROUNDINGS = ("sufficient", "partial", "insufficient"), ("used", "ignored", "contradicted")

#: Field names of the judge's answers in order. A tuple is a closed domain; reasoning comes first.
OBSERVATION = {
    "reasoning": str, "resolved_question": str, "unmet_need": str, "complaint_target": TARGETS, "complaint_quote": str, "question_domain": DOMAINS, "question_self_contained": bool,
    "question_multi_intent": bool, "answer_refused": bool, "question_answerable_as_asked": bool, "answer_covers_all_intents": bool, "answer_actionable": bool, "answer_used_history": HISTORY_USE,
    "requests_unsupported_output": bool, "requested_language": str, "requested_length_kind": LENGTH_KINDS, "requested_length_value": int, "requested_format": FORMAT_KINDS,
}
SUFFICIENCY = {"reasoning": str, "evidence": [{"chunk_index": int, "quote": str}], "verdict": VERDICTS, "missing": str}
GROUNDING = {"reasoning": str, "answer_used_rag": GROUNDINGS}
NEED = {"reasoning": str, "resolved_question": str, "unmet_need": str, "complaint_type": COMPLAINTS, "context_dependent": bool}
STAGES = {"observe": OBSERVATION, "need": NEED, "sufficiency": SUFFICIENCY, "grounding": GROUNDING}
#: Attempts at an answer that fits its schema; each failure is told to the next one.
ATTEMPTS = 3

#: What the judge is told. The question's passages are withheld from the first step, the answer from the second, the question from the third.
SYSTEM = {
    "observe": "You read one reaction of a user to the answer of an assistant and report what can be observed. Do not judge whose fault it is. Quote the words that show the complaint exactly as written.",
    "need": "You read one reaction of a user to the answer of an assistant and say what the user still needs and what kind of complaint it is. Spell out what the question refers to in earlier ones.",
    "sufficiency": "You judge whether the numbered passages hold what the user needed. Cite each passage that supports your verdict with its number and its exact words. Do not use other knowledge.",
    "grounding": "You judge whether the answer uses the numbered passages, ignores them or contradicts them.",
}


def spark_type(schema) -> StructType | ArrayType | StringType | BooleanType | IntegerType:
    if isinstance(schema, dict):
        return StructType([StructField(k, spark_type(v)) for k, v in schema.items()])
    if isinstance(schema, list):
        return ArrayType(spark_type(schema[0]))
    return {bool: BooleanType(), int: IntegerType()}.get(schema if isinstance(schema, type) else str, StringType())


def json_schema(schema) -> dict:
    """The strict JSON schema of an answer: all keys required, none besides."""
    if isinstance(schema, dict):
        return {"type": "object", "properties": {k: json_schema(v) for k, v in schema.items()}, "required": list(schema), "additionalProperties": False}
    if isinstance(schema, list):
        return {"type": "array", "items": json_schema(schema[0])}
    if isinstance(schema, tuple):
        return {"type": "string", "enum": list(schema)}
    return {"type": {bool: "boolean", int: "integer"}.get(schema, "string")}


def contract(schema: dict) -> str:
    """The schema as a line of text for judges that cannot be bound to it."""

    def kind(x) -> str:
        if isinstance(x, dict):
            return "{" + ", ".join(f'"{k}": {kind(v)}' for k, v in x.items()) + "}"
        return f"[{kind(x[0])}, ...]" if isinstance(x, list) else " | ".join(f'"{v}"' for v in x) if isinstance(x, tuple) else {bool: "true | false", int: "whole number"}.get(x, "text")

    return f"Answer with one JSON object and nothing else: {kind(schema)}"


def extract_json(text: str) -> str:
    """The first balanced JSON object behind any reasoning in think tags; an error where there is none."""
    for end in ("</think>", "</thinking>"):
        text = text.rpartition(end)[2]
    start = text.find("{")
    if start < 0:
        raise ValueError("no JSON object in the answer")
    return json.dumps(json.JSONDecoder().raw_decode(text[start:])[0], ensure_ascii=False)


def problems(value, schema, at: str = "answer") -> list[str]:
    """What keeps a parsed answer from fitting its schema."""
    if isinstance(schema, dict):
        if not isinstance(value, dict):
            return [f"{at} is no object"]
        wrong = [f"{at}.{k} is missing" for k in schema if k not in value] + [f"{at}.{k} is unknown" for k in value if k not in schema]
        return wrong + [x for k, v in schema.items() if k in value for x in problems(value[k], v, f"{at}.{k}")]
    if isinstance(schema, list):
        return [x for i, v in enumerate(value) for x in problems(v, schema[0], f"{at}[{i}]")] if isinstance(value, list) else [f"{at} is no list"]
    if isinstance(schema, tuple):
        return [] if value in schema else [f"{at} is none of {', '.join(schema)}"]
    fits = isinstance(value, schema) and (schema is bool or not isinstance(value, bool))
    return [] if fits else [f"{at} is no {schema.__name__}"]


def ask_until_valid(judge, system: str, user: str, schema: dict) -> tuple[str, int, int]:
    """The judge's answer as JSON that fits the schema, and the tokens of all attempts."""
    told, spent, wrong = f"{system}\n{contract(schema)}", [0, 0], ""
    for _ in range(ATTEMPTS):
        text, *tokens = judge.complete(told, user + (f"\n\nYour last answer did not fit: {wrong}" if wrong else ""), json_schema(schema))
        spent = [a + b for a, b in zip(spent, tokens, strict=True)]
        try:
            answer = extract_json(text)
            wrong = "; ".join(problems(json.loads(answer), schema)[:5])
        except ValueError as e:
            wrong = str(e)
        if not wrong:
            return answer, *spent
    raise ValueError(f"no valid answer in {ATTEMPTS} attempts: {wrong}")


def sample(schema):
    """The least answer that fits: first values of closed domains, empty texts, false, 0."""
    if isinstance(schema, dict):
        return {k: sample(v) for k, v in schema.items()}
    return [] if isinstance(schema, list) else schema[0] if isinstance(schema, tuple) else schema()


@dataclass
class StubJudge:
    """Answers without a model: the least valid answer, changed by the rules whose word the prompt holds.

    rules: stage -> word -> fields. A word `fail` raises, `garbage` answers with text. Same prompt, same answer.
    """

    rules: dict[str, dict[str, dict]] = field(default_factory=dict)
    name: str = "stub"

    def complete(self, system: str, user: str, schema: dict) -> tuple[str, int, int]:
        stage = next(s for s, told in SYSTEM.items() if system.startswith(told))
        answer = sample(STAGES[stage])
        for word, fields in self.rules.get(stage, {}).items():
            if word in user:
                if "fail" in fields:
                    raise RuntimeError(fields["fail"])
                if "garbage" in fields:
                    return fields["garbage"], len(user) // 4, 1
                answer |= fields
        text = json.dumps(answer, ensure_ascii=False)
        return f"<think>short</think>\n{text}", len(system + user) // 4, len(text) // 4


def _numbered(passages: Column) -> Column:
    return F.array_join(F.transform(passages, lambda c, i: F.concat(F.lit("["), i.cast("string"), F.lit("] "), c)), "\n")


def prompt(stage: str) -> Column:
    """The user message of a stage, from the columns of a case and of its observation."""
    part = lambda title, c: F.concat(F.lit(f"# {title}\n"), F.coalesce(c, F.lit("")))
    turn = lambda: [part("Earlier questions", F.array_join("pre_queries", "\n")), part("Answer", F.col("llm_ans_on_last_q")), part("Reaction", F.col("current_query"))]
    parts = {
        "observe": turn,
        "need": turn,
        "sufficiency": lambda: [part("Question", F.col("obs.resolved_question")), part("What the user did not get", F.col("obs.unmet_need")), part("Passages", _numbered(F.col("rag_chunks")))],
        "grounding": lambda: [part("Answer", F.col("llm_ans_on_last_q")), part("Passages", _numbered(F.col("rag_chunks")))],
    }
    return F.concat_ws("\n\n", *parts[stage]())


def prompt_key(stage: str, judge: str, user: Column) -> Column:
    """24 hex digits that name a prompt."""
    return F.substring(F.sha2(F.concat_ws("\0", F.lit(stage), F.lit(judge), F.lit(SYSTEM[stage]), user), 256), 1, 24)


def ask(rows: DataFrame, stage: str, judge, cache: str | None = None) -> DataFrame:
    """rows with answer (struct of the stage's schema), error, called, tokens_in and tokens_out as struct `stage`_reply.

    Each distinct prompt that the cache lacks is put once, in parallel over the partitions; the answers are added to
    the cache in one write. Several rows with one prompt share the answer, and the first of them, by case_id, has the
    call. The cache is read, asked for and written under a claim, so that runs side by side put no prompt twice.
    """
    schema = STAGES[stage]
    keyed = rows.withColumn("__prompt", prompt(stage)).withColumn("__key", prompt_key(stage, judge.name, F.col("__prompt")))
    spark = rows.sparkSession

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, user in zip(batch["key"], batch["prompt"], strict=True):
                try:
                    out.append((stage, key, *ask_until_valid(judge, SYSTEM[stage], user, schema), None))
                except Exception as e:  # one prompt's failure is that prompt's result
                    out.append((stage, key, None, 0, 0, f"[{stage}] {type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["stage", "key", "answer", "tokens_in", "tokens_out", "error"])[[x.split()[0] for x in answers.ANSWERS.split(", ")]]

    def both() -> tuple[DataFrame, DataFrame]:
        known = answers.read(spark, cache).where(F.col("stage") == stage)
        todo = keyed.groupBy(F.col("__key").alias("key")).agg(F.first("__prompt").alias("prompt")).join(known.select("key"), "key", "left_anti")
        return known, todo.mapInPandas(run, answers.ANSWERS)

    if cache:
        with answers.claim(spark, cache, stage):
            known, fresh = both()
            fresh = answers.add(fresh, cache)  # read back, so no prompt is put twice
    else:
        known, fresh = both()
    replies = known.withColumn("cached", F.lit(True)).unionByName(fresh.withColumn("cached", F.lit(False)))
    first = keyed.groupBy(F.col("__key").alias("key")).agg(F.min("case_id").alias("first"))
    reply = F.struct(
        F.from_json("answer", spark_type(schema)).alias("answer"), "error", (~F.col("cached") & (F.col("first") == F.col("case_id"))).alias("called"),
        F.when(F.col("first") == F.col("case_id"), F.when(F.col("cached"), 0).otherwise(F.col("tokens_in"))).otherwise(0).alias("tokens_in"),
        F.when(F.col("first") == F.col("case_id"), F.when(F.col("cached"), 0).otherwise(F.col("tokens_out"))).otherwise(0).alias("tokens_out"),
    )
    joined = keyed.join(replies.join(first, "key").withColumnRenamed("key", "__key").drop("stage"), "__key", "left")
    return joined.select(*[F.col(c) for c in rows.columns], reply.alias(f"{stage}_reply"))
