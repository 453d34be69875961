"""The contract of a log: declared fields of each layer against what the log holds. It reports and never rejects."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convolens.sources.conversation_log import ROOTS


@dataclass(frozen=True)
class Field:
    name: str
    types: tuple[str, ...]
    nullable: bool = True
    least: float | None = None
    most: float | None = None
    allowed: tuple[str, ...] = ()
    unused: bool = False


_PERCENT = {"types": ("float",), "least": 0, "most": 100}
#: The layers of a log with their fields.
LAYERS = {
    "user": (Field("user_id", ("str",), False), Field("db_login_id", ("str",)), Field("db_dept_name", ("str",)), Field("db_job_name", ("str",)), Field("job_grade", ("str",)), Field("db_position_name", ("str",))),
    "conversation": (Field("conversation_id", ("str",), False), Field("turns", ("list",), False)),
    "turn": (
        Field("turn", ("int",), False, least=1), Field("timestamp", ("str",)), Field("user_question", ("str",), False), Field("llm_response", ("str",)), Field("retrieved_data", ("str", "list")),
        Field("prev_question", ("str", "list"), unused=True), Field("trace_matched", ("bool", "str")), Field("llm_eval_result", ("str",)), Field("llm_eval_score", **_PERCENT), Field("llm_eval_score_top1", **_PERCENT),
        Field("llm_alternatives", ("list",)), Field("llm_emotion_result", ("str",)), Field("llm_emotion_score", **_PERCENT), Field("llm_emotion_score_top1", **_PERCENT), Field("llm_emotion_alternatives", ("list",)),
    ),
}
#: Keys that lead to the next layer and are no field of their own.
NESTED = {"user": ("conversations",), "conversation": ("turns",), "turn": ()}
#: A whole number counts as a float, a boolean as a whole number.
ACCEPTS = {"int": ("int", "bool"), "float": ("float", "int", "bool"), "str": ("str",), "bool": ("bool",), "list": ("list",)}


def kind(v: Column) -> Column:
    """null, str, int, float, bool, list or dict; null (SQL) for an absent value."""
    s = F.schema_of_variant(v)
    return F.when(s == "VOID", "null").when(s == "STRING", "str").when(s == "BIGINT", "int").when(s == "BOOLEAN", "bool").when(s.startswith("ARRAY"), "list").when(s.startswith("OBJECT"), "dict").when(s.isNotNull(), F.when(F.try_variant_get(v, "$", "decimal(38,9)") == F.try_variant_get(v, "$", "bigint"), F.when(s.rlike(r",0\)$"), "int").otherwise("float")).otherwise("float"))


def layers(logs: DataFrame, text: str = "value") -> dict[str, DataFrame]:
    """Rows of each layer as variants in column v; users stand under the first root key that a log has."""
    parsed = logs.select(F.try_parse_json(text).alias("v"))
    of = lambda column, key: F.explode(F.try_variant_get(column, f"$.{key}", "array<variant>")).alias("v")
    roots = F.coalesce(*[F.try_variant_get("v", f"$.{r}", "array<variant>") for r in ROOTS])
    users = parsed.select(F.explode(roots).alias("v"))
    convs = users.select(of(F.col("v"), "conversations"))
    return {"user": users, "conversation": convs, "turn": convs.select(of(F.col("v"), "turns"))}


def _field_counts(f: Field) -> dict[str, Column]:
    v = F.try_variant_get("v", f"$.{f.name}", "variant")
    is_kind = kind(v)
    absent = ~F.array_contains("keys", f.name)
    empty = (is_kind == "null") | (F.try_variant_get("v", f"$.{f.name}", "string") == "")
    fits = is_kind.isin(*[k for t in f.types for k in ACCEPTS[t]])
    number = F.try_variant_get(v, "$", "double")
    out = {"missing": absent, "type": ~fits & (is_kind != "null")}
    if not f.nullable:
        out["null"] = empty
    if f.least is not None or f.most is not None:
        low = number < f.least if f.least is not None else F.lit(False)
        out["range"] = fits & is_kind.isin("int", "float") & (low | (number > f.most if f.most is not None else F.lit(False)))
    if f.allowed:
        out["allowed"] = fits & ~F.try_variant_get(v, "$", "string").isin(*f.allowed)
    return {k: F.coalesce(c, F.lit(False)) for k, c in out.items()}


def _layer(rows: DataFrame, layer: str, fields: tuple[Field, ...]) -> DataFrame:
    keyed = rows.withColumn("keys", F.map_keys(F.try_variant_get("v", "$", "map<string,variant>")))
    aggs, cells = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(fields):
        counts = _field_counts(f)
        seen = F.collect_set(F.when(counts["type"], kind(F.try_variant_get("v", f"$.{f.name}", "variant"))))
        # a key is missing where no record has it; records without a key that others have are no mismatch
        missing = F.when(F.count_if(counts.pop("missing")) == F.count(F.lit(1)), F.count(F.lit(1))).otherwise(0)
        aggs += [missing.alias(f"c{i}_missing")] + [F.count_if(c).alias(f"c{i}_{k}") for k, c in counts.items()] + [seen.alias(f"t{i}")]
        note = lambda k, i=i: F.array_join(F.slice(F.array_sort(f"t{i}"), 1, 4), ",") if k == "type" else F.lit("")
        cells += [F.struct(F.lit(f.name).alias("field"), F.lit(k).alias("kind"), F.col(f"c{i}_{k}").alias("n"), "rows", note(k).alias("note"), F.lit(f.unused).alias("unused")) for k in ("missing", *counts)]
    known = keyed.agg(*aggs).select(F.inline(F.array(*cells)))
    names = [f.name for f in fields] + list(NESTED[layer])
    unknown = keyed.select(F.explode("keys").alias("field")).where(~F.col("field").isin(*names)).groupBy("field").agg(F.count(F.lit(1)).alias("n"))
    total = keyed.agg(F.count(F.lit(1)).alias("rows"))  # one row
    unknown = unknown.join(F.broadcast(total)).select("field", F.lit("unknown").alias("kind"), "n", "rows", F.lit("").alias("note"), F.lit(False).alias("unused"))
    return known.unionByName(unknown).where("n > 0").select(F.lit(layer).alias("layer"), "*")


def report(logs: DataFrame, text: str = "value", declared: dict[str, tuple[Field, ...]] = LAYERS) -> DataFrame:
    """layer, field, kind, n, rows, note, unused: mismatches by kind (missing, null, type, range, allowed, unknown).

    A null is no type mismatch. The note names the types found, never values. One pass for each layer.
    """
    found = layers(logs, text)
    return reduce(DataFrame.unionByName, [_layer(found[name], name, fields) for name, fields in declared.items()])


def shape(logs: DataFrame, text: str = "value") -> DataFrame:
    """One row: users, conversations, turns."""
    found = layers(logs, text)
    counts = [rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n") for name, rows in found.items()]
    return reduce(DataFrame.unionByName, counts)
