"""Nested conversation logs (users, their conversations, turns) flattened to one normalised row per turn.

Dirty fields are read as variants, so a JSON string, number and boolean stay apart, and are normalised with Catalyst
expressions: a bad value ends as null and never fails the scan. The levels are parsed one after the other, so that an
element that is no object costs itself only; `damage` counts such elements. A log is one JSON document; `read` takes
files of one log each, of one log or user per line, or large documents, which `large_log` cuts into users.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convolens.functions.answer_checks import squeeze, strip
from convolens.functions.text_checks import let, masked
from convolens.sources import large_log

#: Keys of a turn, of a user and of a log's users in order of preference; a passage's text keys.
TURN_KEYS = (
    "turn", "timestamp", "user_question", "llm_response", "retrieved_data", "prev_question", "trace_matched", "llm_eval_result", "llm_eval_score", "llm_eval_score_top1", "llm_alternatives",
    "llm_emotion_result", "llm_emotion_score", "llm_emotion_score_top1", "llm_emotion_alternatives",
)
USER_KEYS = ("user_id", "db_login_id", "db_dept_name", "db_job_name", "job_grade", "db_position_name")
ROOTS, PASSAGE_KEYS = ("users", "analysis_results", "data"), ("text", "content", "chunk")
CONVERSATION = "struct<conversation_id:string,turns:array<string>>"
USER = f"struct<{','.join(f'{k}:string' for k in USER_KEYS)},conversations:array<string>>"
LOG = "struct<" + ",".join(f"{root}:array<string>" for root in ROOTS) + ",conversations:array<string>>"
ALTERNATIVES = "array<struct<label:string,name:string,probability:double>>"


def _kind(v: Column) -> Column:
    """STRING, BIGINT, DOUBLE, DECIMAL(..), BOOLEAN, VOID, ARRAY<..> or OBJECT<..>; null for an absent value."""
    return F.schema_of_variant(v)


def _string(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def as_text(v: Column) -> Column:
    """The value as text, absent and null as empty."""
    return F.coalesce(_string(v), F.lit(""))


def as_bool(v: Column) -> Column:
    """A JSON boolean, or one of the usual words as a JSON string; numbers are none."""
    word = F.lower(strip(_string(v)))
    said = F.when(word.isin("true", "1", "y", "yes"), True).when(word.isin("false", "0", "n", "no"), False)
    return F.when(_kind(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean")).when(_kind(v) == "STRING", said)


def as_float(v: Column) -> Column:
    """A JSON number, 1 or 0 for a boolean, or a number written as a string."""
    number = F.when(_kind(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double")).when(_kind(v) == "STRING", strip(_string(v)).try_cast("double"))
    return number.otherwise(F.try_variant_get(v, "$", "double"))


def split_concatenated(text: Column) -> Column:
    """Parts between blank lines, trimmed; where that gives one part at most, the lines."""
    parts = lambda pattern: F.filter(F.transform(F.split(text, pattern), strip), lambda x: x != "")
    return let(parts(r"\n\s*\n"), lambda blocks: F.when(F.size(blocks) > 1, blocks).otherwise(parts(r"\n")))


def _items(list_: Column) -> Column:
    """Passages of a variant that holds a list: strings as they are, the first text key of objects; others as JSON."""

    def one(x: Column) -> Column:
        named = F.coalesce(*[F.nullif(F.try_variant_get(x, f"$.{k}", "string"), F.lit("")) for k in PASSAGE_KEYS])
        return F.when(_kind(x).startswith("OBJECT"), named).when(F.is_variant_null(x), F.lit("")).otherwise(F.coalesce(_string(x), F.to_json(x)))

    return F.transform(F.try_variant_get(list_, "$", "array<variant>"), one)


def passages(v: Column) -> Column:
    """Retrieved passages of a JSON list, of a string that holds JSON, or of a text parted by blank lines.

    Blank passages and objects without a text key are dropped; absent, null and empty values give none.
    """
    none = F.array().cast("array<string>")

    def of_text(text: Column) -> Column:
        def parsed(p: Column) -> Column:
            scalar = F.when(_kind(p) == "STRING", F.array(_string(p))).otherwise(_items(F.parse_json(F.concat(F.lit("["), text, F.lit("]")))))
            return F.when(p.isNull(), split_concatenated(text)).when(F.is_variant_null(p), none).when(_kind(p).startswith("ARRAY"), _items(p)).otherwise(scalar)

        return F.when(text == "", none).otherwise(let(F.try_parse_json(text), parsed))

    other = F.when(_kind(v) == "VOID", none).otherwise(F.array(_string(v)))
    found = F.when(v.isNull(), none).when(_kind(v) == "STRING", let(strip(_string(v)), of_text)).when(_kind(v).startswith("ARRAY"), _items(v)).otherwise(other)
    return F.filter(F.coalesce(found, none), lambda x: x.isNotNull() & (squeeze(x) != ""))


def alternatives(v: Column) -> Column:
    """array of struct<label, name, probability>; blanks around keys and the misspelling `lable` are accepted."""
    items = F.filter(F.try_variant_get(v, "$", "array<variant>"), lambda x: _kind(x).startswith("OBJECT"))

    def one(item: Column) -> Column:
        key = lambda e: F.when(F.trim(e["key"]) == "lable", "label").otherwise(F.trim(e["key"]))
        entries = F.transform(F.map_entries(F.try_variant_get(item, "$", "map<string,string>")), lambda e: F.struct(key(e).alias("key"), e["value"].alias("value")))
        at = lambda k: F.get(F.filter(entries, lambda e: e["key"] == k), F.lit(0))["value"]
        return F.struct(at("label").alias("label"), at("name").alias("name"), F.coalesce(at("probability").try_cast("double"), F.lit(0.0)).alias("probability"))

    return F.coalesce(F.transform(items, one), F.array().cast(ALTERNATIVES))


def _is_object(text: Column) -> Column:
    """Whether a JSON text (of an element that was parsed once) is an object's."""
    return F.coalesce(F.ltrim(text).startswith("{"), F.lit(False))


def levels(logs: DataFrame, text: str = "value", file: str | None = None) -> DataFrame:
    """file, user_no, conv_no, place, the user's keys, conversation_id, t (a variant) of every element of JSON logs.

    `bad` names the level of an element that is no object, or of a text that is no log; it is null for turns. Texts
    may be single users. `file` is a column that numbers the texts, else they are numbered here.
    """
    number = F.col(file) if file else F.monotonically_increasing_id()
    parsed = logs.select(number.alias("file"), F.col(text).alias("text"), F.from_json(F.col(text), LOG).alias("log"))
    single = F.col("log.conversations").isNotNull()
    listed = F.coalesce(*[F.col(f"log.{root}") for root in ROOTS], F.when(single, F.array("text")))
    users = parsed.select("file", listed.isNull().alias("no_log"), F.posexplode_outer(listed).alias("user_no", "raw"))
    users = users.select("file", "user_no", F.when(F.col("no_log"), "log").when(F.col("user_no").isNotNull() & ~_is_object(F.col("raw")), "user").alias("bad"), F.when(_is_object(F.col("raw")), F.from_json("raw", USER)).alias("u"))
    convs = users.select("file", "user_no", "bad", *[F.col(f"u.{k}") for k in USER_KEYS], F.posexplode_outer("u.conversations").alias("conv_no", "raw"))
    convs = convs.select("file", "user_no", "conv_no", F.when(F.col("conv_no").isNotNull() & ~_is_object(F.col("raw")), "conversation").otherwise(F.col("bad")).alias("bad"), *USER_KEYS, F.when(_is_object(F.col("raw")), F.from_json("raw", CONVERSATION)).alias("c"))
    rows = convs.select("file", "user_no", "conv_no", "bad", *USER_KEYS, F.col("c.conversation_id").alias("c_id"), F.posexplode_outer("c.turns").alias("place", "raw"))
    rows = rows.withColumns({"bad": F.when(F.col("place").isNotNull() & ~_is_object(F.col("raw")), "turn").otherwise(F.col("bad")), "t": F.when(_is_object(F.col("raw")), F.try_parse_json("raw"))})
    # a JSON string that looks like an object
    rows = rows.withColumn("bad", F.when(F.col("bad").isNull() & F.col("place").isNotNull() & F.col("t").isNull(), "turn").otherwise(F.col("bad")))
    return rows.drop("raw")


def _at(key: str) -> Column:
    """A key of the turn in column t, as a variant."""
    return F.try_variant_get("t", f"$.{key}", "variant")


def damage(logs: DataFrame, text: str = "value") -> DataFrame:
    """level, n of the elements that `flatten` leaves out: log, user, conversation, turn."""
    return levels(logs, text).where("bad is not null").groupBy(F.col("bad").alias("level")).agg(F.count(F.lit(1)).alias("n"))


def flatten(logs: DataFrame, text: str = "value", file: str | None = None) -> DataFrame:
    """One row per turn of JSON logs (or of single users), one per row in column `text`.

    A conversation without an id is named by its user and place. `ordinal` keeps the order of a log's turns. Elements
    that are no objects are left out, see `damage`.
    """
    rows = levels(logs, text, file).where("bad is null and place is not null")
    known = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown"))
    user = masked(F.col("user_id"))
    return rows.select(
        F.col("user_id").alias("user_id_raw"),
        user.alias("user_id"),
        F.coalesce("db_login_id", F.lit("")).alias("login_id"),
        known("db_dept_name").alias("dept"),
        known("db_job_name").alias("job_name"),
        known("job_grade").alias("job_grade"),
        known("db_position_name").alias("position"),
        F.coalesce(F.nullif(F.col("c_id"), F.lit("")), F.concat(user, F.lit("#"), F.col("conv_no").cast("string"))).alias("conversation_id"),
        F.coalesce(F.try_variant_get("t", "$.turn", "int"), F.lit(-1)).alias("turn"),
        as_text(_at("timestamp")).alias("timestamp"),
        as_text(_at("user_question")).alias("user_question"),
        as_text(_at("llm_response")).alias("llm_response"),
        passages(_at("retrieved_data")).alias("retrieved"),
        as_bool(_at("trace_matched")).alias("trace_matched"),
        *[
            x
            for kind in ("eval", "emotion")
            for x in (
                as_text(_at(f"llm_{kind}_result")).alias(f"{kind}_result"),
                as_float(_at(f"llm_{kind}_score")).alias(f"{kind}_score"),
                as_float(_at(f"llm_{kind}_score_top1")).alias(f"{kind}_score_top1"),
                alternatives(_at("llm_alternatives" if kind == "eval" else "llm_emotion_alternatives")).alias(f"{kind}_alternatives"),
            )
        ],
        F.struct("file", "user_no", "conv_no", "place").alias("ordinal"),
    )


def read(spark: SparkSession, path: str, lines: bool = False, large: bool = False) -> DataFrame:
    """Turns of the logs under a path: one JSON document a file, with `lines` one log or user a line.

    With `large` a document is cut into its users by the tasks that read it, so that one file may be of any size.
    """
    if large:
        return flatten(large_log.users(spark, path), file="place")
    return flatten(spark.read.text(path, wholetext=not lines))


def legacy_cases(logs: DataFrame, text: str = "value") -> DataFrame:
    """Cases of logs whose turns are paired already: pre_queries, llm_ans_on_last_q, current_query, rag_data.

    Queries and passages may be a list or a text; a turn's other keys are as in `flatten`.
    """
    turn = "struct<turn:int,pre_queries:variant,llm_ans_on_last_q:string,current_query:string,rag_data:variant>"
    user = f"struct<{','.join(f'{k}:string' for k in USER_KEYS)},conversations:array<struct<conversation_id:string,turns:array<{turn}>>>>"
    users = logs.select(F.explode(F.from_json(F.col(text), f"struct<analysis_results:array<{user}>>")["analysis_results"]).alias("u"))
    rows = users.select(*[F.col(f"u.{k}") for k in USER_KEYS], F.explode("u.conversations").alias("c")).select("*", F.explode("c.turns").alias("t"))
    known = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown"))
    queries = F.col("t.pre_queries")
    asked = F.when(_kind(queries).startswith("ARRAY"), F.try_variant_get(queries, "$", "array<string>")).when(_kind(queries) == "STRING", F.array(_string(queries)))
    user_id = masked(F.col("user_id"))
    return rows.select(
        F.concat_ws(":", user_id, "c.conversation_id", F.col("t.turn").cast("string")).alias("case_id"),
        F.col("user_id").alias("user_id_raw"), user_id.alias("user_id"), F.coalesce("db_login_id", F.lit("")).alias("login_id"), known("db_dept_name").alias("dept"), known("job_grade").alias("job_grade"),
        known("db_job_name").alias("job_name"), known("db_position_name").alias("position"), F.col("c.conversation_id").alias("conversation_id"), F.col("t.turn").alias("turn"),
        F.coalesce(asked, F.array().cast("array<string>")).alias("pre_queries"), F.coalesce("t.llm_ans_on_last_q", F.lit("")).alias("llm_ans_on_last_q"),
        F.coalesce("t.current_query", F.lit("")).alias("current_query"), passages(F.col("t.rag_data")).alias("rag_chunks"),
    )
