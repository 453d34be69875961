"""Answer checks, log source, routing and streaming windows on planted rows."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from convolens.functions import answer_checks as checks
from convolens.functions import labels
from convolens.plans import routing
from convolens.sources import conversation_log
from convolens.streaming import windows


def value(spark, check, *texts):
    frame = spark.createDataFrame([texts], ", ".join(f"c{i} string" for i in range(len(texts))))
    return frame.select(check(*[F.col(c) for c in frame.columns]).alias("v")).first().v


@pytest.mark.parametrize(
    ("text", "verdict"),
    [
        (None, "na"), ("no sums", "na"), ("1 + 2 * 3 = 7", "ok"), ("10 / 4 - 1 = 1.5", "ok"), ("1,000 × 2 = 2,001", "violated"), ("8 ÷ 0 = 1", "ok"), ("007 + 1 = 9", "ok"), ("2 - 5 + 4 = 1", "ok"),
    ],
)
def test_arithmetic(spark, text, verdict):
    assert value(spark, checks.arithmetic, text) == verdict


@pytest.mark.parametrize(
    ("text", "verdict"),
    [
        (None, "na"), ("2024-02-29", "ok"), ("2023-02-29", "violated"), ("1900-02-29", "violated"), ("2월 29일", "undetermined"), ("2월 30일", "violated"), ("0000-01-01", "violated"), ("2026/4/31", "violated"),
        ("2026-11-26은 목요일", "ok"), ("2026년 11월 26일 금요일", "violated"), ("11월 26일 목요일", "undetermined"), ("2000-01-01 토요일", "ok"), ("13월 1일", "violated"),
    ],
)
def test_dates(spark, text, verdict):
    assert value(spark, checks.dates, text) == verdict


@pytest.mark.parametrize(("text", "verdict"), [(None, "na"), ("```python\nx = 1\n```", "ok"), ("```py\nx = \n```", "violated"), ("```\ndef f(:\n```", "violated"), ("```sql\nselect\n```", "na")])
def test_python_syntax(spark, text, verdict):
    assert value(spark, checks.python_syntax, text) == verdict


@pytest.mark.parametrize(("text", "kind", "verdict"), [('```json\n{"a": 1}\n```', "json", "ok"), ('{"a": ', "json", "violated"), (None, "json", "violated"), ("x", None, "na"), ("x", "prose", "ok")])
def test_format(spark, text, kind, verdict):
    assert value(spark, checks.format_kept, text, kind) == verdict


def test_quotes_against_difflib(spark):
    """The window rule equals the longest common run over the quote's length, for quotes and passages that differ a little."""
    from difflib import SequenceMatcher

    passage = "thequickbrownfoxjumpsoverthelazydog"
    cases = [passage[a:b] + "#" * c for a in (0, 5) for b in (15, 25, 35) for c in range(5)] + ["##" + passage[3:30], "aaaaaaaaaa"]
    rows = spark.createDataFrame([(q, passage) for q in cases], "q string, p string").select("q", checks.stands_in(F.col("q"), F.col("p")).alias("v")).collect()
    for r in rows:
        run = SequenceMatcher(None, r.q, passage, autojunk=False).find_longest_match().size
        assert r.v == (10 * run >= 9 * len(r.q)), r.q


def test_languages_and_full_width(spark):
    assert [value(spark, checks.detect_language, t) for t in ("hello", "안녕 hello", "こんにちは", "你好世界", "123", None)] == ["en", "ko", "ja", "zh", "unknown", "unknown"]
    assert value(spark, checks.normalised, "Ａｂ c　") == "abc" and value(spark, checks.normalised, None) == ""


def test_labels(spark):
    names = {"A": "Very good", "B": "Bad"}
    assert [value(spark, lambda c: labels.resolve(c, names), t) for t in ("A. x", "b", " VERY  good", "C) bad", "", None)] == ["A", "B", "A", "B", None, None]


def test_log_absorbs_dirty_values(spark):
    turn = {"turn": "2", "user_question": "q", "trace_matched": "Y", "llm_eval_score": "x", "retrieved_data": json.dumps([{"content": "p1"}, "p2", " "]), "llm_alternatives": [{"lable": "A", " probability": 0.5}]}
    log = {"analysis_results": [{"user_id": "u", "conversations": [{"turns": [turn, {"turn": None, "retrieved_data": "a\n\nb\nc"}]}]}, {"user_id": None, "conversations": None}]}
    frame = spark.createDataFrame([(json.dumps(log),), ("no json",), (None,), ("{}",)], "value string")
    first, second = conversation_log.flatten(frame).orderBy(F.desc_nulls_last("turn")).collect()
    assert (first.conversation_id, first.turn, first.trace_matched, first.eval_score, first.retrieved) == (f"u_{hashlib.sha256(b'u').hexdigest()[:12]}#0", 2, True, None, ["p1", "p2"])
    assert [(a.label, a.probability) for a in first.eval_alternatives] == [("A", 0.5)]
    assert (second.turn, second.retrieved, second.eval_alternatives) == (-1, ["a", "b\nc"], [])


def test_routing_order(spark):
    def case(**given):
        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in ({"answerable": True, "self_contained": True} | given).items()])
        found = routing.route(row).first()
        return found.case, found.secondary

    assert case(service_error="violated", answer_refused=True)[0] == "case9"
    assert case(target="format", format="violated", pii="violated", truncated="violated") == ("case8", ["case6", *()])
    assert case(target="other", domain="domain") == ("unclassified", [])
    assert case(target="content_wrong", domain="calculation", dates="violated") == ("case26", [])
    assert case(target="tone", multi_intent=True) == ("case16", ["case3", "case15"])


def test_streamed_windows_equal_batch(spark, tmp_path):
    source = "/root/testdata/sf0.001/events.parquet"
    batch = spark.read.parquet(source)
    batch.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    query = windows.tumbling(stream, "ts", "event_type", "1 day").writeStream.format("memory").queryName("tumbled").outputMode("complete").option("checkpointLocation", str(tmp_path / "state")).start()
    query.processAllAvailable()
    query.stop()
    assert sorted(spark.table("tumbled").collect()) == sorted(windows.tumbling(batch, "ts", "event_type", "1 day").collect())


def test_log_keeps_json_types_apart(spark):
    values = [("1", None, 1.0), ("true", True, 1.0), ('"1"', True, 1.0), ('" No "', False, None), ("0.5", None, 0.5), ("null", None, None), ('"x"', None, None), ("[1]", None, None)]
    rows = spark.createDataFrame([(v,) for v, *_ in values], "v string").select("v", F.parse_json("v").alias("j"))
    got = {r.v: (r.b, r.f) for r in rows.select("v", conversation_log.as_bool(F.col("j")).alias("b"), conversation_log.as_float(F.col("j")).alias("f")).collect()}
    assert got == {v: (b, f) for v, b, f in values}


def test_passages_of_all_shapes(spark):
    given = {
        '["a", {"text": "", "content": "b"}, {"other": 1}, " ", 5]': ["a", "b", "5"], '"one\\n\\ntwo\\nlines"': ["one", "two\nlines"], '"x\\ny"': ["x", "y"], '"[\\"p\\", {\\"chunk\\": \\"q\\"}]"': ["p", "q"],
        '"\\"scalar\\""': ["scalar"], '"{\\"text\\": \\"t\\"}"': ["t"], "null": [], '""': [], '"[]"': [], '"[broken"': ["[broken"], "7": ["7"],
    }
    rows = spark.createDataFrame([(v,) for v in given], "v string").select("v", conversation_log.passages(F.parse_json("v")).alias("p")).collect()
    assert {r.v: r.p for r in rows} == given


def test_wide_figures_and_blanks(spark):
    texts = {"2026년 2월 30일": "violated", "２０２６년 ２월 ２８일": "ok", "2026-02-30": "violated"}
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", checks.dates(F.col("t")).alias("v")).collect()
    assert {r.t: r.v for r in rows} == texts
    lists = [("１. a\n２. b", "numbered_list", True), ("• a\n• b", "bullet_list", True), ('{"a":1}\n```', "json", False), ('```json\n{"a":1}\n```', "json", True)]
    lists += [(t, "json", e) for t, e in (('{"a":1} x', False), ('{"a":1,"a":2}', True), ('{"a":NaN}', True), ("[1,2", False), ("5", True), ('"x"', True), ('1,"y":2', False), ("1,2", False), ("{'a':1}", False), ("", False), (None, False), ('],"z":[', False))]
    got = spark.createDataFrame(lists, "t string, k string, e boolean").select("e", checks.has_format(F.col("t"), F.col("k")).alias("v")).collect()
    assert all(r.e == r.v for r in got), [r for r in got if r.e != r.v]
