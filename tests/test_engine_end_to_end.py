"""Log, cases, checks, judge, citations, routing and output in one run with a stub judge."""

import json

import pytest
from pyspark.sql import functions as F

from convolens.functions import citations
from convolens.operators import cases, output
from convolens.plans import classify, judging, taxonomy
from convolens.sources import conversation_log, synthetic

SCHEMA = "case_id string, user_id string, user_id_raw string, login_id string, dept string, job_grade string, job_name string, position string, conversation_id string, turn int, eval_result string, ordinal long, pre_queries array<string>, llm_ans_on_last_q string, current_query string, rag_chunks array<string>"
PASSAGE = "[Rules 7] Every request needs the approval of two managers before Friday."


def case(i, answer, reaction, chunks=(), asked=("q",)):
    return (f"u:c{i}:2", "u", "raw", "", "d", "g", "j", "p", f"c{i}", 2, "A", i, list(asked), answer, reaction, list(chunks))


RULES = {
    "observe": {
        "WANTTABLE": {"complaint_target": "format", "requested_format": "table"},
        "LACKS": {"complaint_target": "content_missing", "question_domain": "domain", "unmet_need": "the deadline"},
        "THANKS": {"complaint_target": "none", "complaint_quote": "THANKS A LOT"},
        "INVENTED": {"complaint_target": "none", "complaint_quote": "never written"},
        "BOOM": {"fail": "no connection"},
        "NOISE": {"garbage": "I would say it is fine"},
    },
    "sufficiency": {
        "CITED": {"verdict": "sufficient", "evidence": [{"chunk_index": 4, "quote": "approval of  two managers before Friday"}, {"chunk_index": 0, "quote": "short"}]},
        "UNCITED": {"verdict": "sufficient", "evidence": [{"chunk_index": 0, "quote": "words that no passage has at all"}]},
    },
    "grounding": {"IGNORES": {"answer_used_rag": "ignored"}},
}


def base():
    return {"question_self_contained": True, "question_answerable_as_asked": True, "answer_covers_all_intents": True, "answer_actionable": True, "answer_used_history": "not_needed"}


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    rules = {"observe": {"": base()} | RULES["observe"]} | {k: v for k, v in RULES.items() if k != "observe"}
    rows = [
        case(1, "서비스에 문제가 있거나, 사용자 분들이 많아서 서버에 부하가 걸리고 있어요", "x"),
        case(2, "Here you are.", "WANTTABLE please"),
        case(3, "No idea.", "LACKS all"),
        case(4, "CITED IGNORES this.", "LACKS CITED", [PASSAGE + " CITED", "other"]),
        case(5, "UNCITED this.", "LACKS UNCITED", ["UNCITED something else"]),
        case(6, "Fine.", "THANKS A LOT"),
        case(7, "Fine.", "INVENTED"),
        case(8, "Fine.", "BOOM"),
        case(9, "Fine.", "NOISE"),
        case(10, "Here you are.", "WANTTABLE please"),
    ]
    cache = str(tmp_path_factory.mktemp("cache") / "answers")
    frame = spark.createDataFrame(rows, SCHEMA)
    first = {r.conversation_id: r for r in classify.classify(frame, judging.StubJudge(rules), cache).collect()}
    return frame, rules, cache, first


def test_cases_and_confidences(results):
    _, _, _, first = results
    found = {k: (r.classification.case_id, r.classification.confidence) if r.classification else None for k, r in first.items()}
    assert found == {
        "c1": ("case9", "high"), "c2": ("case12", "high"), "c3": ("case21", "high"), "c4": ("case22", "medium"), "c5": ("case20", "medium"), "c6": ("case0", "medium"), "c7": ("unclassified", "low"),
        "c8": None, "c9": None, "c10": ("case12", "high"),
    }


def test_errors_are_data_and_calls_are_counted(results):
    _, _, _, first = results
    assert first["c8"].error == "[observe] RuntimeError: no connection" and first["c9"].error.startswith("[observe] ValueError: no valid answer in 3 attempts")
    assert [first[f"c{i}"].llm_calls for i in (1, 3, 4, 5, 6)] == [0, 1, 3, 2, 1]
    assert first["c2"].llm_calls + first["c10"].llm_calls == 1  # one prompt, put once
    assert list(first["c1"].checks) == ["service_error"] and len(first["c2"].checks) == 12


def test_second_run_asks_only_what_failed(spark, results):
    frame, rules, cache, first = results
    again = {r.conversation_id: r for r in classify.classify(frame, judging.StubJudge(rules), cache).collect()}
    assert {k: r.classification for k, r in again.items()} == {k: r.classification for k, r in first.items()}
    assert sum(r.llm_calls for r in again.values()) == 2 and again["c8"].error == first["c8"].error


def test_citations_are_verified(results):
    _, _, _, first = results
    kept, short = first["c4"].citation
    assert (kept.chunk_index, kept.ratio, kept.index_corrected, kept.reason) == (0, 1.0, True, None) and short.reason == "too_short"
    assert first["c5"].citation[0].reason == "not_found" and first["c6"].complaint.verified and not first["c7"].complaint.verified


def test_ratio_against_difflib(spark):
    rows = spark.createDataFrame([("approval of two managers", PASSAGE), ("Approval of three managers", PASSAGE), ("", PASSAGE), (None, None)], "q string, p string")
    got = [r.r for r in rows.select(citations.match_ratio(F.col("q"), F.col("p")).alias("r")).collect()]
    assert got[0] == 1.0 and 0 < got[1] < 0.9 and got[2:] == [0.0, 0.0]


def test_output_nests_and_sums(spark, results, tmp_path):
    frame, rules, cache, first = results
    done = classify.classify(frame, judging.StubJudge(rules), cache)
    output.write_nested(done, str(tmp_path / "nested"))
    users = [json.loads(x) for f in sorted((tmp_path / "nested").glob("*.json")) for x in f.read_text().splitlines()]
    assert len(users) == 1 and [c["conversation_id"] for c in users[0]["conversations"]] == [f"c{i}" for i in range(1, 11)]
    blocks = {c["conversation_id"]: c["turns"][0]["classification"] for c in users[0]["conversations"]}
    assert list(blocks["c8"]) == ["error"] and blocks["c4"]["evidence"]["sufficiency"]["evidence"][0]["index_corrected"] and blocks["c4"]["answered_turn"] == 1
    assert all(c["verdict"] != "na" for b in blocks.values() if "evidence" in b for c in b["evidence"]["checks"])
    assert users[0]["user_id"] == "u" and output.nest(done, raw_ids=True).first().user_id == "raw"
    parts = output.summary(done)
    assert [(r.label, r.n) for r in parts["case"].orderBy("rank").limit(2).collect()] == [("case12", 2), ("case9", 1)]
    one = parts["totals"].first()
    assert (one.n, one.n_classified, one.n_failed) == (10, 8, 2) and [(r.stage, r.n) for r in parts["stages"].collect()] == [("observe", 2)]
    text = output.render(done)
    assert all(output.display_width(x) <= 80 for x in text.splitlines()) and "case12" in text


def test_run_from_a_log(spark):
    turns = conversation_log.flatten(synthetic.log(spark, 40))
    smaller = conversation_log.flatten(synthetic.log(spark, 10)).drop("ordinal")
    assert smaller.exceptAll(turns.drop("ordinal")).count() == 0
    rows = cases.to_cases(cases.paired(cases.flags(turns)).where(cases.is_followup()))
    done = classify.classify(rows, judging.StubJudge({"observe": {"": base() | {"complaint_target": "content_wrong", "question_domain": "calculation"}}}))
    found = {r.llm_ans_on_last_q[:6]: r.classification.case_id for r in done.collect()}
    assert found["12 * 1"] == "case26" and found["Access"] == "case8" and found["서비스에 문"] == "case9"
    assert rows.count() == turns.where("turn > 1").count()


def test_history_holds_the_last_questions(spark):
    rows = [("u", "c", t, o, q, "a", [], "") for o, (t, q) in enumerate([(1, "q1"), (2, ""), (3, "q3"), (3, "q3b"), (5, "q5")])]
    frame = spark.createDataFrame(rows, "user_id string, conversation_id string, turn int, ordinal long, user_question string, llm_response string, retrieved array<string>, eval_result string")
    got = {(r.turn, r.ordinal): (r.pre_queries, r.has_prior) for r in cases.paired(frame, 2).collect()}
    assert got == {(1, 0): ([], False), (2, 1): (["q1"], True), (3, 2): (["q1"], True), (3, 3): (["q1"], True), (5, 4): (["q3", "q3b"], False)}
    assert {r.turn: r.pre_queries for r in cases.paired(frame, 0).collect()}[5] == ["q1", "q3", "q3b"]


def test_taxonomy(spark):
    rows = spark.createDataFrame([(c,) for c in ("case10", "unclassified", "case2", "case20")], "case_id string")
    named = taxonomy.describe(rows).orderBy(taxonomy.sort_key(F.col("case_id"))).collect()
    assert [r.case_id for r in named] == ["case2", "case10", "case20", "unclassified"] and named[3].case_name == "unclassified" and named[0].category == "category_1"
    old = spark.createDataFrame([(f"case{i}",) for i in (1, 7, 9, 15, 26, 30)], "c string").select(taxonomy.migrate(F.col("c")).alias("m")).collect()
    assert [r.m for r in old] == ["case1", None, "case8", "case18", "case29", None]


def test_json_answers_are_checked():
    assert judging.extract_json('<think>{"a": 0}</think> so {"a": "}"} done') == '{"a": "}"}'
    with pytest.raises(ValueError):
        judging.extract_json("none")
    good = judging.sample(judging.OBSERVATION)
    assert judging.problems(good, judging.OBSERVATION) == []
    assert len(judging.problems(good | {"complaint_target": "x", "requested_length_value": True, "more": 1}, judging.OBSERVATION)) == 3
    schema = judging.json_schema(judging.SUFFICIENCY)
    assert schema["additionalProperties"] is False and schema["properties"]["evidence"]["items"]["required"] == ["chunk_index", "quote"]
