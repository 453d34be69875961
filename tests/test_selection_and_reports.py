"""Filters, turn lists, contract, survey, BI tables, hierarchies, scores, settings and the command line."""

import json
import math

import pytest
from pyspark.sql import functions as F

from convolens import cli, config
from convolens.functions import labels
from convolens.operators import bi, cases, contracts, filters, hierarchy, output, scoring, survey, turnlist
from convolens.plans import classify, judging
from convolens.sources import conversation_log, synthetic

TABLE = labels.parse_table("# good\nA. Satisfied (fine) -> 90\n- B. Very Bad (bad, worse) -> 10.5\nno label\n")


def log(*users):
    return json.dumps({"metadata": {"total_users": 2, "total_turns": 9}, "users": list(users)})


def turn(n, rated=None, score=None, **more):
    return {"turn": n, "timestamp": f"2026-01-0{n} 09:00", "user_question": f"q{n}", "llm_response": f"a{n}", "retrieved_data": '["p"]', "trace_matched": "true", "llm_eval_result": rated, "llm_eval_score": score} | more


@pytest.fixture(scope="module")
def logs(spark):
    one = {"user_id": "u1", "db_dept_name": "Sales", "job_grade": "G1", "conversations": [{"conversation_id": "x", "turns": [turn(1), turn(2, "A. Satisfied", 80), turn(3, "fine", "30")]}, {"turns": [turn(1, "B"), turn(3, "B", 5, llm_alternatives=[{"label": "A", "probability": 0.5}, {"label": "B", "probability": 0.5}])]}]}
    two = {"user_id": "u2", "db_dept_name": "Plant", "conversations": [{"conversation_id": "x", "turns": [turn(1), turn(2, "B", None, trace_matched="false", odd=1)]}]}
    return spark.createDataFrame([(log(one, two),)], "value string")


@pytest.fixture(scope="module")
def turns(logs):
    return conversation_log.flatten(logs).cache()


def test_label_tables(spark):
    assert TABLE["B"] == labels.Label("B", "Very Bad", 10.5, "good", ("bad", "worse"))
    assert labels.resolve_all(["A", "worse", "Z. satisfied", "what"], TABLE) == ({"A", "B"}, ["what"])
    assert labels.table_frame(spark, TABLE).count() == 2


def test_filter_parts():
    assert filters.turn_buckets(["1-5 턴", "10~6", "51 턴 이상", "3 이하", "4", "2-", "제2조 3-5 턴", "3 이상 5 이하", "1 2", "", "x"]) == [(1, 5), (6, 10), (51, math.inf), (1, 3), (4, 4), (2, 2), (3, 5), (3, math.inf)]
    assert filters.as_range("12") is None and filters.as_range([2, "1"]) == (1.0, 2.0)
    assert filters.parse({"query_scores": {"A": "x", "B": "7"}}, TABLE, TABLE).scores == {"A": 90.0, "B": 7.0}
    with pytest.raises(filters.LabelTableMissing):
        filters.parse({"eval_labels": ["no such"], "query_scores": {"A": 1}}, {}, {}, placeholders=True)
    assert filters.as_set("전체") == filters.as_set(None) == set() and filters.as_set({"a": {}}) == {"a"} and filters.as_set(["a ", "all"]) == {"a"}
    assert filters.as_range([5, "1"]) == (1.0, 5.0) and filters.as_range([1]) is None and filters.as_range("ab") is None
    with pytest.raises(filters.LabelTableMissing):
        filters.parse({"state": {"eval_labels": ["A"]}}, TABLE, TABLE, placeholders=True)


def test_filter_steps_and_cases(turns):
    raw = {"name": "f", "state": {"role": "전체", "org_tree": {"db_dept_name": ["Sales"]}, "turn": ["2-3"], "use_date": True, "start_date": "2026-01-02", "eval_range": [0, 60], "eval_labels": ["satisfied", "nobody"]}}
    spec = filters.parse(raw, TABLE, TABLE)
    found, steps = filters.select(turns, spec, TABLE, TABLE)
    assert spec.unknown_labels == ["nobody"]
    assert [(r.step, r.remaining, r.dropped) for r in steps.orderBy("position").collect()] == [("follow-up with a prior turn", 3, 2), ("dept", 2, 1), ("turn", 2, 0), ("date", 2, 0), ("eval score", 1, 1), ("eval label", 1, 0)]
    case = found.first()
    assert (case.turn, case.pre_queries, case.llm_ans_on_last_q, case.rag_chunks) == (3, ["q1", "q2"], "a2", ["p"])
    assert filters.select(turns, filters.FilterSpec(), TABLE, TABLE, limit=2)[0].count() == 2
    scored = filters.scored(turns, spec, TABLE).where("size(eval_alternatives) > 0").first()
    assert scored.eval_expected == pytest.approx(50.25)
    steps, first = filters.preview(turns, eval_labels={"B"}, most_eval=100)
    assert [r.remaining for r in steps.orderBy("position").collect()] == [3, 1, 0] and first.count() == 0


def test_turn_lists(spark, turns, tmp_path):
    path = tmp_path / "list"
    path.write_text('{"conv_id": "x", "turn": 2, "user_id": "u1"}\n\n{"conversation_id": "x", "turn": 2}\n{"conversation_id": "x", "turn": 9, "user_id": "u2"}\n{"conversation_id": "n", "turn": 2}\n{"conversation_id": "x", "turn": 1, "user_id": "u2"}\n')
    refs = turnlist.read(spark, str(path))
    assert {r.place: r.status for r in turnlist.resolve(turns, refs).collect()} == {0: "ok", 1: "ambiguous", 2: "no_turn", 3: "missing", 4: "no_prior"}
    with pytest.raises(ValueError, match="several users"):
        turnlist.select(turns, refs)
    assert {r.step: (r.n_left, r.n_dropped) for r in turnlist.steps(turnlist.resolve(turns, refs)).collect()} == {"listed": (5, 0), "not in the log": (3, 2), "no prior turn": (2, 1)}
    # a user id that fits nobody leaves the decision to the conversation
    strange = refs.withColumn("user_id", F.lit("nobody"))
    assert {r.status for r in turnlist.resolve(turns, strange).collect()} == {"ambiguous", "missing"}
    single = turns.where(F.col("user_id_raw") == "u1")
    assert {r.place: r.status for r in turnlist.resolve(single, strange).collect()}[0] == "ok"
    assert turnlist.select(turns, refs.where("place <> 1"), limit=1)[0].count() == 1
    rows, status = turnlist.select(turns, refs.where("place <> 1"))
    assert [r.current_query for r in rows.collect()] == ["q2"] and status.count() == 4
    for text, said in (("", "no turns"), ('{"turn": 1}', ":1: conversation_id"), ("{", ":1"), ("[5]", "0.: an object")):
        path.write_text(text)
        with pytest.raises(ValueError, match=said):
            turnlist.read(spark, str(path))
    path.write_text('[{"conversation_id": 5, "turn": "2"}]')
    assert [(r.conversation_id, r.turn) for r in turnlist.read(spark, str(path)).collect()] == [("5", 2)]


def test_contract(spark, logs):
    found = {(r.layer, r.field, r.kind): (r.n, r.note) for r in contracts.report(logs).collect()}
    assert found["turn", "odd", "unknown"] == (1, "") and ("conversation", "conversation_id", "missing") not in found and found["turn", "llm_eval_score", "type"] == (1, "str")
    assert ("turn", "turn", "range") not in found and ("turn", "llm_eval_score", "null") not in found
    assert {r.layer: r.n for r in contracts.shape(logs).collect()} == {"user": 2, "conversation": 3, "turn": 7}
    bad = spark.createDataFrame([(json.dumps({"data": [{"user_id": "", "conversations": [{"conversation_id": "c", "turns": [turn(0, score=200, retrieved_data=7)]}]}]}),)], "value string")
    found = {(r.field, r.kind): r.n for r in contracts.report(bad).collect()}
    assert found["user_id", "null"] == 1 and found["turn", "range"] == 1 and found["llm_eval_score", "range"] == 1 and found["retrieved_data", "type"] == 1


def test_survey(spark, turns):
    got = survey.shape(turns).first()
    assert (got.users, got.conversations, got.turns, got.followups) == (2, 3, 7, 5)
    declared = spark.createDataFrame([(2, 9)], "total_users long, total_turns long")
    assert {r.kind: (r.declared, r.actual, r.same) for r in survey.against_declared(turns, declared).collect()} == {"users": (2, 2, True), "turns": (9, 7, False)}
    assert {r.issue: r.n for r in survey.integrity(turns).collect()} == {"trace_inconsistent": 1, "turn_numbering": 1, "eval_on_first_turn": 1}
    report = survey.report(turns)
    assert report["retrieval"].first().empty == 0 and {r.label: r.n for r in report["dept"].collect()} == {"Sales": 2, "Plant": 1}
    assert all(x.count() >= 0 for x in report.values())


@pytest.fixture(scope="module")
def flat(spark):
    rows = cases.to_cases(cases.paired(conversation_log.flatten(synthetic.log(spark, 30))).where(cases.is_followup()))
    rule = {"question_self_contained": True, "question_answerable_as_asked": True, "answer_covers_all_intents": True, "answer_actionable": True, "complaint_target": "content_missing", "question_domain": "domain", "unmet_need": "n"}
    judge = judging.StubJudge({"observe": {"": rule, "12 * 12": {"fail": "x"}}, "sufficiency": {"": {"verdict": "insufficient", "missing": "the form", "evidence": [{"chunk_index": 0, "quote": "a quote that is invented"}]}}})
    return bi.flat(output.nest(classify.classify(rows, judge))).cache()


def test_bi_tables(spark, flat):
    n = flat.count()
    assert len(flat.columns) == 25 and n > 30
    health = bi.health(flat).first()
    assert health.n == n and health.error > 0 and health.n_dropped > 0 and health.low_share == 0.0
    table = bi.crosstab(flat, "dept").collect()
    assert table[0].dept == "(all)" and table[0].total == n == sum(r.total for r in table[1:]) and [r.total for r in table[1:]] == sorted([r.total for r in table[1:]], reverse=True)
    assert all(sum(r[c] for c in r.asDict() if c not in ("dept", "total")) == r.total for r in table)
    assert bi.narrow(flat, {"dept": None}).count() == n and bi.narrow(flat, {"dept": set()}).count() == 0 and 0 < bi.narrow(flat, {"dept": {"sales"}}, search="TRAVEL").count() < n
    scores = [r.suspicion for r in bi.ordered(flat, "suspect").collect()]
    assert scores == sorted(scores, reverse=True) and scores[0] >= 4
    assert [bi.ordered(flat, x).count() for x in ("case", "confidence", "log")] == [n] * 3
    gap = bi.gaps(flat).first()
    assert gap.need == "n" and gap.n == flat.where("case_id = 'case20'").count()
    assert sum(r.n for r in bi.stacked(flat).collect()) == n and bi.failures(flat).count() > 0 and bi.kinds(flat).count() > 1


def test_hierarchy_files(spark, flat, tmp_path):
    path = tmp_path / "org.json"
    path.write_text(json.dumps({"whatever": [{"name": "HQ", "subclasses": [{"name": "Money", "items": ["Sales ", "FINANCE", "", 5]}]}, {"name": "Site", "subclasses": [{"name": "Works", "items": ["plant"]}]}]}))
    tree = hierarchy.read(spark, str(path))
    assert tree.count() == 3
    placed = {r.dept: (r.major, r.middle) for r in hierarchy.attach(flat, "dept", tree).select("dept", "major", "middle").distinct().collect()}
    assert placed["sales"] == ("HQ", "Money") and placed["legal"] == (hierarchy.UNMAPPED, hierarchy.UNMAPPED)
    rows, options = hierarchy.cascade(flat, "dept", tree, major={"HQ"}, middle={"Works"})
    assert options["middle"] == ["Money"] and options["item"] == [] and rows.count() == 0
    rows, options = hierarchy.cascade(flat, "dept", tree, major={"Site"})
    assert options["item"] == ["plant"] and rows.count() == flat.where("dept = 'plant'").count()
    frame = spark.createDataFrame([("Sales ", "x"), ("plant", "y"), ("z", "plant")], "a string, b string")
    assert hierarchy.detect_field(frame.withColumn("a", F.trim("a")), ["b", "a"], tree) == "a" and hierarchy.detect_field(frame, ["b"], tree) is None


def test_scores(spark):
    rows = spark.createDataFrame([(1, "tone", True, ["tone", "format"], True), (2, "none", False, ["tone"], True), (3, "x", None, None, False)], "id int, target string, multi boolean, e_target array<string>, e_multi boolean")
    found = [(r.field, r.n, r.hits) for r in scoring.fields(rows, {"target": "e_target", "multi": "e_multi"}).collect()]
    assert found == [("multi", 3, 1), ("target", 2, 1)]
    assert {r.id: r.missed for r in scoring.misses(rows, "id", {"target": "e_target", "multi": "e_multi"}).collect()} == {1: [], 2: ["target", "multi"], 3: ["multi"]}
    judged = spark.createDataFrame([("partial", "partial", [0, 2], [2], 0), ("sufficient", "partial", [1], [3], 1), ("insufficient", "insufficient", [], [], 0)], "v string, e string, c array<int>, w array<int>, d int")
    assert tuple(scoring.citations(judged, "v", "e", "c", "w", "d").first()) == (3, 2, 2, 1, 1)
    traps = spark.createDataFrame([("t", "rag_insufficient", ["rag_sufficient_other"], True, True), ("t", "rag_sufficient_other", ["rag_insufficient", "rag_partial"], True, False), ("s", "out_of_scope", ["out_of_scope"], False, False)], "trap string, label string, ok array<string>, flag boolean, e boolean")
    got = {r.trap: tuple(r)[1:] for r in scoring.by_trap(traps, "trap", "label", "ok", "flag", "e").collect()}
    assert got[None] == (3, 1, 1, 1, 2) and got["t"] == (2, 0, 1, 1, 1)
    health = spark.createDataFrame([(True, 2, False, ["a"]), (False, 0, True, ["a", "b", "c"])], "citation_failed boolean, n_dropped int, context_dependent boolean, rag_chunks array<string>")
    assert tuple(scoring.legacy_health(health).first()) == (2, 1, 2, 1, 2.0, 1, True)


def test_older_truth_table(spark):
    rows = [("sufficient", 0, "used", "content", "rag_insufficient"), ("partial", 1, None, "content", "rag_partial"), ("sufficient", 1, None, "content", "error"), ("sufficient", 1, "ignored", "content", "rag_sufficient_generation_failed"), ("sufficient", 2, "used", "content", "rag_sufficient_other"), (None, None, None, "content", "error"), (None, None, None, "other", "unclassified"), (None, None, None, "format_or_style", "out_of_scope")]
    frame = spark.createDataFrame(rows, "v string, k int, g string, c string, e string")
    assert frame.where(~classify.decide(F.col("v"), F.col("k"), F.col("g"), F.col("c")).eqNullSafe(F.col("e"))).count() == 0


def test_older_logs(spark):
    raw = {"analysis_results": [{"user_id": "u", "conversations": [{"conversation_id": "c", "turns": [{"turn": 2, "pre_queries": "one", "llm_ans_on_last_q": "a", "current_query": "q", "rag_data": "p1\n\np2"}, {"turn": 3, "pre_queries": ["x", "y"], "rag_data": [{"text": "t"}]}]}]}]}
    rows = conversation_log.legacy_cases(spark.createDataFrame([(json.dumps(raw),)], "value string")).orderBy("turn").collect()
    assert [(r.pre_queries, r.rag_chunks, r.current_query) for r in rows] == [(["one"], ["p1", "p2"], "q"), (["x", "y"], ["t"], "")]


def test_settings(tmp_path):
    path, env = tmp_path / "c.json", tmp_path / "env"
    path.write_text(json.dumps({"judge": {"max_tokens": 500, "url": ""}, "limit": 3}))
    env.write_text("# x\nexport LLM_API_URL='host:8000/v1/chat/completions'\n")
    got = config.load(str(path), {"limit": 5, "output_dir": None}, str(env), {"LLM_API_KEY": "k"})
    assert (got.judge_max_tokens, got.limit, got.judge_url, got.judge_key, got.output_dir) == (500, 5, "http://host:8000/v1", "k", "output")
    with pytest.raises(ValueError) as e:
        config.load(None, {"limt": 1, "limit": True, "judge.backend": "x", "judge.timeout": 0}, environment={})
    assert "did you mean limit" in str(e.value) and str(e.value).count(";") == 3


def test_command_line(spark, tmp_path):
    path = tmp_path / "log.json"
    path.write_text(synthetic.log(spark, 1, seed=3).first().value)
    assert cli.main([], spark=spark) == 2 and cli.main(["--input", str(path), "--filter", str(tmp_path / "none")], spark=spark) == 2
    assert cli.main(["--dry-run"], spark=spark) == 0
    assert cli.main(["--input", str(path), "--output-dir", str(tmp_path / "out")], spark=spark) == 0
    assert bi.newest(str(tmp_path / "out")) and bi.newest(str(tmp_path / "nothing")) is None
    assert cli.main(["--input", str(path), "--output-dir", str(tmp_path / "out2")], judge=judging.StubJudge({"observe": {"": {"fail": "x"}}}), spark=spark) == 1
