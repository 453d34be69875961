"""The older run with a stub judge: steps that are skipped, one label a case, calls, a second run, rows without texts."""

import pytest

from convolens.plans import diagnosis, judging

SCHEMA = "case_id string, dept string, pre_queries array<string>, llm_ans_on_last_q string, current_query string, rag_chunks array<string>"
PASSAGE = "Every request needs the approval of two managers before Friday."
RULES = {
    "need": {
        "STYLE": {"complaint_type": "format_or_style"}, "ODD": {"complaint_type": "other"}, "HALF": {"unmet_need": "HALF"}, "ALL": {"unmet_need": "ALL", "complaint_type": "wrong_content"},
        "CLAIMED": {"unmet_need": "CLAIMED"}, "BOOM": {"fail": "no connection"},
    },
    "sufficiency": {
        "HALF": {"verdict": "partial", "evidence": [{"chunk_index": 0, "quote": "approval of two managers"}], "missing": "the form"},
        "ALL": {"verdict": "sufficient", "evidence": [{"chunk_index": 0, "quote": "approval of  two managers"}]},
        "CLAIMED": {"verdict": "sufficient", "evidence": [{"chunk_index": 0, "quote": "words that no passage has"}]},
    },
    "grounding": {"PASSED BY": {"answer_used_rag": "ignored"}, "AGAINST": {"answer_used_rag": "contradicted"}},
}
WANTED = {
    "a": ("out_of_scope", 1), "b": ("unclassified", 1), "c": ("rag_partial", 2), "d": ("rag_sufficient_other", 3), "e": ("rag_sufficient_generation_failed", 3), "f": ("rag_insufficient", 2),
    "g": (None, 0), "h": ("rag_insufficient", 2), "i": ("rag_sufficient_generation_failed", 3), "j": ("rag_insufficient", 2),
}


@pytest.fixture(scope="module")
def cases(spark):
    rows = [
        ("a", "x", "An answer.", "STYLE", [PASSAGE]),
        ("b", "x", "An answer.", "ODD", [PASSAGE]),
        ("c", "y", "An answer c.", "HALF c", [PASSAGE + " c"]),
        ("d", "x", "An answer d.", "ALL d", [PASSAGE + " d"]),
        ("e", "x", "PASSED BY e", "ALL e", [PASSAGE + " e"]),
        ("f", "x", "An answer f.", "CLAIMED f", [PASSAGE + " f"]),
        ("g", "x", "An answer g.", "BOOM", [PASSAGE]),
        ("h", "w", "An answer h.", "CLAIMED h", []),
        ("i", "x", "AGAINST i", "ALL i", ["nothing", PASSAGE + " i"]),
        ("j", None, None, None, None),
    ]
    return spark.createDataFrame([(a, b, ["q"], *rest) for a, b, *rest in rows], SCHEMA)


def test_labels_and_calls(cases, tmp_path):
    cache = str(tmp_path / "answers")
    first = {r.case_id: r for r in diagnosis.diagnose(cases, judging.StubJudge(RULES), cache).collect()}
    assert {k: (r.label, r.llm_calls if k != "g" else 0) for k, r in first.items()} == WANTED
    assert first["g"].error == "[need] RuntimeError: no connection" and all(r.error is None for k, r in first.items() if k != "g")
    assert first["i"].citation[0].index_corrected and first["j"].n_chunks == 0 and first["i"].n_chunks == 2
    again = {r.case_id: r for r in diagnosis.diagnose(cases, judging.StubJudge(RULES), cache).collect()}
    assert {k: r.label for k, r in again.items()} == {k: r.label for k, r in first.items()} and sum(r.llm_calls for k, r in again.items() if k != "g") == 0


def test_lacking_cases_come_by_department(cases):
    found = diagnosis.lacking(diagnosis.diagnose(cases, judging.StubJudge(RULES))).collect()
    assert [(r.dept, r.case_id, r.missing) for r in found] == [(None, "j", ""), ("w", "h", ""), ("x", "f", ""), ("y", "c", "the form")]


def test_no_cases(cases):
    done = diagnosis.diagnose(cases.limit(0), judging.StubJudge(RULES))
    assert done.count() == 0 and diagnosis.lacking(done).count() == 0
