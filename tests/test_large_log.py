"""Large documents cut into users by blocks, and logs with planted damage."""

import json
import random

import pytest

from convolens.sources import conversation_log, large_log


def document(rng, n, root="users"):
    def turn(i):
        return {"turn": i, "user_question": rng.choice(['say "}" now', "a { b [ c", "plain", "back\\slash \\\" }", "é☃ }"]), "llm_response": "x" * rng.randrange(200), "retrieved_data": json.dumps([{"text": 'p } "q"'}]), "extra": {"deep": [{}, [1, {"k": "}"}]]}}

    users = [{"db_dept_name": f"d{i % 3}", "user_id": f"u{i}", "conversations": [{"conversation_id": f"c{i}", "turns": [turn(t) for t in range(rng.randrange(4))]}]} for i in range(n)]
    return {"metadata": {"users": [{"user_id": "not one"}], "list": [[{"a": 1}]]}, "other": [{"user_id": "no"}], root: users, "tail": {"data": [{"user_id": "none"}]}}


@pytest.mark.parametrize(("root", "block", "indent", "n"), [("users", 1999, None, 30), ("data", 97, 1, 3), ("analysis_results", 10**7, None, 30)])
def test_users_of_a_document_in_many_blocks(spark, tmp_path, root, block, indent, n):
    rng = random.Random(block)
    docs = [document(rng, k, root) for k in (n, 0, 2)]
    for i, doc in enumerate(docs):
        (tmp_path / f"{i}.json").write_text(json.dumps(doc, ensure_ascii=False, indent=indent))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        got = large_log.users(spark, str(tmp_path)).collect()
        large = conversation_log.read(spark, str(tmp_path), large=True)
        turns = sorted(tuple(r) for r in large.select("conversation_id", "turn", "user_question", "retrieved").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    in_order = sorted((r.place.file, r.place.number, r.value) for r in got)
    assert [json.loads(x[2]) for x in in_order] == [u for doc in docs for u in doc[root]]
    small = conversation_log.read(spark, str(tmp_path))
    assert turns == sorted(tuple(r) for r in small.select("conversation_id", "turn", "user_question", "retrieved").collect())


def test_bad_elements_cost_themselves_and_are_counted(spark, tmp_path):
    turn = {"turn": 1, "user_question": "q"}
    good = {"user_id": "u", "conversations": [{"conversation_id": "c", "turns": [turn, "oops", None, 5, dict(turn, turn=2)]}, "bad", 7]}
    texts = [json.dumps({"users": [good, "x", 3, {"user_id": "v", "conversations": 4}, good]}), "no json", "[1]", json.dumps({"users": []}), json.dumps(good), None, "{}"]
    logs = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = conversation_log.flatten(logs)
    assert sorted((r.conversation_id, r.turn) for r in rows.collect()) == [("c", 1)] * 3 + [("c", 2)] * 3
    assert {r.level: r.n for r in conversation_log.damage(logs).collect()} == {"log": 4, "user": 2, "conversation": 6, "turn": 9}
    (tmp_path / "a.json").write_text(texts[0])
    users = large_log.users(spark, str(tmp_path))
    assert users.count() == 5
    assert conversation_log.flatten(users, file="place").count() == 4
    # read by itself, a user without a list of conversations is no log either
    assert {r.level: r.n for r in conversation_log.damage(users).collect()} == {"log": 3, "conversation": 4, "turn": 6}
