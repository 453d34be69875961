"""The engine's queries against their SQL, and its checks and operators on planted rows."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from convolens.functions import text_checks
from convolens.operators import crosstab, profile, turns
from convolens.plans import analysis_catalogue, catalogue, checks_catalogue, engine_catalogue, log_catalogue

QUERIES = catalogue.QUERIES | checks_catalogue.QUERIES | engine_catalogue.QUERIES | analysis_catalogue.QUERIES | log_catalogue.QUERIES
ORACLE_SQL = catalogue.ORACLE_SQL | checks_catalogue.ORACLE_SQL | engine_catalogue.ORACLE_SQL | analysis_catalogue.ORACLE_SQL | log_catalogue.ORACLE_SQL
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    return float(f"{value:.9g}") if isinstance(value, float) else value


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    found = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(found.columns) == sorted(columns)
    assert Counter(tuple(plain(r[c]) for c in columns) for r in found.collect()) == Counter(tuple(map(plain, r)) for r in cursor.fetchall())


@pytest.mark.parametrize(
    ("text", "verdict"),
    [
        (None, "undetermined"), (" \n\t", "undetermined"), ("Done.", "ok"), ("Not don", "violated"), ("Great 🎉", "ok"), ("🎉", "ok"),
        ("```\ncode", "violated"), ("a\n| x | y |", "ok"), ("a\n- item", "ok"), ("a\n2) item", "ok"), ("```py\nx\n```", "ok"), ("'quoted'", "ok"),
    ],
)
def test_truncated(spark, text, verdict):
    row = spark.createDataFrame([(text,)], "t string").select(text_checks.truncated(F.col("t")).alias("v")).first()
    assert row.v == verdict


def test_pii_kinds(spark):
    texts = {"mail me a.b@c-d.org now": "email", "010-1234-5678": "mobile", "1234-5678-1234-5678": "card", "900101-1234567": "resident_id", "nothing 12": "", None: ""}
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text_checks.pii_kinds(F.col("t")).alias("k")).collect()
    assert all(texts[r.t] == "" and r.k == "" or texts[r.t] in r.k.split(",") for r in rows)


def test_pairs_with_gaps_and_repeats(spark):
    rows = [(1, 0, "user", "q0"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"), (1, 2, "user", "q2"), (1, 4, "user", "q4"), (2, 0, "assistant", "a0"), (2, 1, "user", None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted((r.conv_id, r.turn, r.answer) for r in turns.pairs(frame).collect()) == [(1, 2, "a1"), (1, 2, "a1"), (2, 1, "a0")]
    got = {(r.conv_id, r.turn): r.earlier for r in turns.history(frame, 1).collect()}
    assert got[1, 4] == ["q2"] and got[1, 2] == ["q0"] and got[2, 1] == []
    issues = {r.issue: r.n for r in turns.integrity(frame).collect()}
    assert issues == {"repeated_turn": 1, "turn_numbering": 1, "blank_text": 1, "unknown_role": 0}


def test_profile_of_missing_and_equal_values(spark):
    frame = spark.createDataFrame([("a", None), ("a", 2.0), ("a", 2.0), ("b", None)], "k string, v double")
    got = {r.k: r for r in profile.numeric_profile(frame, "k", "v").collect()}
    assert (got["a"].n, got["a"].missing, got["a"].p90) == (2, 1, 2.0) and (got["b"].n, got["b"].lo) == (0, None)
    assert [r.n for r in profile.histogram(frame, "v").orderBy("bin").collect()] == [2] + [0] * 9
    assert sum(r.n for r in profile.histogram(frame.limit(0), "v").collect()) == 0


def test_lift_of_independent_cells_is_one(spark):
    frame = spark.createDataFrame([(a, b) for a in "xy" for b in "pq" for _ in range(5)], "a string, b string")
    assert {(r.lift, r.outlier) for r in crosstab.lift(frame, "a", "b").collect()} == {(1.0, False)}
