"""The taxonomy as a dimension: names, decoration of results, numeric order, and case ids of the first version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convolens.plans import routing

#: Names of the cases by number, and of the types; category_0 holds what is no failure, category_1 what the user caused.
CASE_NAMES = (
    "정상 — 불만 아님", "이해하기 어려운 질문", "지원하지 않는 포맷 요구", "복합 질문을 함", "참조가 모호한 질문", "컨텍스트 길이 초과", "질문에 개인정보 포함", "응답 지연으로 이탈", "출력 잘림", "서비스 자원 부족 응답",
    "요구 언어 불이행", "요구 길이 불이행", "요구 포맷 불이행", "의도와 다른 답변", "이전 턴 맥락 상실", "복합 질문 일부만 답변", "말투·어조 불이행", "두루뭉술한 답변", "문서와 어긋나는 주장", "응답 일관성 문제",
    "Retrieve 실패", "Retrieve 미수행", "Retrieve 성공, 생성 실패", "구 문서 Retrieve", "출처/인용 표기 오류", "상식 질문 오답", "계산 오답", "코드/도구 사용법 오답", "보안 정책상 답변 불가", "간접 프롬프트 인젝션",
)
TYPE_NAMES = ("실패가 아님", "적절하지 않은 질문/요청", "서비스 안정성 문제", "사용자의 의도를 파악하지 못함", "할루시네이션 답변", "도메인 관련 Retrieve Context 문제", "일반 질문", "보안/정책 제한")
#: Case numbers of the first version that changed, and those that were dropped. All others kept theirs, if they had one.
MOVED = {8: 7, 9: 8, 15: 18, 16: 19, 17: 20, 18: 22, 19: 23, 20: 24, 21: 25, 22: 26, 23: 27, 24: 28, 26: 29}
DROPPED = (7, 25, 27, 28, 29, 30)
#: Cases that are no failure, or no verdict: left out of failure rates.
NO_FAILURE = ("case0", routing.UNCLASSIFIED, routing.OUTSIDE)


def dimension(spark: SparkSession) -> DataFrame:
    """case_id, case_name, type_id, type_name, category, confidence, diagnosable: 30 rows."""
    rows = routing.taxonomy(spark)
    number = F.substring("case", 5, 2).cast("int")
    kind = F.substring("type", 5, 1).cast("int")
    pick = lambda names, i: F.get(F.array(*map(F.lit, names)), i)
    category = F.concat(F.lit("category_"), F.least(kind, F.lit(2)).cast("string"))
    return rows.select(F.col("case").alias("case_id"), pick(CASE_NAMES, number).alias("case_name"), F.col("type").alias("type_id"), pick(TYPE_NAMES, kind).alias("type_name"), category.alias("category"), "confidence", "diagnosable")


def describe(rows: DataFrame, case: str = "case_id") -> DataFrame:
    """rows with case_name, type_id, type_name and category; a case outside the taxonomy is named by its own id."""
    names = dimension(rows.sparkSession).drop("confidence", "diagnosable").withColumnRenamed("case_id", case)  # 30 rows
    out = rows.join(F.broadcast(names), case, "left")
    return out.withColumns({"case_name": F.coalesce("case_name", F.col(case)), **{c: F.coalesce(c, F.lit("")) for c in ("type_id", "type_name", "category")}})


def label(case: Column, name: Column) -> Column:
    return F.concat_ws(" ", case, name)


def column_label(type_id: Column, case: Column) -> Column:
    """TYPE5/case20; the case alone where it has no type."""
    return F.when(F.coalesce(type_id, F.lit("")) == "", case).otherwise(F.concat_ws("/", type_id, case))


def type_of(label_: Column) -> Column:
    return F.when(F.contains(label_, F.lit("/")), F.substring_index(label_, "/", 1)).otherwise("")


def case_of(label_: Column) -> Column:
    return F.substring_index(label_, "/", -1)


def sort_key(case: Column) -> Column:
    """Orders cases by number, with everything outside the taxonomy behind them by name."""
    number = F.when(case.rlike(r"^case[0-9]+$"), F.substring(case, 5, 9).try_cast("int"))
    return F.struct(number.isNull(), number, case)


def migrate(old: Column) -> Column:
    """The present id of a case id of the first version; null where it was dropped or never was."""
    table = {f"case{n}": f"case{MOVED.get(n, n)}" for n in range(1, 27) if n not in DROPPED}
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), old)
