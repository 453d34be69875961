"""Evidence as a table function: a row for each quote and passage with the part that both share."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from convolens.functions.citations import SHORTEST, THRESHOLD, automaton, longest_part


class Evidence:
    """evidence(quotes, passages[, least]): quote_no, quote, [passage_no,] length, part, ratio, kept.

    Quotes and passages come in compared form, each as a text or as a list of texts; passage_no is there for a list
    only. Pairs whose ratio is below `least` (0) are left out. Null texts count as empty, null lists have no rows.
    """

    @staticmethod
    def analyze(quotes: AnalyzeArgument, passages: AnalyzeArgument, least: AnalyzeArgument | None = None) -> AnalyzeResult:
        schema = StructType().add("quote_no", IntegerType()).add("quote", StringType())
        if isinstance(passages.dataType, ArrayType):
            schema = schema.add("passage_no", IntegerType())
        return AnalyzeResult(schema.add("length", IntegerType()).add("part", StringType()).add("ratio", DoubleType()).add("kept", "boolean"))

    def eval(self, quotes, passages, least=0.0):
        listed = isinstance(passages, list)
        if passages is None or quotes is None:
            return
        for i, quote in enumerate(quotes if isinstance(quotes, list) else [quotes]):
            machine = automaton(quote or "")
            for j, passage in enumerate(passages if listed else [passages]):
                part = longest_part(quote or "", passage or "", machine)
                ratio = len(part) / len(quote) if quote else 0.0
                if ratio >= float(least):
                    yield (i, quote, *((j,) if listed else ()), len(part), part, ratio, ratio >= THRESHOLD and len(quote or "") >= SHORTEST)


def register(spark: SparkSession, name: str = "evidence") -> None:
    """For SQL: SELECT e.* FROM t, LATERAL evidence(t.quotes, t.passages) e."""
    from pyspark.sql.functions import udtf

    spark.udtf.register(name, udtf(Evidence))
