"""Exception phrases of the toxicity lexicon."""

from convolens.llm import toxicity


def test_phrases_of_few_toxic_documents_are_no_exceptions(spark):
    rows = [(f"some badword here {i}", 1) for i in range(40)] + [("a badword test", 1), ("a badword case", 1), ("a badword case", 1)]
    rows += [(f"quite clean prose {i}", 0) for i in range(900)]
    rows += [(f"the badword {x}", 0) for x in ("test", "case", "film") for _ in range(3)]
    exceptions = toxicity.fit(spark.createDataFrame(rows, "text string, label int")).exceptions
    assert toxicity.fold("badword film") in exceptions
    assert toxicity.fold("badword test") not in exceptions and toxicity.fold("badword case") not in exceptions
