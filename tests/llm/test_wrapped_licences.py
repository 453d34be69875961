"""Licences as they stand in files: wrapped lines, comment leaders, notices of one line."""

import textwrap

import pytest

from convolens.llm import licenses

MIT = ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")
BSD = ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")
APACHE = ("apache-header", "apache-use", "apache-as-is")
GPL3 = ("gpl3-later-header", "gpl-warranty")


def wrapped(ids, leader, width=72, between="\n"):
    text = between.join(textwrap.fill(licenses.SENTENCES[x], width) + "\n" for x in ids)
    return "".join(f"{leader}{line}\n" for line in text.split("\n"))


@pytest.mark.parametrize("leader", ["", " * ", "// ", "# ", ";; ", "-- ", "dnl ", "   "])
def test_wrapped_texts(spark, leader):
    rows = [
        ("MIT", MIT, "MIT License\n\nCopyright (c) 2020 A\n\n" + wrapped(MIT, leader)),
        ("MIT", MIT, "MIT License\n" + wrapped(MIT, leader, 60, "")),
        ("BSD-3-Clause", BSD, wrapped(BSD, leader).replace("Redistributions", "1. Redistributions")),
        ("Apache-2.0", APACHE, wrapped(APACHE, leader).replace("\n", "\r\n")),
        ("GPL-3.0-or-later", GPL3, "/*\n" + wrapped(GPL3, leader, 80, "") + "*/ code"),
        ("MIT", ("mit-released",), "a line\nReleased under the MIT License\nanother line"),
        ("proprietary", ("rights-reserved",), f"{leader}Copyright 2020 A\n{leader}All rights\n{leader}reserved."),
        (None, (), "Not Released under the MIT License\nall rights are\nreserved"),
    ]
    frame = spark.createDataFrame([(i, text) for i, (_, _, text) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: (r.licence, r.sentences) for r in licenses.scan(frame).collect()}
    assert got == {i: (licence, "|".join(ids)) for i, (licence, ids, _) in enumerate(rows)}


def test_hints_do_not_bar_other_signs_between_words(spark):
    texts = ["All  rights  reserved.", "All rights\u00a0reserved.", "All-Rights-Reserved", "This is free and unencumbered software released into the public\tdomain."]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.licence for r in licenses.scan(frame).collect()} == {0: "proprietary", 1: "proprietary", 2: "proprietary", 3: "Unlicense"}
