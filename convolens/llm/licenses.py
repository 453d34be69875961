"""Licence scans by sentence rules, DataFrame functions only.

A text is normalised (lower case, only letters and digits, single blanks) with marks where sentences and lines end,
known sentences become their identifiers, and the text's sequence of identifiers is matched against ordered licence
rules. A rule is a run of identifiers; the first rule that matches names the text's licence, all that match are listed.

Sentences end at sentence signs and blank lines. A known sentence may run over line feeds, comment leaders after them
included, and it may begin or end where a line does, so wrapped licences and notices of one line are both found. The
SQL, which ends every sentence at a line feed, finds those of one line only.

Null and empty texts have no sentences and no licence. Every row gives one row, repeated rows too; extra columns are
ignored. Texts without any of the words that every known sentence has one of are not cut at all.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convolens.llm.common import text_of

#: Sentences of public licences and usual notices, by identifier.
SENTENCES = {
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "apache-header": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-as-is": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-released": "Released under the Apache License, Version 2.0.",
    "gpl3-later-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-later-header": "either version 2 of the License, or (at your option) any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2-notice": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-header": "either version 2.1 of the License, or (at your option) any later version.",
    "mpl-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "bsd-licensed": "Licensed under the BSD 3-Clause License.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-full": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-full": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "unlicense-domain": "This is free and unencumbered software released into the public domain.",
    "rights-reserved": "All rights reserved.",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-only",
    "spdx-bsd3": "SPDX-License-Identifier: BSD-3-Clause",
}

#: Rules in order: licence and the run of sentences that shows it. Whole texts go before notices.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant",)),
    ("Apache-2.0", ("apache-header", "apache-use", "apache-as-is")),
    ("Apache-2.0", ("apache-header",)),
    ("GPL-3.0-or-later", ("gpl3-later-header", "gpl-warranty")),
    ("GPL-3.0-or-later", ("gpl3-later-header",)),
    ("GPL-2.0-or-later", ("gpl2-later-header",)),
    ("LGPL-2.1-or-later", ("lgpl-header",)),
    ("MPL-2.0", ("mpl-header",)),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("apache-released",)),
    ("GPL-3.0-only", ("gpl3-notice",)),
    ("GPL-2.0-only", ("gpl2-notice",)),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("BSD-3-Clause", ("bsd-licensed",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-full",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-notice",)),
    ("CC-BY-4.0", ("cc-by-notice",)),
    ("CC-BY-4.0", ("cc-by-full",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("Unlicense", ("unlicense-domain",)),
    ("MIT", ("spdx-mit",)),
    ("Apache-2.0", ("spdx-apache",)),
    ("GPL-3.0-only", ("spdx-gpl3",)),
    ("BSD-3-Clause", ("spdx-bsd3",)),
    ("proprietary", ("rights-reserved",)),
)

#: Every known sentence has one of these, each inside one word, so it stands in the raw text as well.
HINTS = ("licen", "copyright", "permission", "redistribut", "warrant", "liab", "domain", "reserved")

#: A sentence ends after these signs before white space; a colon ends one only before conditions.
_END = r"([.!?;]|(?:conditions|met):)[\x20\x09-\x0D]+"
#: What may stand before the words of a line: signs, and the comment words of some languages.
_LEADER = r"(?m)^(?:[^a-z0-9\n]*(?:rem|dnl)(?=[\x20\t\n])[^a-z0-9\n]*|[^a-z0-9\n]+)"
#: The mark of a sentence's end in normalised texts.
_MARK = "\x01"


def normal(sentence: str) -> str:
    return " ".join(re.sub("[^a-z0-9]+", " ", sentence.lower()).split())


def known() -> dict[str, str]:
    """Identifier by normalised sentence. A sentence with an inner end gives its first part (no identifier is lost)."""
    out: dict[str, str] = {}
    for name, sentence in SENTENCES.items():
        parts = [normal(x) for x in re.sub(_END, r"\1\n", sentence.lower()).split("\n")]
        whole = max(parts, key=len)
        assert any(x in whole for x in HINTS), name
        assert whole not in out, name
        out[whole] = name
    return out


def identifiers(text: str = "text") -> Column:
    """The identifiers of the text's known sentences, in order."""
    lower = F.lower(text_of(text))
    hinted = F.lit(False)
    for hint in HINTS:
        hinted = hinted | lower.contains(hint)
    # lines without leaders, then ends of sentences as marks, then single blanks
    marked = F.regexp_replace(F.regexp_replace(F.translate(lower, _MARK, " "), r"\r\n?", "\n"), _LEADER, "")
    marked = F.regexp_replace(F.regexp_replace(marked, _END, f"$1{_MARK}"), r"\n{2,}", _MARK)
    marked = F.concat(F.lit(_MARK), F.regexp_replace(marked, r"[^a-z0-9\x01\n]+", " "), F.lit(_MARK))
    marked = F.regexp_replace(marked, r" ?([\x01\n]) ?", "$1")
    longest = sorted(known(), key=len, reverse=True)
    any_known = rf"(?<=[\x01\n])(?:{'|'.join(x.replace(' ', '[ \\n]') for x in longest)})(?=[\x01\n])"
    table = F.create_map(*[F.lit(x) for pair in known().items() for x in pair])
    names = F.transform(F.regexp_extract_all(marked, F.lit(any_known), F.lit(0)), lambda x: F.try_element_at(table, F.translate(x, "\n", " ")))
    return F.when(hinted, F.array_compact(names)).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, licence (null: none), licences, n_sentences, sentences for every row of docs. Lists are joined by `|`."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), identifiers(text).alias("ids"))
    line = F.concat(F.lit("|"), F.array_join("ids", "|"), F.lit("|"))
    hits = [F.when(F.col("line").contains(f"|{'|'.join(ids)}|"), F.lit(licence)) for licence, ids in RULES]
    found = F.array_distinct(F.array_compact(F.array(*hits)))
    rows = rows.select("doc_id", "ids", line.alias("line"))
    rows = rows.select("doc_id", "ids", F.when(F.size("ids") > 0, found).otherwise(F.array().cast("array<string>")).alias("found"))
    return rows.select("doc_id", F.try_element_at("found", F.lit(1)).alias("licence"), F.array_join("found", "|").alias("licences"), F.size("ids").alias("n_sentences"), F.array_join("ids", "|").alias("sentences"))


def oracle() -> str:
    """The same scan in DuckDB's SQL."""
    table = ", ".join(f"('{k}', '{v}')" for k, v in known().items())
    rules = ", ".join(f"({i}, '{licence}', '|{'|'.join(ids)}|')" for i, (licence, ids) in enumerate(RULES))
    return rf"""
        WITH known(sentence, name) AS (VALUES {table}), rules(no, licence, ids) AS (VALUES {rules}),
        cut AS (SELECT row_number() OVER () AS r, doc_id, string_split(regexp_replace(lower(coalesce(text, '')), '{_END}', '\1' || chr(10), 'g'), chr(10)) AS lines FROM documents),
        line AS (SELECT r, unnest(lines) AS x, generate_subscripts(lines, 1) AS i FROM cut),
        ids AS (SELECT r, count(*) AS n, string_agg(name, '|' ORDER BY i) AS ids FROM line JOIN known ON sentence = trim(regexp_replace(x, '[^a-z0-9]+', ' ', 'g')) GROUP BY r),
        hit AS (SELECT r, licence, min(no) AS no FROM ids JOIN rules ON contains('|' || ids.ids || '|', rules.ids) GROUP BY r, licence),
        hits AS (SELECT r, string_agg(licence, '|' ORDER BY no) AS licences, arg_min(licence, no) AS licence FROM hit GROUP BY r)
        SELECT doc_id, licence, coalesce(licences, '') AS licences, coalesce(n, 0)::INT AS n_sentences, coalesce(ids.ids, '') AS sentences
        FROM cut LEFT JOIN ids USING (r) LEFT JOIN hits USING (r)
    """
