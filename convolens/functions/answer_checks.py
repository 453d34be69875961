"""More deterministic checks of an answer as Catalyst expressions: language, format, service errors, sums, dates, SQL, injection, quotes.

Every check gives na (nothing to check), undetermined, ok or violated. Null texts count as empty. Only the parse of
Python blocks and NFKC need Python; both are Arrow UDFs over whole columns.
"""

from __future__ import annotations

import ast
import unicodedata
import warnings
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from convolens.functions.text_checks import BLANK, BLANK_CHARS, finding, let, pii_check, truncated_check

#: Character ranges of the scripts that the language rule counts.
SCRIPTS = {"hangul": r"[가-힣\x{1100}-\x{11FF}\x{3130}-\x{318F}]", "latin": "[A-Za-z]", "kana": r"[\x{3040}-\x{30FF}]", "han": r"[\x{4E00}-\x{9FFF}]"}
#: Lists, tables and fences, matched line by line.
FORMATS = {"numbered": r"^\s*(?:\d+[.)]|[①-⑳])\s+\S", "bullet": r"^\s*[-*•·]\s+\S", "row": r"^\s*\|.*\|\s*$", "rule": r"^\s*\|[\s:|-]+\|\s*$", "fence": "```"}
#: The operator's own outage message, and signs of one that count in pairs only, in texts up to a length.
OUTAGE = ("서비스에 문제가 있거나, 사용자 분들이 많아서 서버에 부하가 걸리고 있어요",)
OUTAGE_SIGNS = ("서버에 부하", "사용자 분들이 많아", "일시적인 오류", "잠시 후 다시", "요청이 많아", "응답을 생성하지 못", "서비스에 문제가")
OUTAGE_CHARS = 400
#: Instructions planted in a passage.
INJECTION = (
    r"(이전|앞의|위의)\s*(지시|명령|규칙|프롬프트).{0,10}(무시|잊)",
    r"(?i)ignore\s+(all\s+)?(previous|prior|above)\s+(instruction|prompt)",
    r"(?i)(시스템|system)\s*(프롬프트|prompt).{0,10}(출력|공개|보여|reveal|print)",
    r"(다음|아래).{0,6}(문장|내용|텍스트).{0,10}(그대로|반드시).{0,10}(출력|답변|말)",
    r"(?i)you\s+are\s+now\s+",
    r"(관리자|admin)\s*(권한|모드).{0,10}(활성|전환)",
)
#: Words that open an SQL statement; week days from Monday.
SQL_OPENERS = ("select", "insert", "update", "delete", "with", "create")
WEEKDAYS = "월화수목금토일"
#: Patterns of sums, dates, week day claims, code blocks, quotes and titles.
NUMBER = r"\d[\d,]*(?:\.\d+)?"
EQUATION = rf"(?U)(?<![\w.])({NUMBER}(?:\s*[-+*/×÷]\s*{NUMBER})+)\s*=\s*({NUMBER})(?![\d.])"
CLAIM = r"(?:[\s은는이가]*(?:요일은\s*)?([월화수목금토일])요일)?"
DATE_ISO = rf"(\d{{4}})[-/](\d{{1,2}})[-/](\d{{1,2}}){CLAIM}"
DATE_KO = rf"(?:(\d{{4}})\s*년\s*)?(\d{{1,2}})\s*월\s*(\d{{1,2}})\s*일{CLAIM}"
CODE_BLOCK = r"(?s)```(\w+)?\s*\n(.*?)```"
QUOTES = (r"[“\"]([^”\"]{10,200})[”\"]", r"‘([^’‘]{10,200})’", r"(?<![A-Za-z0-9])'([^']{10,200})'(?![A-Za-z0-9])")
TITLES = r"[「『《〈]([^」』》〉\n]{2,60})[」』》〉]"
#: The source that heads a passage; shortest normalised title.
HEADER = r"\A\s*[\[\(「『《【]([^\]\)」』》】\n]{1,80})[\]\)」』》】]"
SHORTEST_TITLE = 2
#: Kinds of a requested format and of a requested length; `none` stands for no request.
FORMAT_KINDS = ("none", "numbered_list", "bullet_list", "table", "code_block", "json", "prose")
LENGTH_KINDS = ("none", "max_chars", "max_sentences", "max_lines", "vague_short")
#: Share of a quote that must stand unbroken in a passage, in tenths; shortest normalised quote.
TENTHS, SHORTEST_QUOTE = 9, 10


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    return F.btrim(_text(text), F.lit(BLANK_CHARS))


def squeeze(text: Column) -> Column:
    return F.regexp_replace(_text(text), F.lit(f"{BLANK}+"), F.lit(""))


def _some(items: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, items)


def script_profile(text: Column) -> Column:
    """struct of the shares of hangul, latin, kana and han among their characters; all 0 where there is none."""
    letters = "".join(chr(ord(first) + i) for first in "Aa" for i in range(26))

    def counted(x: Column) -> Column:
        wide = F.octet_length(x) > F.length(x)  # a text in ASCII holds none of the other scripts
        others = {name: F.when(wide, F.regexp_count(x, F.lit(SCRIPTS[name]))).otherwise(0) for name in ("hangul", "kana", "han")}
        n = others | {"latin": F.length(x) - F.length(F.translate(x, letters, ""))}
        return F.struct(*[n[name].alias(name) for name in SCRIPTS])

    total = lambda n: F.greatest(n["hangul"] + n["latin"] + n["kana"] + n["han"], F.lit(1))
    shares = lambda n: let(total(n), lambda t: F.struct(*[(n[name] / t).alias(name) for name in SCRIPTS]))
    return let(let(_text(text), counted), shares)


def detect_language(text: Column) -> Column:
    """ko, ja, zh, en or unknown by the shares of four scripts among their characters."""
    named = lambda x: F.when(x["hangul"] >= 0.10, "ko").when(x["kana"] > 0.05, "ja").when(x["han"] > 0.3, "zh").when(x["latin"] > 0.5, "en").otherwise("unknown")
    return let(script_profile(text), named)


def language_check(text: Column, wanted: Column) -> Column:
    judged = lambda found: finding(F.when(F.coalesce(wanted, F.lit("")) == "", "na").when(found == "unknown", "undetermined").when(found == wanted, "ok").otherwise("violated"), found, F.array(found))
    return let(detect_language(text), judged)


def language(text: Column, wanted: Column) -> Column:
    return language_check(text, wanted)["verdict"]


def measures(text: Column) -> Column:
    """struct of chars, sentences and lines; lengths are measured, never judged."""
    filled = lambda parts: F.size(F.filter(parts, lambda x: x.rlike(f"{BLANK[:1]}^{BLANK[1:]}"))).cast("long")
    sentences = lambda whole: F.split(whole, rf"(?<=[.!?。]){BLANK}+")
    lines = lambda whole: F.split(whole, r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]")
    return let(strip(text), lambda w: F.struct(F.length(w).cast("long").alias("chars"), filled(sentences(w)).alias("sentences"), filled(lines(w)).alias("lines")))


def length_check(text: Column, kind: Column) -> Column:
    """na without a request; with any the text is measured and never judged: undetermined."""
    asked = ~F.coalesce(kind, F.lit("none")).isin("", "none")
    said = lambda m: F.concat_ws(" ", m["chars"].cast("string"), F.lit("characters,"), m["sentences"].cast("string"), F.lit("sentences,"), m["lines"].cast("string"), F.lit("lines"))
    return finding(F.when(asked, "undetermined").otherwise("na"), F.when(asked, let(measures(text), said)))


def strip_fence(text: Column) -> Column:
    """The text without a fence around it; a closing fence that nothing opened stays."""
    return let(strip(text), lambda bare: F.when(bare.startswith("```"), strip(F.regexp_replace(F.regexp_replace(bare, r"\A```[a-zA-Z]*\s*", ""), r"\s*```\s*\z", ""))).otherwise(bare))


def is_json(text: Column) -> Column:
    """Whether the text is one JSON value and nothing else. Repeated keys and NaN are allowed, as in Python's parser.

    The text stands in a list and as a value of one object, so that no part of it can close or open what is around.
    """
    around = F.concat(F.lit('{"x":['), text, F.lit('],"y":'), text, F.lit("}"))
    broken = F.from_json(around, "y string, broken string", {"columnNameOfCorruptRecord": "broken", "allowSingleQuotes": "false"})["broken"]
    return (F.coalesce(text, F.lit("")) != "") & broken.isNull()


def has_format(text: Column, kind: Column) -> Column:
    count = lambda name: F.regexp_count(_text(text), F.lit(f"(?mdU){FORMATS[name]}"))
    json_ = is_json(strip_fence(text))
    return (
        F.when(kind == "numbered_list", count("numbered") >= 2)
        .when(kind == "bullet_list", count("bullet") >= 2)
        .when(kind == "table", (count("row") >= 2) & (count("rule") >= 1))
        .when(kind == "code_block", count("fence") >= 2)
        .when(kind == "json", json_)
        .when(kind == "prose", (count("numbered") == 0) & (count("bullet") == 0))
        .otherwise(False)
    )


def format_check(text: Column, kind: Column) -> Column:
    asked = ~F.coalesce(kind, F.lit("none")).isin("", "none")
    return finding(F.when(~asked, "na").when(has_format(text, kind), "ok").otherwise("violated"), F.when(asked, kind))


def format_kept(text: Column, kind: Column) -> Column:
    return format_check(text, kind)["verdict"]


def service_error_check(text: Column) -> Column:
    def judged(bare: Column) -> Column:
        signs = F.filter(F.array(*[F.lit(x) for x in OUTAGE_SIGNS]), lambda x: F.contains(bare, F.replace(x, F.lit(" "), F.lit(""))))
        whole = _some([F.contains(bare, F.lit(x.replace(" ", ""))) for x in OUTAGE])
        verdict = F.when(bare == "", "na").when(whole, "violated").when(F.length(bare) > OUTAGE_CHARS, "ok").when(F.size(signs) >= 2, "violated").otherwise("ok")
        return finding(verdict, "signs of an outage message", signs)

    return let(squeeze(text), judged)


def service_error(text: Column) -> Column:
    return service_error_check(text)["verdict"]


def evaluate(expression: Column) -> Column:
    """The value of a chain of + - * / with the usual precedence; null for a division by zero or a number like 007."""

    def step(acc: Column, f: Column) -> Column:
        start = f["op"].isin("+", "-")
        product = F.when(f["op"] == "*", acc["p"] * f["x"]).when(f["op"] == "/", F.try_divide(acc["p"], f["x"])).when(f["op"] == "-", -f["x"]).otherwise(f["x"])
        return F.struct(F.when(start, acc["s"] + acc["p"]).otherwise(acc["s"]).alias("s"), product.alias("p"))

    def value(plain: Column) -> Column:
        signs = F.translate(plain, "0123456789.", "")
        parts = F.split(F.translate(plain, "+-*/", "    "), " ")
        pairs = F.transform(parts, lambda x, i: F.struct(F.when(i == 0, "+").otherwise(F.substring(signs, i, F.lit(1))).alias("op"), x.try_cast("double").alias("x")))
        whole = F.aggregate(pairs, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("p")), step, lambda acc: acc["s"] + acc["p"])
        return F.when(plain.rlike(r"^[-+*/0-9.]+$") & ~plain.rlike(r"(?:^|[-+*/])0+[1-9][0-9]*(?:$|[-+*/])"), whole)

    return let(F.translate(expression, "×÷, \t", "*/"), value)


def arithmetic_check(text: Column) -> Column:
    """violated where a sum differs from its recomputation by more than 0.01; sums that cannot be computed pass."""
    number = lambda x: F.translate(x, ",", "").try_cast("double")

    def judged(sums: Column) -> Column:
        cut = F.transform(sums, lambda x: F.struct(x.alias("sum"), F.trim(F.substring_index(x, "=", 1)).alias("left"), F.trim(F.substring_index(x, "=", -1)).alias("right")))
        wrong = F.filter(cut, lambda x: F.coalesce(F.abs(evaluate(x["left"]) - number(x["right"])) > 0.01, F.lit(False)))
        verdict = lambda w: F.when(F.size(sums) == 0, "na").when(F.size(w) > 0, "violated").otherwise("ok")
        return let(wrong, lambda w: finding(verdict(w), F.concat(F.size(sums).cast("string"), F.lit(" sums")), F.transform(w, lambda x: x["sum"])))

    # a text without the sign has no sum, and most texts have none
    return let(F.when(F.contains(_text(text), F.lit("=")), F.regexp_extract_all(_text(text), F.lit(EQUATION), F.lit(0))).otherwise(F.array().cast("array<string>")), judged)


def arithmetic(text: Column) -> Column:
    return arithmetic_check(text)["verdict"]


def _date_verdict(y: Column, m: Column, d: Column, claim: Column) -> Column:
    year, month, day = (F.when(x != "", x.cast("int")) for x in (y, m, d))
    longest = F.when(month == 2, 29).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    late = F.coalesce((month == 2) & (day == 29), F.lit(False))
    impossible = (month < 1) | (month > 12) | (day < 1) | (day > longest) | F.coalesce((year < 1) | (late & ~leap), F.lit(False))
    # days since Monday 0001-01-01 of the proleptic calendar, without a call that fails on impossible dates
    a = F.floor((14 - month) / 12)
    yy, mm = year - a, month + 12 * a - 3
    days = day + F.floor((153 * mm + 2) / 5) + 365 * yy + F.floor(yy / 4) - F.floor(yy / 100) + F.floor(yy / 400) - 307
    said = F.instr(F.lit(WEEKDAYS), claim) - 1
    return (
        F.when(impossible, "violated")
        .when(year.isNull() & (late | (claim != "")), "undetermined")
        .when((claim != "") & (F.pmod(days, F.lit(7)) != said), "violated")
        .otherwise("ok")
    )


def dates_found(text: Column) -> Column:
    """array of struct<date, y, m, d, claim> of all dates, first those in figures only. y and claim may be empty.

    Figures may be full-width and blanks of any kind, as in Python's patterns.
    """

    def one(pattern: str) -> Column:
        pattern = pattern.replace(r"\s", BLANK).replace(r"\d", "[0-9０-９]")
        cut = lambda x, i: F.translate(F.regexp_extract(x, pattern, i), "０１２３４５６７８９", "0123456789")
        found = F.regexp_extract_all(_text(text), F.lit(pattern), F.lit(0))
        return F.transform(found, lambda x: F.struct(x.alias("date"), *[cut(x, i).alias(n) for i, n in enumerate(("y", "m", "d", "claim"), 1)]))

    return F.concat(one(DATE_ISO), one(DATE_KO))


def dates_check(text: Column) -> Column:
    """Impossible dates and wrong week day claims right behind a date."""
    verdicts = F.transform(dates_found(text), lambda x: F.struct(x["date"].alias("date"), _date_verdict(x["y"], x["m"], x["d"], x["claim"]).alias("verdict")))

    def judged(all_: Column) -> Column:
        of = lambda v: F.filter(all_, lambda x: x["verdict"] == v)
        verdict = F.when(F.size(all_) == 0, "na").when(F.size(of("violated")) > 0, "violated").when(F.size(of("undetermined")) > 0, "undetermined").otherwise("ok")
        return finding(verdict, F.concat(F.size(all_).cast("string"), F.lit(" dates")), F.transform(of("violated"), lambda x: x["date"]))

    return let(verdicts, judged)


def dates(text: Column) -> Column:
    return dates_check(text)["verdict"]


def code_blocks(text: Column) -> Column:
    """array of struct<lang, body>, lang in lower case and empty where the fence names none."""
    cut = lambda x, i: F.regexp_extract(x, CODE_BLOCK, i)
    return F.transform(F.regexp_extract_all(_text(text), F.lit(CODE_BLOCK), F.lit(0)), lambda x: F.struct(F.lower(cut(x, 1)).alias("lang"), cut(x, 2).alias("body")))


def sql_shape_check(text: Column) -> Column:
    """Blocks of SQL: opening word, balanced parentheses, no dangling GROUP/ORDER BY, FROM after SELECT.

    FROM may stand on a line of its own.
    """

    def problem(body: Column) -> Column:
        count = lambda sign: F.length(body) - F.length(F.replace(body, F.lit(sign), F.lit("")))
        opens = _some([body.startswith(x) for x in SQL_OPENERS])
        return (
            F.when(~opens, "no opening word")
            .when(count("(") != count(")"), "parentheses")
            .when(body.rlike(r"(?:group|order)\s+by\s*\z"), "open ending")
            .when(body.startswith("select") & ~body.rlike(r"\sfrom\s"), "no from")
        )

    def judged(blocks: Column) -> Column:
        problems = F.array_compact(F.transform(blocks, lambda b: let(F.lower(F.regexp_replace(strip(b["body"]), r";\s*\z", "")), problem)))
        return let(problems, lambda p: finding(F.when(F.size(blocks) == 0, "na").when(F.size(p) > 0, "violated").otherwise("ok"), F.concat(F.size(blocks).cast("string"), F.lit(" blocks")), p))

    return let(F.filter(code_blocks(text), lambda b: b["lang"].isin("sql", "postgresql", "mysql")), judged)


def sql_shape(text: Column) -> Column:
    return sql_shape_check(text)["verdict"]


@F.pandas_udf(StringType())
def _python_verdict(bodies: pd.Series) -> pd.Series:
    def parses(body: str) -> bool:
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                ast.parse(body)
        except (SyntaxError, ValueError, RecursionError, MemoryError):
            return False
        return True

    return pd.Series(["na" if x is None or len(x) == 0 else "ok" if all(map(parses, x)) else "violated" for x in bodies], dtype=object)


def python_syntax_check(text: Column) -> Column:
    return let(python_syntax(text), lambda v: finding(v, "code that does not parse"))


def python_syntax(text: Column) -> Column:
    blocks = F.filter(code_blocks(text), lambda b: b["lang"].isin("python", "py", ""))
    return _python_verdict(F.transform(blocks, lambda b: b["body"]))


def nfkc(text: Column) -> Column:
    """The text in NFKC. Texts in ASCII are so already and do not go to Python."""
    return F.when(F.length(_text(text)) == F.octet_length(_text(text)), _text(text)).otherwise(_nfkc(text))


@F.pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return pd.Series([x if x.isascii() else unicodedata.normalize("NFKC", x) for x in texts.fillna("")], dtype=object)


def normalised(text: Column) -> Column:
    """NFKC, without white space, lower case: the form in which texts are compared."""
    return F.lower(squeeze(nfkc(text)))


def injection_check(passages: Column, answer: Column) -> Column:
    """na without a planted instruction; violated if the answer repeats the start of one, else undetermined: never ok.

    White space and case are folded; pass NFKC texts where full-width letters matter.
    """
    hits = F.flatten(F.transform(F.coalesce(passages, F.array().cast("array<string>")), lambda c: F.filter(F.array(*[F.regexp_extract(_text(c), x, 0) for x in INJECTION]), lambda h: h != "")))
    repeated = lambda found, plain: F.filter(found, lambda h: F.contains(plain, F.substring(F.lower(squeeze(h)), 1, 20)))

    def judged(found: Column) -> Column:
        again = F.when(F.size(found) > 0, let(F.lower(squeeze(answer)), lambda plain: repeated(found, plain))).otherwise(found)
        return let(again, lambda r: finding(F.when(F.size(found) == 0, "na").when(F.size(r) > 0, "violated").otherwise("undetermined"), F.concat(F.size(found).cast("string"), F.lit(" instructions")), r, 3))

    return let(hits, judged)


def injection(passages: Column, answer: Column) -> Column:
    return injection_check(passages, answer)["verdict"]


def _folded(text: Column) -> Column:
    return F.lower(squeeze(text))


def quotes(text: Column) -> Column:
    """Sentences in quotation marks, trimmed."""
    found = F.concat(*[F.regexp_extract_all(_text(text), F.lit(x), F.lit(1)) for x in QUOTES])
    return F.filter(F.transform(found, strip), lambda q: F.length(squeeze(q)) >= SHORTEST_QUOTE)


def titles(text: Column) -> Column:
    """Names of documents in title marks, trimmed."""
    return F.filter(F.transform(F.regexp_extract_all(_text(text), F.lit(TITLES), F.lit(1)), strip), lambda t: F.length(squeeze(t)) >= SHORTEST_TITLE)


def headers(passages: Column) -> Column:
    """The sources that head passages; passages without one give none."""
    return F.filter(F.transform(passages, lambda c: strip(F.regexp_extract(_text(c), HEADER, 1))), lambda h: h != "")


def stands_in(quote: Column, passage: Column) -> Column:
    """Whether at least nine tenths of the quote stand unbroken in the passage; both already in compared form.

    Every window of that length covers the quote's middle, so a passage without the middle is out after one search.
    """

    def judged(x: Column) -> Column:
        n, k = x["n"], x["k"]
        windows = F.exists(F.sequence(F.lit(1), n - k + 1), lambda i: F.contains(passage, F.substring(quote, i, k)))
        return (n > 0) & F.contains(passage, F.substring(quote, n - k + 1, 2 * k - n)) & (F.contains(passage, quote) | windows)

    n = F.length(quote)
    return let(F.struct(n.alias("n"), F.floor((TENTHS * n + 9) / 10).cast("int").alias("k")), judged)


def quoted_check(answer: Column, passages: Column) -> Column:
    """Quoted sentences that stand in no passage, and named documents that no passage's header names, are wrong.

    Titles are only looked up where a passage has a header. An answer that quotes without any passage is wrong as a
    whole. Pass NFKC texts where full-width letters matter.
    """
    none = F.array().cast("array<string>")

    def judged(x: Column) -> Column:
        lost = F.filter(x["quotes"], lambda q: let(_folded(q), lambda f: ~F.exists(x["bodies"], lambda c: stands_in(f, c))))
        unknown = F.when(F.size(x["headers"]) > 0, F.filter(x["titles"], lambda t: let(_folded(t), lambda f: ~F.exists(x["headers"], lambda h: F.contains(h, f))))).otherwise(none)
        all_ = F.concat(x["quotes"], x["titles"])
        wrong = F.when(F.size(x["bodies"]) == 0, all_).otherwise(F.concat(lost, unknown))
        return let(wrong, lambda w: finding(F.when(F.size(all_) == 0, "na").when(F.size(w) > 0, "violated").otherwise("ok"), F.concat(F.size(all_).cast("string"), F.lit(" quotes and titles")), w))

    given = F.coalesce(passages, none)
    found = F.struct(quotes(answer).alias("quotes"), titles(answer).alias("titles"))
    folded = lambda x, wanted: F.when(wanted, F.transform(x, _folded)).otherwise(none)
    whole = lambda f: F.struct(
        f["quotes"].alias("quotes"), f["titles"].alias("titles"),
        F.when(F.size(f["quotes"]) + F.size(f["titles"]) > 0, F.transform(given, _folded)).otherwise(none).alias("bodies"),
        folded(headers(given), F.size(f["titles"]) > 0).alias("headers"),
    )
    return let(found, lambda f: let(whole(f), judged))


def quoted(answer: Column, passages: Column) -> Column:
    return quoted_check(answer, passages)["verdict"]


def run_all(answer: Column, question: Column, passages: Column, wanted_language: Column, wanted_format: Column, wanted_length: Column) -> dict[str, Column]:
    """All checks as structs of verdict, detail and evidence. Personal data is looked for in the user's question."""
    return {
        "pii": pii_check(question),
        "service_error": service_error_check(answer),
        "truncated": truncated_check(answer),
        "quoted_spans": quoted_check(answer, passages),
        "python_syntax": python_syntax_check(answer),
        "sql_shape": sql_shape_check(answer),
        "arithmetic": arithmetic_check(answer),
        "dates": dates_check(answer),
        "injection": injection_check(passages, answer),
        "language": language_check(answer, wanted_language),
        "format": format_check(answer, wanted_format),
        "length": length_check(answer, wanted_length),
    }
