import hashlib
import re

from pyspark.sql import functions as F

from grantsieve.functions import scalars as S
from grantsieve.functions import text as X
from grantsieve.functions.patterns import ANY_CASE, portable, required_literal
from grantsieve.sources.catalogue import payload_records
from grantsieve.operators.filters import looks_like_html

SPACES = "".join(chr(c) for c in range(0x3100) if chr(c).isspace())


def test_clean_text_collapses_every_unicode_space(apply):
    values = ["a   b\x1c", None, "", f"x{SPACES}y", f"{SPACES}z{SPACES}", "a\tb", "a b", "a\u200bb"]
    expected = ["a b", "", "", "x y", "z", "a b", "a b", "a\u200bb"]
    assert apply(values, X.clean_text) == expected
    assert apply([f"a{c}b" for c in SPACES], X.clean_text) == ["a b"] * len(SPACES)


def test_strip_space(apply):
    values = [f"{SPACES}a b{SPACES}", "plain", SPACES, None, "\x1ea\x1f"]
    assert apply(values, X.strip_space) == ["a b", "plain", "", None, "a"]


def test_iso_date(apply):
    cases = {
        "due february 31, 2024": "2024-02-31",
        "May 4,2026": "2026-05-04",
        "May 4 , 2026": None,
        "xMay 4, 2026": None,
        "May 4, 20261": None,
        "\u00e9May 4, 2026": None,
        "on September\u00a09, 1999 and May 4, 2026": "1999-09-09",
        "augu\u017ft 3, 2020": None,
        "no date": None,
        "": None,
    }
    assert apply(list(cases), S.iso_date) == list(cases.values())
    assert apply([None], S.iso_date) == [None]


def test_date_as_written(apply):
    cases = {"May 4,2026": "", "Due MAY 4, 2026.": "MAY 4, 2026", "March 14, 2024x": ""}
    assert apply(list(cases), S.date_as_written) == list(cases.values())


def test_calendar_date(apply):
    got = apply(["2024-02-31", "2024-02-29", None], S.calendar_date)
    assert [str(d) if d else None for d in got] == [None, "2024-02-29", None]


def test_normalize_url(apply):
    cases = {
        ' "a.org/x" ': "https://a.org/x",
        "HTTP://a.org": "https://HTTP://a.org",
        "http://a.org": "http://a.org",
        "'https://b.org'": "https://b.org",
        "\"'c.org'\"": "https://c.org",
        "'\"d.org\"'": "https://\"d.org\"",
        "": None,
        "\u00a0 ": None,
        '""': None,
    }
    assert apply(list(cases), S.normalize_url) == list(cases.values())
    assert apply([None], S.normalize_url) == [None]


def test_safe_filename(apply):
    cases = {
        "A & B: c": "A___B__c",
        "\u00e9": "_",
        "": "page",
        "  a\t\tb ": "a_b",
        "x" * 200: "x" * 140,
        "x" * 139 + "__" + "y" * 30: "x" * 139,
        "\u4e2d\u6587 name-1.0": "__name-1.0",
    }
    assert apply(list(cases), S.safe_filename) == list(cases.values())
    assert apply([None], S.safe_filename) == ["page"]


def test_page_key(spark):
    rows = [
        ("https://a.org/x?y=1", "T & U", None, "24-1"),
        ("https://a.org/x?y=1", None, None, None),
        ("https://a.org/\u00e9", "T", "P", None),
    ]
    df = spark.createDataFrame(rows, "u string, t string, p string, n string")
    got = [r[0] for r in df.select(S.page_key(*[F.col(c) for c in "utpn"])).collect()]
    tail = ["__" + hashlib.sha1(r[0].encode()).hexdigest()[:10] for r in rows]
    assert got == ["24-1__T___U" + tail[0], "https_a.org_x_y_1" + tail[1], "P__T" + tail[2]]


def test_money(apply):
    cases = {
        "$2.5 million": ["$2.5 m"],
        "$300,000 maximum": ["$300,000 m"],
        "$400, then $ 5K": ["$400,", "$ 5K"],
        "$5 by US$7.": ["$5 b", "$7"],
        "USD 5": [],
    }
    assert apply(list(cases), S.money_tokens) == list(cases.values())
    values = {"$2.5 m": 2.5e6, "$300,000 m": 3e11, "$400,": 400.0, "$ 5K": 5e3, "$1 billion": 1e9,
              "$0": 0.0, "x": 0.0, "$1.2.3": 0.0, "$15 MILLION": 15e6}
    assert apply(list(values), S.money_value) == list(values.values())
    strict = {"$2.5 million": ["$2.5 million"], "$300,000 maximum": ["$300,000"],
              "$400, then": ["$400"], "$15M each": ["$15M"]}
    assert apply(list(strict), lambda c: S.money_tokens(c, True)) == list(strict.values())


def test_file_stem(apply):
    cases = {"/a/b.c/x.html": "x", "file:///d/a.b.html": "a.b", "noext": "noext", "/d/.html": ".html"}
    assert apply(list(cases), S.file_stem) == list(cases.values())


def test_list_and_null_helpers(apply):
    assert apply(["a b", "", None], lambda c: X.join_list(F.split(c, " "))) == ["a; b", "", ""]
    assert apply(["a", None], X.or_empty) == ["a", ""]
    assert apply(["a", "", None], X.or_null) == ["a", None, None]


def test_payload_records(apply):
    cases = ["h\na\nb", "h", "", "h\r\na\r\n", "h\x1da\u2028b", " \n "]
    want = [max(len(c.strip().splitlines()) - 1, 0) for c in cases]
    assert apply(cases, payload_records) == want


def test_looks_like_html(apply):
    cases = [" <!DOCTYPE html>", "\u00a0<html lang>", "<!doctype html>", "a,b\n<html", ""]
    assert apply(cases, looks_like_html) == [True, True, False, False, False]


def test_fold_case_agrees_with_caseless_matching(apply):
    words = ["\u017fecure", "\u212a-12", "art\u0130ficial \u0131ntelligence", "QUANTUM", "Stra\u00dfe"]
    patterns = ["secure", "k-12", "artificial intelligence", "quantum", "strasse"]
    folded = apply(words, X.fold_case)
    assert [p in f for p, f in zip(patterns, folded)] == [
        bool(re.search(p, w, re.I)) for p, w in zip(patterns, words)
    ]


def test_required_literal():
    cases = {
        r"\bII\.\s*Program Description\b\s*:?": "program description",
        r"Full Proposal Deadline(?:\(s\))?": "full proposal deadline",
        r"\bbroaden(ing)? participation\b": " participation",
        r"\bk-?12\b": "12",
        r"a|b": "",
        r"colou?r": "colo",
        r"x{0,3}abc": "abc",
        r"((a)b)?c": "c",
    }
    assert {p: required_literal(p) for p in cases} == cases


def test_portable_boundaries(apply):
    texts = ["ab", "xab", "\u00e9ab", "ab.", "abc", "e\u0301ab", "_ab", "ab2", "\U0001d4d0ab", ".AB-", "ab\u00b2",
             "\U0001f600ab\U0001f600", "\nab\n", "a ab", "aab ab"]
    for pattern in (r"\bab\b", r"\bab", r"ab\b", r"\b(ab|zz)\b", r"\ba?b\b", r"x?\bab"):
        got = apply(texts, lambda c: c.rlike(ANY_CASE + portable(pattern)))
        assert got == [bool(re.search(pattern, t, re.I)) for t in texts], pattern
