"""Searches that start at the first sign find what the caseless pattern alone finds."""

import pytest
from pyspark.sql import functions as F

from grantsieve.functions.html import markup_text
from grantsieve.functions.patterns import ANY_CASE, first_sign, portable
from grantsieve.functions.scalars import date_as_written

TEXTS = ["Skip it", "ſkip it", "xskip it SKIP IT", "İnn", "ıNN inn", "Kit kit", "a KIT", "", "24-1 x", "nothing"]


@pytest.mark.parametrize("pattern", [r"\bskip it\b", "Inn", "KIT", "24-[0-9]", r"Skip\s*it"])
def test_same_matches(apply, pattern):
    body = ANY_CASE + portable(pattern)
    assert first_sign([pattern]) != ""
    plain = apply(TEXTS, lambda c: F.array_join(F.regexp_extract_all(c, F.lit(body), F.lit(0)), "|"))
    quick = apply(TEXTS, lambda c: F.array_join(F.regexp_extract_all(c, F.lit(first_sign([pattern]) + body), F.lit(0)), "|"))
    assert quick == plain
    assert any(plain)


@pytest.mark.parametrize("patterns", [["a?b"], ["a*"], ["a{0,2}b"], ["a|b"], ["(a)"], [r"\d"], ["a", "[bc]"], ["é"], []])
def test_no_lookahead_for_an_unknown_start(patterns):
    assert first_sign(patterns) == ""


def test_a_month_is_found_in_any_case(apply):
    assert apply(["due mAY 4, 2026", "dismay 4, 2026", "ſeptember 1, 2025"], date_as_written) == [
        "mAY 4, 2026", "", "ſeptember 1, 2025",
    ]


def test_space_behind_references_is_collapsed_once(apply):
    sources = [" a &nbsp;\n<b> &amp;\tamp; </b>&#32;  c ", "&nbsp;", None, "x &foo  ;&lt;  &copy", "<![CDATA[ a  &amp; ]]> b"]
    assert apply(sources, markup_text) == ["a & amp; c", "", "", "x &foo ;< ©", "a & b"]


def test_known_letters_are_compared_before_looking_back(apply):
    from grantsieve.functions.patterns import WORD, any_of, caseless

    assert portable(r"\bIII\.\s*Award\b").startswith(rf"III\.(?<!{WORD}....)")
    assert any_of([r"\bAward Notes\b"]) == f"Award Note(?<!{WORD}..........)s(?!{WORD})"
    texts = ["III. Award", "xIII. award", "\U00010000iii.Award", "\U0001f600 ııİ.AWARD", "iii. Awards", "\U0001f600III. Award", "xIII. Award III. Award"]
    found = apply(texts, lambda c: F.array_join(F.regexp_extract_all(c, F.lit(caseless([r"\bIII\.\s*Award\b"])), F.lit(0)), "|"))
    assert found == ["III. Award", "", "", "ııİ.AWARD", "", "III. Award", "III. Award"]
    assert apply(["a|b", "III. Award", "iv. x"], lambda c: c.rlike(caseless([r"a\|b", r"\bIV\.", r"II"]))) == [True, True, True]
