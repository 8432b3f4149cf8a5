"""Plain-text column operators: white space, stripping, folding, boilerplate, joins."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import LOOSE_SPACE, SPACE, caseless, required_literal


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside one column expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sql_text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def or_empty(c: Column) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(c, F.lit(""))


def or_null(c: Column) -> Column:
    """The empty string becomes null (evaluating ``c`` once, unlike ``nullif``)."""
    return F.get(F.array_remove(F.array(c), ""), F.lit(0))


def clean_text(c: Column) -> Column:
    """Collapse every run of Unicode white space to one space and strip; null -> ``""``."""
    return F.trim(F.regexp_replace(or_empty(c), LOOSE_SPACE, " "))


def strip_space(c: Column) -> Column:
    """Remove leading and trailing Unicode white space (``trim`` knows U+0020 only)."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+\z", "")


def fold_case(c: Column) -> Column:
    """Lower-case form in which an ASCII pattern finds what a caseless match would find.

    Besides lower-casing, the three letters that match ``i`` and ``s`` without being
    their lower-case forms are replaced (the Kelvin sign already lower-cases to ``k``).
    """
    letters = (("İ", "i"), ("ı", "i"), ("ſ", "s"))
    plain_form = c
    for letter, plain in letters:
        plain_form = F.replace(plain_form, F.lit(letter), F.lit(plain))
    # hardly any text holds one of them, and a search costs less than a replacement
    some = c.contains(letters[0][0]) | c.contains(letters[1][0]) | c.contains(letters[2][0])
    return F.lower(F.when(some, plain_form).otherwise(c))


def may_match(folded: Column, patterns: Iterable[str]) -> Column:
    """Cheap necessary condition: the folded text holds a literal of some pattern."""
    literals = list(dict.fromkeys(required_literal(p) for p in patterns))
    if "" in literals:
        return F.lit(True)
    condition = folded.contains(literals[0])
    for literal in literals[1:]:
        condition = condition | folded.contains(literal)
    return condition


def cut_phrases(c: Column, patterns: Iterable[str]) -> Column:
    """Delete each phrase (any case), leaving one space."""
    for p in patterns:
        c = F.regexp_replace(c, caseless([p]), " ")
    return c


def remove_phrases(c: Column, patterns: Iterable[str]) -> Column:
    """Delete each phrase (any case), leaving one space, then clean the text."""
    return clean_text(cut_phrases(c, patterns))


def join_list(c: Column, separator: str = "; ") -> Column:
    """Join an array of strings; an empty or null list gives ``""``."""
    return or_empty(F.array_join(c, separator))


def longer_than(c: Column, gate: int) -> Column:
    """Keep text of more than ``gate`` characters, else null."""
    return let(c, lambda x: F.when(F.length(x) > gate, x))
