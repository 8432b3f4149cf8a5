"""Field extraction from clean page text.

``folded`` arguments take ``fold_case(text)``: pages that cannot match skip the regular
expression after a substring test. Leaving them out changes cost only. ``clean`` says that the
text went through ``clean_text``: white space in its parts is then collapsed already, and only
their ends are stripped.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import Profile
from .patterns import ANY_CASE, SPACE, WORD_END, WORD_START, any_of, caseless, first_sign, portable
from .scalars import DATE_AS_WRITTEN, date_as_written, iso_date, money_tokens, money_value
from .text import clean_text, let, longer_than, may_match, or_empty, or_null



def _numbered(prefix: str) -> str:
    return rf"{prefix}{SPACE}*[0-9]{{2}}-[0-9]+"


def _part(part: Column, clean: bool) -> Column:
    """``clean_text`` of a part of a text that is clean already, or not."""
    return F.trim(or_empty(part)) if clean else clean_text(part)


def slice_between(
    text: Column, starts: Iterable[str], ends: Iterable[str], folded: Column | None = None,
    clean: bool = False,
) -> Column:
    """Clean text after the first start marker, up to the first end marker behind it.

    The leftmost start wins, among starts at one position the first listed. ``""``
    without a start; to the end of the text without an end.
    """
    starts = tuple(starts)
    tail = F.regexp_extract(text, f"{caseless(starts)}(.*)", 1)
    if ends := tuple(ends):
        tail = F.regexp_replace(tail, f"{caseless(ends)}.*", "")
    section = _part(tail, clean)
    if folded is None:
        return section
    return F.when(may_match(folded, starts), section).otherwise(F.lit(""))


def identifier(full_title: Column, stem: Column, prefix: str = "NSF") -> Column:
    """Identifier from the title, else from contiguous digits in the file stem, else ``""``."""
    in_title = clean_text(
        F.regexp_extract(full_title, f"{ANY_CASE}{WORD_START}{_numbered(prefix)}{WORD_END}", 0)
    )
    in_stem = let(
        F.regexp_extract(stem, f"{ANY_CASE}{prefix}([0-9]{{5,}})", 1),
        lambda n: F.when(
            n != "",
            F.concat(F.lit(prefix + " "), F.substring(n, 1, 2), F.lit("-"), F.substr(n, F.lit(3))),
        ),
    )
    return F.coalesce(or_null(in_title), in_stem, F.lit(""))


def title(full_title: Column, stem: Column, prefix: str = "NSF") -> Column:
    """Title without the site suffix and the leading identifier; else the file stem."""
    cut = F.trim(F.regexp_replace(full_title, rf"{ANY_CASE}\|{SPACE}*{prefix}.*", ""))
    bare = F.trim(F.regexp_replace(cut, f"{ANY_CASE}^{_numbered(prefix)}{SPACE}*:{SPACE}*", ""))
    return F.coalesce(or_null(bare), F.replace(stem, F.lit("__"), F.lit(" ")))


def agency(text: Column, profile: Profile) -> Column:
    """Agency name if its phrase occurs (case-sensitive), else the missing value."""
    return F.when(text.contains(profile.agency_phrase), profile.agency_name).otherwise(
        F.lit(profile.agency_missing)
    )


def posted_date(
    item_text: Column, text: Column, profile: Profile, folded: Column | None = None
) -> Column:
    """Posting date from the text of the labelled list item, else from running text.

    An item that exists is final, even when it holds no date.
    """
    label = portable(profile.posted_label.rstrip(":"))
    start = first_sign([profile.posted_label])
    in_text = iso_date(
        F.regexp_extract(
            text,
            f"{start}{ANY_CASE}{WORD_START}{label}{SPACE}*:{SPACE}*{DATE_AS_WRITTEN}{WORD_END}",
            0,
        )
    )
    if folded is not None:
        in_text = F.when(may_match(folded, [label]), in_text)
    return F.when(or_empty(item_text) != "", iso_date(item_text)).otherwise(in_text)


def due_date(text: Column, profile: Profile, folded: Column | None = None) -> Column:
    """``struct<raw, iso>`` of the due date.

    Each label opens a window of bounded length, read in page order; in a window the
    "anytime" phrase beats a date. Without a usable window the phrase may occur
    anywhere. ``raw`` is ``""`` when nothing is found; ``iso`` is null without a date.
    """
    anytime = profile.anytime_phrase
    phrase = portable(anytime)
    windows = F.regexp_extract_all(
        text,
        F.lit(f"{first_sign([profile.due_label])}{ANY_CASE}(?={portable(profile.due_label)})(?=(.{{1,{profile.due_window}}}))"),
        F.lit(1),
    )
    # no window of a page holds a phrase that the page does not
    some = F.lit(True) if folded is None else may_match(folded, [anytime])
    found = F.transform(
        windows,
        lambda w: F.when(some & w.rlike(caseless([anytime])), F.lit(anytime)).otherwise(date_as_written(w)),
    )
    first = F.get(F.filter(found, lambda r: r != ""), F.lit(0))
    anywhere = F.when(text.rlike(f"{first_sign([anytime])}{ANY_CASE}{WORD_START}{phrase}{WORD_END}"), F.lit(anytime))
    if folded is not None:
        first = F.when(may_match(folded, [profile.due_label]), first)
        anywhere = F.when(may_match(folded, [anytime]), anywhere)
    return let(
        F.coalesce(first, anywhere, F.lit("")),
        lambda raw: F.struct(raw.alias("raw"), iso_date(raw).alias("iso")),
    )


def description(
    text: Column, profile: Profile, folded: Column | None = None, clean: bool = False
) -> Column:
    """Description section without one leading date; ``""`` under the minimal length."""
    section = slice_between(text, profile.description_starts, profile.description_ends, folded, clean)
    bare = _part(F.regexp_replace(section, f"{ANY_CASE}^{DATE_AS_WRITTEN}{SPACE}*", ""), True)
    return let(
        bare, lambda d: F.when(F.length(d) >= profile.description_min, d).otherwise(F.lit(""))
    )


def award_section(
    text: Column, profile: Profile, folded: Column | None = None, clean: bool = False
) -> Column:
    return slice_between(text, profile.award_starts, profile.award_ends, folded, clean)


def rank_amounts(section: Column, strict_units: bool = False) -> Column:
    """Positive amounts of a section as ``array<struct<v, pos, raw>>``, ascending.

    ``pos`` keeps text order among equal amounts.
    """
    amounts = F.transform(
        money_tokens(section, strict_units),
        lambda raw, pos: F.struct(money_value(raw).alias("v"), pos.alias("pos"), raw.alias("raw")),
    )
    return F.array_sort(F.filter(amounts, lambda a: a.v > 0))


def award_from_amounts(ranked: Column) -> Column:
    """``struct<total, range>``: the largest amount, and the span of the others."""
    others = F.size(ranked) - 1

    def raw(index: Column) -> Column:
        return F.get(ranked, index).getField("raw")

    span = F.when(
        others >= 2, F.concat(raw(F.lit(0)), F.lit(" - "), raw(others - 1))
    ).when(others == 1, raw(F.lit(0)))
    total = F.when(others >= 0, clean_text(raw(others)))
    return F.struct(total.alias("total"), span.alias("range"))


def award(section: Column, strict_units: bool = False) -> Column:
    """``struct<total, range>`` of an award section; both null without a positive amount."""
    ranked = let(
        section, lambda s: F.when(s.contains("$"), rank_amounts(s, strict_units))
    )
    return let(ranked, award_from_amounts)


def eligibility(
    text: Column, profile: Profile, folded: Column | None = None, clean: bool = False
) -> Column:
    """Text behind the label in the section, else the section, else behind a global label.

    Each candidate counts only above the minimal length; the global label also needs
    one of the stop phrases behind it.
    """
    label = caseless([profile.eligibility_label])
    gate = profile.eligibility_over
    section = slice_between(text, profile.eligibility_starts, profile.eligibility_ends, folded, clean)
    in_section = let(
        section,
        lambda s: F.coalesce(
            longer_than(_part(F.regexp_extract(s, f"{label}(.+)", 1), True), gate),
            longer_than(s, gate),
        ),
    )
    in_page = _part(
        F.regexp_extract(text, f"{label}(.+?){any_of(profile.eligibility_stops)}", 1), clean
    )
    if folded is not None:
        in_page = F.when(
            may_match(folded, [profile.eligibility_label])
            & may_match(folded, profile.eligibility_stops),
            in_page,
        )
    return or_empty(F.coalesce(in_section, longer_than(in_page, gate)))
