"""Scalar operators: dates, URLs, page keys, money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv
from .patterns import (
    ANY_CASE, LOOSE_SPACE, SPACE, SPACE_CHARS, WORD_END, WORD_START, first_sign, portable,
)
from .text import let, or_empty, or_null, strip_space

MONTH = "(?:" + "|".join(fv.MONTHS) + ")"
# "Month d, yyyy" as written in running text
DATE_AS_WRITTEN = f"{MONTH}{SPACE}+[0-9]{{1,2}},{SPACE}+[0-9]{{4}}"
# in front of a search for either
_MONTH_START = f"{first_sign(fv.MONTHS)}{ANY_CASE}{WORD_START}"
# the same with an optional space after the comma
_DATE_LOOSE = f"{MONTH}{SPACE}+[0-9]{{1,2}},{SPACE}*[0-9]{{4}}"


def iso_date(c: Column) -> Column:
    """First English date as ``yyyy-MM-dd`` (not checked against the calendar), else null."""
    pairs = ",".join(f"{m.lower()}:{n:02d}" for n, m in enumerate(fv.MONTHS, 1))
    numbers = F.str_to_map(F.lit(pairs))

    def assemble(found: Column) -> Column:
        # the matched text is short, so taking it apart again costs little; a split compiles its
        # pattern for every row, unless that is one plain sign
        words = F.split(F.regexp_replace(F.lower(found), f"[{SPACE_CHARS},]+", " "), " ")
        return let(
            words,
            lambda w: F.concat_ws(
                "-", F.get(w, F.lit(2)), F.element_at(numbers, F.get(w, F.lit(0))),
                F.lpad(F.get(w, F.lit(1)), 2, "0"),
            ),
        )

    found = or_null(F.regexp_extract(c, f"{_MONTH_START}{_DATE_LOOSE}{WORD_END}", 0))
    iso = let(found, lambda d: F.when(d.isNotNull(), assemble(d)))
    # a month spelt with a look-alike letter has no number: no date
    return let(iso, lambda d: F.when(F.length(d) == 10, d))


def date_as_written(c: Column) -> Column:
    """First ``Month d, yyyy`` in its original spelling, ``""`` if there is none."""
    return F.regexp_extract(c, f"{_MONTH_START}{DATE_AS_WRITTEN}{WORD_END}", 0)


def calendar_date(c: Column) -> Column:
    """The date type of an ISO string; null where the calendar has no such day."""
    return c.try_cast("date")


def normalize_url(c: Column) -> Column:
    """Strip space and quotes, add ``https://`` unless a scheme is present; blank -> null."""
    bare = F.btrim(F.btrim(strip_space(c), F.lit('"')), F.lit("'"))
    return let(
        or_null(bare),
        lambda u: F.when(u.startswith("http://") | u.startswith("https://"), u).otherwise(
            F.concat(F.lit("https://"), u)
        ),
    )


def safe_filename(c: Column, max_length: int = fv.KEY_MAX_LENGTH) -> Column:
    """File-name form of a text: unsafe runs and spaces become ``_``; never empty."""
    spaced = F.regexp_replace(strip_space(or_empty(c)), LOOSE_SPACE, " ")
    name = F.translate(F.regexp_replace(spaced, "[^a-zA-Z0-9._ -]+", "_"), " ", "_")
    cut = let(
        name,
        lambda n: F.when(
            F.length(n) > max_length, F.rtrim(F.substring(n, 1, max_length), F.lit("_"))
        ).otherwise(n),
    )
    return F.coalesce(or_null(cut), F.lit(fv.KEY_EMPTY))


def sha1_hex(c: Column) -> Column:
    """Lower-case hexadecimal SHA-1 of the UTF-8 bytes."""
    return F.sha1(c)


def page_key(url: Column, title: Column, program_id: Column, nsf_pd_num: Column) -> Column:
    """Stable key of a job's page: its known parts (else the URL) plus a hash of the URL."""
    parts = F.concat_ws("__", or_null(nsf_pd_num), or_null(program_id), or_null(title))
    name = safe_filename(F.coalesce(or_null(parts), url))
    return F.concat(name, F.lit("__"), F.substring(sha1_hex(url), 1, fv.KEY_HASH_LENGTH))


def money_pattern(strict_units: bool = False) -> str:
    return ANY_CASE + portable(fv.MONEY_STRICT if strict_units else fv.MONEY)


def money_tokens(c: Column, strict_units: bool = False) -> Column:
    """All money amounts of a text as written, in text order."""
    return F.regexp_extract_all(c, F.lit(money_pattern(strict_units)), F.lit(0))


def money_value(c: Column) -> Column:
    """Number behind one amount; unreadable text is 0."""
    digits = F.regexp_replace(c, "[^0-9.]", "").try_cast("double")
    unit = F.lower(c)
    scale = (
        F.when(unit.contains("m"), 1e6)
        .when(unit.contains("b"), 1e9)
        .when(unit.contains("k"), 1e3)
        .otherwise(1.0)
    )
    return F.coalesce(digits * scale, F.lit(0.0))


def file_stem(path: Column) -> Column:
    """Last path segment without its last suffix."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)
