"""Regular-expression building blocks that mean the same on every JVM.

Java's ``\\s``, ``\\d`` and ``\\b`` change meaning with flags and JDK version, so
markers and rules are written with the usual shorthands and expanded here into
explicit Unicode classes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

# Every character that Unicode-aware text processing counts as white space: the
# White_Space property and the four ASCII separators it leaves out. One property test
# per character is several times faster than a list of ranges.
SPACE_CHARS = r"\p{IsWhite_Space}\x1c\x1d\x1e\x1f"
SPACE = f"[{SPACE_CHARS}]"
# White space that is not already one plain space.
LOOSE_SPACE = f"{SPACE}(?:{SPACE}++|(?<! ))"
# The letter U+10000, a member of \p{L} anyway, makes the engine look back by whole
# characters instead of UTF-16 units.
WORD = "[\\p{L}\\p{N}_\U00010000]"
WORD_START = f"(?<!{WORD})"
WORD_END = f"(?!{WORD})"

# case-insensitive (Unicode), dot matches line ends
ANY_CASE = "(?isu)"


def portable(pattern: str) -> str:
    """Expand ``\\b``, ``\\B``, ``\\w``, ``\\s``, ``\\d`` and their negations into explicit classes.

    A ``\\b`` before a letter or digit that must be there is a word start, one behind such a
    sign a word end; any other one is tested on both sides. The result is meant for flags
    under which the dot matches every character (``ANY_CASE``).
    """

    # At most positions the letters differ, so all that are known are compared, as one slice, before
    # looking back.
    # Escapes are taken one after another, so an escaped backslash before b is no boundary. A
    # group's name, of which the two languages allow different ones, says nothing here.
    def start(m: re.Match) -> str:
        if m[1]:
            # the last letter stays behind, where a word end at hand looks for it
            head, last = (m[1][:-1], m[1][-1]) if len(m[1]) > 1 and m[1][-1].isalnum() else (m[1], "")
            signs = re.sub(r"\\(.)", r"\1", head)
            return f"{head}(?<!{WORD}{'.' * len(signs)}){last}"
        return "(" if m[0].startswith("(") else m[0]

    known = r"([A-Za-z0-9](?![?*+{])(?:(?:[A-Za-z0-9 ]|\\[.:-])(?![?*+{]))*)"
    expanded = re.sub(rf"(?s)\\(?:b{known}|.)|\(\?P<\w+>", start, pattern)

    def piece(m: re.Match) -> str:
        if m[0] == r"\b":
            return _boundary(expanded, m.start(), m.end())
        if m[0].startswith("["):
            return "[" + re.sub(r"\\.", lambda c: _INSIDE.get(c[0], c[0]), m[0][1:])
        return _OUTSIDE.get(m[0], m[0])

    return re.sub(r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]", piece, expanded)


def _boundary(pattern: str, start: int, end: int) -> str:
    """Word start, word end, or either, for a ``\\b`` at this place of a pattern."""
    before = re.search(r"(?<!\\)(?:\\\\)*([A-Za-z0-9])$|\\[wd]$", pattern[:start])
    after = re.match(r"(?:[A-Za-z0-9]|\\[wd])(?![?*{])", pattern[end:])
    if before and not after:
        return WORD_END
    if after and not before:
        return WORD_START
    return f"(?:{WORD_START}(?={WORD})|(?<={WORD}){WORD_END})"


# as they stand outside and inside of a class
_OUTSIDE = {
    r"\s": SPACE, r"\S": f"[^{SPACE_CHARS}]", r"\d": "[0-9]", r"\D": "[^0-9]", r"\w": f"[_{WORD[1:]}",
    r"\W": f"[^_{WORD[1:]}", r"\B": f"(?:{WORD_START}{WORD_END}|(?<={WORD})(?={WORD}))",
}
_INSIDE = {r"\s": SPACE_CHARS, r"\d": "0-9", r"\w": WORD[1:-1]}


def any_of(patterns: Iterable[str]) -> str:
    """One alternation; on equal positions the first-listed pattern wins."""
    patterns = tuple(patterns)
    # a group around a single pattern would be entered at every position
    if len(patterns) == 1 and "|" not in patterns[0]:
        return portable(patterns[0])
    return "(?:" + "|".join(portable(p) for p in patterns) + ")"


def caseless(patterns: Iterable[str]) -> str:
    """Search for any of the patterns in any case: one starts at once with its known letters, of
    several the first signs are tested before."""
    patterns = tuple(patterns)
    return f"{first_sign(patterns) if len(patterns) > 1 else ''}{ANY_CASE}{any_of(patterns)}"


# letters that match under ANY_CASE without being a plain letter's two cases
_LOOK_ALIKES = {"i": "\u0130\u0131", "k": "\u212a", "s": "\u017f"}


def first_sign(patterns: Iterable[str]) -> str:
    """Lookahead for the first sign of a match of ``patterns``, to stand in front of ``ANY_CASE``.

    A class of plain signs is tested several times faster than the start of a caseless pattern,
    and rules out most positions. ``""`` (no test) where a pattern's first sign is not known.
    """
    signs = ""
    for p in patterns:
        first = re.match(r"(?:\\b)?([A-Za-z0-9])(?![?*{])", p)
        if not first or "|" in p:
            return ""
        letter = first[1].lower()
        signs += letter + letter.upper() + _LOOK_ALIKES.get(letter, "")
    return f"(?=[{''.join(dict.fromkeys(signs))}])" if signs else ""


def required_literal(pattern: str) -> str:
    """Longest lower-case text that every match of ``pattern`` must contain.

    Used as a cheap substring test in front of the regular expression. Returns ``""``
    (which every text contains) when nothing can be guaranteed.
    """
    if "|" in pattern:
        return ""
    gap = "\x00"
    # a repeated sign may be missing; lookarounds and flags promise nothing
    if re.search(r"\(\?(?!:)", pattern):
        return ""
    escapes = r"\\x[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\[pP]\{[^}]*\}|\\."
    p = re.sub(rf"(?:{escapes}|\[\^?\]?(?:\\.|[^\]\\])*\]|.)\{{[^}}]*\}}|{escapes}|\[\^?\]?(?:\\.|[^\]\\])*\]", gap, pattern.replace("(?:", "("))
    while (inner := re.sub(r"\([^()]*\)", gap, p)) != p:
        p = inner
    p = re.sub(r"[^\x00][?*]", gap, p)
    return max(re.split(r"[\x00.^$+?*()]", p), key=len).lower()
