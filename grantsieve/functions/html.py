"""HTML to columns, without building a tree.

Every operator is a short chain of built-in string expressions over the page source,
so pages are processed inside the JVM as they are scanned. Supported is the regular
subset of HTML: tags may carry quoted attributes holding ``>``. Where elements of one name
are nested (``main`` in ``main``, ``li`` in ``li``), tags are counted: see ``_enclosed``.
"""

from __future__ import annotations

from collections.abc import Iterable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv
from .patterns import SPACE_CHARS
from .text import clean_text, let, or_null, sql_text, strip_space

# Possessive groups run as loops in the regex engine: no recursion on long inputs, and
# jumping from "<" to "<" beats testing for the end at every character.
# A quote opens a value behind "=" only.
_ATTRIBUTES = r"""(?:[^>=]++|=(?:\s*+(?:"[^"]*+"|'[^']*+'))?+)*+"""
_CDATA = r"<!\[CDATA\[((?:[^\]]++|\](?!\]>))*+)\]\]>"
# most tags have no attributes, and few pages sections of character data
_TAG = rf"<[A-Za-z/!?](?:[^>=]*+>|{_ATTRIBUTES}>|[^>]*+>)"
_MARKUP = rf"{_CDATA}|{_TAG}"


def _up_to(closing: str) -> str:
    """Everything up to (not including) a closing tag of the given names, or the end."""
    return rf"(?:[^<]++|<(?!/(?:{closing})\s*>))*+"


_REFERENCE = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9.-]*)"
# looked up first to last, so the usual names are put in front of the standard list
_USUAL_NAMES = ("amp", "nbsp", "lt", "gt", "quot", "apos", "rsquo", "lsquo", "rdquo",
                "ldquo", "mdash", "ndash", "hellip", "bull", "middot", "copy", "reg",
                "trade", "sect", "deg", "eacute")


def visible_markup(html: Column, hidden_elements: Iterable[str]) -> Column:
    """Drop comments and elements whose content is never page text.

    Such an element ends at its closing tag, whatever that holds, or with the page.
    """
    names = "|".join(hidden_elements)
    comment = r"!--(?:[^-]++|-(?!->))*+(?:-->|\z)"
    element = rf"({names})(?=[\s/>]){_ATTRIBUTES}(?<!/)>(?:[^<]++|<(?!/\1(?=[\s/>])))*+(?:</\1[^>]*+>|\z)"
    return F.regexp_replace(html, f"(?i)<(?:{comment}|{element})", " ")


def _tag_of(names: str, closing: str = "") -> str:
    """Start of an opening tag (or, with ``/``, a closing one) of the given names."""
    return rf"<{closing}(?:{names})(?=[\s/>])"


def _entangled(name: str, names: str) -> str:
    """An element of that name in which another tag of ``names`` than its own closing one comes
    first: it holds such elements, or is left open."""
    return rf"(?i){_tag_of(name)}(?:[^<]++|<(?!/?(?:{names})(?=[\s/>])))*+(?!</{name})"


# The markup is cut in front of every tag that counts. The elements that are open form a
# stack of (name, piece): an opening tag adds one, unless it closes itself; a closing tag ends
# the last open element of its name and all that were opened in it, or nothing if there is none.
# `hit` is the piece of the wanted element, `upto` the piece that ends it.
_WALK = """
aggregate(
  sequence(1, size(p)),
  named_struct('open', cast(array() AS array<struct<name:string,at:int>>), 'hit', 0, 'upto', 0),
  (a, i) -> if(a.upto > 0, a, transform(
    array(named_struct(
      'name', lower(regexp_extract(p[i - 1], '^</?([A-Za-z0-9]+)', 1)),
      'closing', startswith(p[i - 1], '</'), 'bare', p[i - 1] RLIKE '^<[^>]*/>', 'mark', p[i - 1] RLIKE {mark})),
    t -> transform(
      array(CASE
        WHEN t.mark OR t.bare AND NOT t.closing OR t.name = '' THEN a.open
        WHEN NOT t.closing THEN concat(a.open, array(named_struct('name', t.name, 'at', i)))
        WHEN NOT exists(a.open, e -> e.name = t.name) THEN a.open
        ELSE slice(a.open, 1, size(a.open) - array_position(reverse(transform(a.open, e -> e.name)), t.name)) END),
      now -> named_struct(
        'open', now,
        'hit', CASE
          WHEN a.hit > 0 THEN a.hit
          WHEN t.mark THEN coalesce(array_max(filter(a.open, e -> e.name = {wanted}).at), 0)
          WHEN {own} AND NOT t.closing AND t.name = {wanted} THEN i
          ELSE 0 END,
        'upto', if(a.hit > 0 AND NOT exists(now, e -> e.at = a.hit), i, 0)))[0])[0]),
  a -> if(a.hit = 0, '', array_join(slice(p, a.hit, if(a.upto > 0, a.upto, size(p) + 1) - a.hit), '')))"""


def _enclosed(markup: Column, wanted: str, names: str, mark: str = "") -> Column:
    """Source of the first ``wanted`` element, from its tag to the tag that ends it, counting
    the tags of ``names``; ``""`` if there is none. With ``mark``, of the innermost ``wanted``
    element around the first place at which the mark matches inside of one. Tags written
    inside an attribute's value count as tags."""
    cut = rf"(?i)(?=</?(?:{names})(?=[\s/>]))" + (f"|(?={mark})" if mark else "")
    walk = _WALK.format(
        mark=sql_text(f"^(?:{mark})" if mark else "^(?!)"), wanted=sql_text(wanted), own="false" if mark else "true"
    )
    # in front of the first tag stands a piece without a name
    pieces = F.split(F.concat(F.lit(" "), markup), cut, -1)
    return F.get(F.call_function("transform", F.array(pieces), F.expr(f"p -> {walk}")), F.lit(0))


def root_markup(visible: Column, root_elements: Iterable[str]) -> Column:
    """First root element that exists, in order of preference; else the whole page.

    It ends where it is closed, a root element that it stands in is closed, or with the page.
    """
    names = list(root_elements)

    def element(i: int, name: str) -> Column:
        rest = "|".join(names[i:])
        first = F.regexp_extract(visible, rf"(?i)<{name}(?=[\s/>]){_ATTRIBUTES}>{_up_to(rest)}", 0)
        # up to the first closing tag: all of it, unless it holds another opening one
        whole = _enclosed(visible, name, rest)
        inner = rf"(?i)<(?<=.<){_tag_of(name).removeprefix('<')}"
        return let(first, lambda f: F.when(f.rlike(inner), whole).otherwise(f))

    return F.coalesce(*[or_null(element(i, name)) for i, name in enumerate(names)], visible)


def _entity_names() -> str:
    """Map of the standard HTML names, folded to a constant by the optimizer."""
    names = {n[:-1]: v for n, v in html5.items() if n.endswith(";")}
    ordered = {n: names[n] for n in _USUAL_NAMES} | names
    pairs = "\x1e".join(f"{n}\x1f{v}" for n, v in ordered.items())
    return f"str_to_map({sql_text(pairs)}, '\x1e', '\x1f')"


# Character of a numeric reference n such as #8217 or #x2019; k is its number.
_DIGITS = "substr(regexp_replace(n, '^#[xX]?0*', '0'), 1, 12)"
_CHARACTER = "decode(unhex(lpad(hex(k), 8, '0')), 'UTF-32')"
_NUMERIC = f"""
transform(
  array(try_cast(if(lower(substr(n, 2, 1)) = 'x', conv({_DIGITS}, 16, 10), {_DIGITS}) AS bigint)),
  k -> CASE
    WHEN k BETWEEN 128 AND 159
      THEN translate({_CHARACTER}, {sql_text(fv.CP1252_FROM)}, {sql_text(fv.CP1252_TO)})
    WHEN k = 65279 THEN '\ufeff'
    WHEN k BETWEEN 0 AND 55295 OR k BETWEEN 57344 AND 1114111 THEN {_CHARACTER}
    ELSE '\ufffd' END)[0]"""
# One piece p of the text behind an "&"; n is the reference name it starts with.
_PIECE = f"""
transform(
  array(regexp_extract(p, {sql_text(_REFERENCE)}, 1)),
  n -> CASE WHEN n = '' THEN concat('&', p) ELSE concat(
    coalesce(
      CASE WHEN startswith(n, '#') THEN {_NUMERIC} ELSE element_at({_entity_names()}, n) END,
      concat('&', n)),
    substr(p, length(n) + if(substr(p, length(n) + 1, 1) = ';', 2, 1))) END)[0]"""
_DECODE = f"""
t -> if(contains(t, '&'),
  transform(
    array(split(t, '&')),
    parts -> concat(parts[0], array_join(transform(slice(parts, 2, size(parts)), p -> {_PIECE}), ''))
  )[0], t)"""


def decode_entities(c: Column) -> Column:
    """Replace character references, each exactly once (``&amp;lt;`` becomes ``&lt;``).

    The text is cut at ``&``; every piece after the first starts with a reference name.
    An unknown name stays, without its semicolon. Stated as one SQL lambda, which builds
    in one call.
    """
    return F.get(F.call_function("transform", F.array(c), F.expr(_DECODE)), F.lit(0))


def _legacy_names() -> str:
    """Map of the names that the standard also lists without a semicolon."""
    pairs = "\x1e".join(f"{n}\x1f{v}" for n, v in html5.items() if not n.endswith(";"))
    return f"str_to_map({sql_text(pairs)}, '\x1e', '\x1f')"


# In attributes a name needs its semicolon, or is an old one that neither = nor a letter or
# digit follows; any other "&" stays as it is, as query strings have many.
_ATTRIBUTE_PIECE = f"""
transform(
  array(regexp_extract(p, '^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*)', 1)),
  n -> coalesce(CASE
    WHEN n = '' THEN NULL
    WHEN startswith(n, '#')
      THEN concat({_NUMERIC}, substr(p, length(n) + if(substr(p, length(n) + 1, 1) = ';', 2, 1)))
    WHEN substr(p, length(n) + 1, 1) = ';'
      THEN concat(element_at({_entity_names()}, n), substr(p, length(n) + 2))
    WHEN substr(p, length(n) + 1, 1) = '=' THEN NULL
    ELSE concat(element_at({_legacy_names()}, n), substr(p, length(n) + 1)) END,
    concat('&', p)))[0]"""


def decode_attribute(c: Column) -> Column:
    """Replace character references of an attribute's value."""
    return F.get(F.call_function("transform", F.array(c), F.expr(_DECODE.replace(_PIECE, _ATTRIBUTE_PIECE))), F.lit(0))


def markup_text(markup: Column) -> Column:
    """Text of an HTML fragment: tags become spaces, references characters, space is collapsed.

    Of a CDATA section its content stays.
    """

    def bare(m: Column) -> Column:
        kept = F.regexp_replace(m, _MARKUP, " $1 ")
        return F.when(m.contains("<![CDATA["), kept).otherwise(F.regexp_replace(m, _TAG, " "))

    # no reference holds white space, so space is collapsed once, behind the references
    return clean_text(let(let(markup, bare), decode_entities))


def _with_attribute(name: str, value: str) -> str:
    """Lookahead: the tag at hand has attribute ``name`` whose value satisfies ``value``.

    ``value`` is a function of the characters a value may hold.
    """
    quoted = "|".join(f"{q}{value.replace('@', f'[^{q}]')}{q}" for q in ('"', "'"))
    bare = value.replace("@", r"""[^\s"'>]""") + r"(?=[\s/>])"
    return rf"""(?=[^>]*?[\s"'/](?i:{name})\s*=\s*(?:{quoted}|{bare}))"""


def _attribute(tag: Column, name: str) -> Column:
    """Raw value of an attribute inside one extracted tag, ``""`` if absent."""
    raw = F.regexp_extract(tag, rf"""(?is)[\s"'/]{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.regexp_replace(raw, """^["']|["']$""", "")


def canonical_url(visible: Column) -> Column:
    """``href`` of the first canonical link, else content of the first ``og:url``, else ``""``.

    Only the first link and the first meta element count, even when they are empty.
    """
    link = F.regexp_extract(
        visible,
        rf"(?s)<(?i:link)(?=\s){_with_attribute('rel', r'(?:@*\s)?canonical(?:\s@*)?')}{_ATTRIBUTES}>",
        0,
    )
    meta = F.regexp_extract(
        visible,
        rf"(?s)<(?i:meta)(?=\s){_with_attribute('property', 'og:url')}{_ATTRIBUTES}>",
        0,
    )
    raw = F.coalesce(
        F.when(visible.contains("canonical"), or_null(_attribute(link, "href"))),
        F.when(visible.contains("og:url"), _attribute(meta, "content")),
        F.lit(""),
    )
    return strip_space(decode_attribute(raw))


def classed_heading(visible: Column, class_part: str) -> Column:
    """Source of the first ``h1`` of the given class, null when the page has no such class."""
    return F.when(
        visible.contains(class_part),
        F.regexp_extract(
            visible,
            rf"(?s)<(?i:h1)(?=\s){_with_attribute('class', f'@*{class_part}@*')}{_ATTRIBUTES}>"
            rf"({_up_to('(?i:h1)')})</(?i:h1)\s*>",
            1,
        ),
    )


def element_markup(visible: Column, element: str) -> Column:
    """Source inside the first ``element``; ``""`` if there is none."""
    return F.regexp_extract(
        visible,
        rf"(?i)<{element}(?=[\s/>]){_ATTRIBUTES}>({_up_to(element)})</{element}\s*>",
        1,
    )


def heading(visible: Column, class_part: str) -> Column:
    """Text of the first ``h1`` of the given class; if empty, text of ``title``."""
    return F.coalesce(
        or_null(markup_text(classed_heading(visible, class_part))),
        markup_text(element_markup(visible, "title")),
    )


def labelled_item(visible: Column, class_part: str, label: str) -> Column:
    """Source of the first list item holding a ``span`` of the class whose text is ``label``.

    Null or ``""`` when there is no such item; a hit is never empty, as it holds the label.
    """
    space_or_tag = rf"(?:[{SPACE_CHARS}]++|&nbsp;|<(?!/(?i:span))[^>]*+>)*+"
    span = (
        rf"<(?i:span)(?=\s){_with_attribute('class', f'@*{class_part}@*')}{_ATTRIBUTES}>"
        rf"{space_or_tag}(?iu:{label}){space_or_tag}</(?i:span)\s*>"
    )
    flat = F.regexp_extract(
        visible,
        r"(?s)<(?i:li)(?=[\s>])[^>]*>"
        rf"((?:(?!</?(?i:li)[\s>]).)*?{span}.*?)(?:</(?i:li)\s*>|\z)",
        1,
    )
    # items in items, or left open: lists count as well, as their end closes what they hold
    item = F.regexp_replace(_enclosed(visible, "li", "li|ul|ol", span), rf"^<[^>=]*+(?:{_ATTRIBUTES})>", "")
    return F.when(visible.contains(class_part), F.when(visible.rlike(_entangled("li", "li|ul|ol")), item).otherwise(flat))
