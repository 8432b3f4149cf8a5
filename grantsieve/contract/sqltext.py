"""SQL expressions of the operators for DuckDB, written independently of the Spark side.

DuckDB's regular expressions have ASCII ``\\b`` and no lookaround, so these are separate
patterns, suited to the fixture pages and the given tables.
"""

from __future__ import annotations

from ..functions.fixed_values import MONTHS, TOPIC_RULES

SPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
MONTH = "(?:" + "|".join(MONTHS) + ")"
DATE = rf"\b{MONTH}\s+\d{{1,2}},\s+\d{{4}}\b"
MONEY = r"\$\s*\d[\d,]*(?:\.\d+)?(?:\s*(?:[KMB]|million|billion))?"
ENTITIES = {
    "&nbsp;": "chr(160)", "&middot;": "'·'", "&copy;": "'©'", "&quot;": "'\"'", "&mdash;": "'—'",
    "&eacute;": "'é'", "&#8217;": "'’'", "&#x2019;": "'’'", "&lt;": "'<'", "&gt;": "'>'",
    "&amp;": "'&'",
}
ANYTIME = "Proposals Accepted Anytime"


def clean(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{SPACE}+', ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{SPACE}+', ''), '{SPACE}+$', '')"


def decode(x: str) -> str:
    for name, char in ENTITIES.items():
        x = f"replace({x}, '{name}', {char})"
    return x


def markup_text(x: str) -> str:
    kept = rf"""regexp_replace({x}, '(?s)<!\[CDATA\[(.*?)\]\]>', ' \1 ', 'g')"""
    bare = rf"""regexp_replace({kept}, '<[A-Za-z/!?](?:=\s*"[^"]*"|=\s*''[^'']*''|[^>])*>', ' ', 'g')"""
    return clean(decode(bare))


def visible(html: str) -> str:
    return (
        f"regexp_replace({html}, '(?is)<!--.*?-->|<script.*?(?:</script[^>]*>|$)|<style.*?</style>', ' ', 'g')"
    )


def root(v: str) -> str:
    return (
        rf"CASE WHEN regexp_matches({v}, '(?i)<main[\s>]') THEN regexp_extract({v}, '(?is)<main[^>]*>(.*?)(?:</main|$)', 1) "
        rf"WHEN regexp_matches({v}, '(?i)<body[\s>]') THEN regexp_extract({v}, '(?is)<body[^>]*>(.*?)(?:</body|$)', 1) ELSE {v} END"
    )


def without_boilerplate(x: str) -> str:
    a = rf"regexp_replace({x}, '(?i)\bSkip to main content\b', ' ', 'g')"
    return clean(rf"regexp_replace({a}, '(?i)\bNational Science Foundation\b\s+Search', ' ', 'g')")


def page_text(html: str) -> str:
    """Page text in one expression over ``html``."""
    return f"(SELECT {without_boilerplate(markup_text(root('v')))} FROM (SELECT {visible(html)} AS v))"


def title_markup(v: str) -> str:
    return f"regexp_extract({v}, '(?is)<title[^>]*>(.*?)</title', 1)"


def heading(v: str) -> str:
    h1 = f"""regexp_extract({v}, '(?is)<h1[^>]*class="[^"]*solicitation__title[^"]*"[^>]*>(.*?)</h1', 1)"""
    return f"coalesce(nullif({markup_text(h1)}, ''), {markup_text(title_markup(v))})"


def posted_item(v: str) -> str:
    item = (
        rf"""regexp_extract({v}, '(?is)<li[^>]*>(\s*<span[^>]*class="[^"]*document-info_label[^"]*"[^>]*>"""
        r"""(?:\s|<[^>]*>)*Posted:(?:\s|<[^>]*>)*</span>.*?)</li', 1)"""
    )
    return markup_text(item)


def canonical(v: str) -> str:
    link = f"""regexp_extract({v}, '<link[^>]*rel="(?:shortlink )?canonical"[^>]*>', 0)"""
    meta = f"""regexp_extract({v}, '<meta[^>]*property="og:url"[^>]*>', 0)"""
    href = f"""nullif(regexp_extract({link}, 'href="([^"]*)"', 1), '')"""
    return f"""{strip(decode(f"coalesce({href}, regexp_extract({meta}, 'content=\"([^\"]*)\"', 1), '')"))}"""


def iso(x: str) -> str:
    names = ", ".join(f"'{m.lower()}'" for m in MONTHS)
    pattern = rf"(?i)\b({MONTH})\s+(\d{{1,2}}),\s*(\d{{4}})\b"
    return (
        f"(SELECT CASE WHEN g.y <> '' THEN g.y || '-' || lpad(cast(list_position([{names}], lower(g.m)) AS varchar), 2, '0') "
        f"|| '-' || lpad(g.d, 2, '0') END FROM (SELECT regexp_extract({x}, '{pattern}', ['m', 'd', 'y']) AS g))"
    )


def raw_date(x: str) -> str:
    return f"regexp_extract({x}, '(?i){DATE}', 0)"


def foa_id(title: str, stem: str) -> str:
    first = clean(rf"regexp_extract({title}, '(?i)\bNSF\s*\d{{2}}-\d+\b', 0)")
    return (
        f"(SELECT coalesce(nullif({first}, ''), CASE WHEN d.a <> '' THEN 'NSF ' || d.a || '-' || d.b END, '') "
        rf"FROM (SELECT regexp_extract({stem}, '(?i)nsf(\d{{2}})(\d{{3,}})', ['a', 'b']) AS d))"
    )


def title(full: str, stem: str) -> str:
    cut = rf"trim(regexp_replace({full}, '(?is)\|\s*NSF.*$', ''))"
    bare = rf"trim(regexp_replace({cut}, '(?i)^NSF\s*\d{{2}}-\d+\s*:\s*', ''))"
    return f"coalesce(nullif({bare}, ''), replace({stem}, '__', ' '))"


def agency(text: str) -> str:
    return (
        f"CASE WHEN contains({text}, 'National Science Foundation') "
        "THEN 'National Science Foundation (NSF)' ELSE 'Unknown' END"
    )


def open_date(item: str, text: str) -> str:
    fallback = rf"regexp_extract({text}, '(?i)\bPosted\s*:\s*{MONTH}\s+\d{{1,2}},\s+\d{{4}}\b', 0)"
    return f"CASE WHEN {item} <> '' THEN {iso(item)} ELSE {iso(fallback)} END"


def due_raw(text: str) -> str:
    label = "Full Proposal Deadline"
    window = f"substr('{label}' || array_to_string(p[i:], '{label}'), 1, 500)"
    hits = (
        f"[CASE WHEN regexp_matches(w, '(?i){ANYTIME}') THEN '{ANYTIME}' ELSE {raw_date('w')} END "
        f"FOR w IN [{window} FOR i IN range(2, len(p) + 1)]]"
    )
    return (
        f"(SELECT coalesce([x FOR x IN {hits} IF x <> ''][1], "
        rf"CASE WHEN regexp_matches({text}, '(?i)\b{ANYTIME}\b') THEN '{ANYTIME}' END, '') "
        f"FROM (SELECT string_split_regex({text}, '(?i){label}') AS p))"
    )


def section(text: str, start: str, end: str) -> str:
    tail = f"regexp_extract({text}, '(?is)(?:{start})(.*)$', 1)"
    return clean(f"regexp_replace({tail}, '(?is)(?:{end}).*$', '')")


def description(text: str) -> str:
    s = section(
        text, r"\bII\.\s*Program Description\b\s*:?",
        r"\bOverall Approach\b|\bIII\.\s*Award Information\b",
    )
    bare = clean(rf"regexp_replace({s}, '(?i)^{MONTH}\s+\d{{1,2}},\s+\d{{4}}\s*', '')")
    return f"(SELECT CASE WHEN length(d) >= 40 THEN d ELSE '' END FROM (SELECT {bare} AS d))"


def award_section(text: str) -> str:
    return section(
        text, r"\bIII\.\s*Award Information\b",
        r"\bIV\.\s*Eligibility Information\b|\bIV\.\s*Eligibility\b|\bV\.\s*Proposal Preparation\b",
    )


def eligibility_section(text: str) -> str:
    return section(
        text,
        r"\bIV\.\s*Eligibility Information\b\s*:?|\bIV\.\s*Eligibility\b\s*:?",
        r"\bV\.\s*Proposal Preparation and Submission Instructions\b|\bV\.\s*Proposal Preparation\b"
        r"|\bVI\.\s*NSF Proposal Processing\b|\bVI\.\s*Proposal Review Information\b",
    )


def money_tokens(x: str) -> str:
    return f"regexp_extract_all({x}, '(?i){MONEY}')"


def money_value(x: str) -> str:
    return (
        f"coalesce(try_cast(regexp_replace({x}, '[^0-9.]', '', 'g') AS double) * "
        f"CASE WHEN contains(lower({x}), 'm') THEN 1e6 WHEN contains(lower({x}), 'b') THEN 1e9 "
        f"WHEN contains(lower({x}), 'k') THEN 1e3 ELSE 1e0 END, 0e0)"
    )


def ranked_amounts(sec: str) -> str:
    return (
        f"list_sort([s FOR s IN list_transform({money_tokens(sec)}, lambda tok, i: "
        f"struct_pack(v := {money_value('tok')}, pos := i, raw := tok)) IF s.v > 0])"
    )


def award_total(ranked: str) -> str:
    return f"CASE WHEN len({ranked}) > 0 THEN {clean(f'{ranked}[-1].raw')} END"


def award_range(ranked: str) -> str:
    return (
        f"CASE WHEN len({ranked}) > 2 THEN {ranked}[1].raw || ' - ' || {ranked}[len({ranked}) - 1].raw "
        f"WHEN len({ranked}) = 2 THEN {ranked}[1].raw END"
    )


def in_section(sec: str) -> str:
    cand = clean(rf"regexp_extract({sec}, '(?i)Who May Submit Proposals\s*:?\s*(.+)', 1)")
    return (
        f"CASE WHEN length({cand}) > 30 THEN {cand} WHEN length({sec}) > 30 THEN {sec} ELSE '' END"
    )


def global_label(text: str) -> str:
    cand = clean(
        rf"regexp_extract({text}, '(?is)Who May Submit Proposals\s*:?\s*(.+?)(?:Proposal Preparation and "
        r"Submission Instructions|C\.\s*Due Dates|Merit Review Criteria|Award Administration Information)', 1)"
    )
    return f"CASE WHEN length({cand}) > 30 THEN {cand} ELSE '' END"


def tags(text: str, rules=TOPIC_RULES, prefix: str = "tags_") -> dict[str, str]:
    """Joined labels per category."""
    out = {}
    for category, labels in rules.items():
        cases = []
        for label, patterns in labels.items():
            bodies = "|".join(p.replace(r"\b", "") for p in patterns)
            hit = rf"regexp_matches({text}, '(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:{bodies})(?:$|[^\p{{L}}\p{{N}}_])')"
            cases.append(f"CASE WHEN {hit} THEN '{label}' END")
        out[prefix + category] = f"concat_ws('; ', {', '.join(cases)})"
    return out


def normalize_url(x: str) -> str:
    bare = f"""nullif(trim(trim({strip(x)}, '"'), ''''), '')"""
    return (
        f"CASE WHEN starts_with({bare}, 'http://') OR starts_with({bare}, 'https://') THEN {bare} "
        f"ELSE 'https://' || {bare} END"
    )


def safe_filename(x: str) -> str:
    name = (
        f"replace(regexp_replace({clean(x)}, '[^a-zA-Z0-9._ -]+', '_', 'g'), ' ', '_')"
    )
    cut = f"CASE WHEN length({name}) > 140 THEN rtrim(substr({name}, 1, 140), '_') ELSE {name} END"
    return f"coalesce(nullif({cut}, ''), 'page')"


def page_key(url: str, title: str, program_id: str, nsf_pd_num: str) -> str:
    parts = f"nullif(concat_ws('__', {nsf_pd_num}, {program_id}, {title}), '')"
    return f"{safe_filename(f'coalesce({parts}, {url})')} || '__' || substr(sha1({url}), 1, 10)"
