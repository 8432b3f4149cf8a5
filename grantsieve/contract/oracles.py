"""SQL of the registered queries for DuckDB."""

from __future__ import annotations

from . import sqltext as q
from .fixtures import attempts_sql, catalogue_sql, order_jobs_sql, solicitations_sql
from .rules import WORD_RULES

JOB_TEXTS = {"title": "Title", "program_id": "Program ID", "nsf_pd_num": "NSF/PD Num"}


def _texts(source: str, keys: str) -> str:
    """Common table expressions ending in ``t``: text, full_title, item, source_url."""
    return (
        f"WITH src AS MATERIALIZED ({source}), "
        f"vis AS MATERIALIZED (SELECT {keys}, {q.visible('html')} AS v FROM src), "
        f"cut AS MATERIALIZED (SELECT {keys}, v, {q.root('v')} AS r FROM vis), "
        f"raw AS MATERIALIZED (SELECT {keys}, v, {q.markup_text('r')} AS x FROM cut), "
        f"t AS MATERIALIZED (SELECT {keys}, {q.without_boilerplate('x')} AS text, "
        f"{q.heading('v')} AS full_title, {q.posted_item('v')} AS item, "
        f"{q.canonical('v')} AS source_url FROM raw)"
    )


def _fields(source: str, keys: str, stem: str = "file_stem") -> str:
    """Adds ``f``: every record field, ``""`` for missing text."""
    return (
        _texts(source, keys)
        + f", sec AS MATERIALIZED (SELECT *, {q.award_section('text')} AS aw, {q.eligibility_section('text')} AS el, "
        f"{q.due_raw('text')} AS dates_raw FROM t), "
        f"amt AS MATERIALIZED (SELECT *, {q.ranked_amounts('aw')} AS am, {q.in_section('el')} AS el1, "
        f"{q.global_label('text')} AS el2 FROM sec), "
        f"f AS MATERIALIZED (SELECT {keys}, {q.foa_id('full_title', stem)} AS foa_id, {q.title('full_title', stem)} AS title, "
        f"{q.agency('text')} AS agency, {q.open_date('item', 'text')} AS open_date, "
        f"{q.iso('dates_raw')} AS close_date, dates_raw, "
        f"CASE WHEN el1 <> '' THEN el1 ELSE el2 END AS eligibility_text, "
        f"{q.description('text')} AS program_description, coalesce({q.award_total('am')}, '') AS total_award, "
        f"coalesce({q.award_range('am')}, '') AS award_range, source_url FROM amt)"
    )


TAG_FIELDS = "title, program_description, eligibility_text, award_range, total_award, dates_raw"
PLAIN = (
    "foa_id, title, agency, open_date, close_date, dates_raw, eligibility_text, "
    "program_description, total_award, award_range, source_url"
)
FLAT = PLAIN.replace(
    "open_date, close_date", "coalesce(open_date, '') AS open_date, coalesce(close_date, '') AS close_date"
)


def _records(source: str, keys: str, columns: str, extra: str = "") -> str:
    tagged = ", ".join(f"{e} AS {n}" for n, e in q.tags("tt").items())
    return (
        _fields(source, keys)
        + f", g AS (SELECT *, concat_ws(' ', {TAG_FIELDS}) AS tt FROM f) SELECT {columns}, {tagged}{extra} FROM g"
    )


# documents that hold the first two words of some document between word bounds: other signs
# than letters, digits and spaces are made one sign, so bounds are plain texts
OPENINGS = r"""
WITH d AS (SELECT doc_id, '|' || regexp_replace(lower(text), '[^\p{L}\p{N} ]', '|', 'g') || '|' AS t, coalesce(lang, '') AS lang,
  lower(regexp_extract(text, '^([A-Za-z0-9]+ [A-Za-z0-9]+)(?:[ .,\n]|$)', 1)) AS p FROM documents),
r AS (SELECT p, min(lang) AS category FROM d WHERE p <> '' GROUP BY p),
found AS (SELECT d.doc_id, r.p, r.category, d.t FROM d JOIN r ON contains(d.t, r.p))
SELECT doc_id, category, string_agg(p, '; ' ORDER BY p) AS labels FROM found
WHERE contains(t, ' ' || p || ' ') OR contains(t, ' ' || p || '|') OR contains(t, '|' || p || ' ') OR contains(t, '|' || p || '|')
GROUP BY doc_id, category
"""


def oracles() -> dict[str, str]:
    sol = solicitations_sql()
    cat = catalogue_sql()
    att = attempts_sql()
    pages = "SELECT page_id, 'page_' || page_id AS file_stem, url, html FROM pages"
    t = _texts(sol, "k, file_stem")
    v = f"WITH vis AS (SELECT k, {q.visible('html')} AS v FROM ({sol}))"
    url = q.normalize_url('"Solicitation URL"')
    texts = ", ".join(f"nullif({q.strip(f'\"{c}\"')}, '') AS {n}" for n, c in JOB_TEXTS.items())
    rows = f"SELECT ord, {url} AS url, {texts} FROM ({cat})"
    live = f"SELECT * FROM ({rows}) WHERE url IS NOT NULL"
    jobs = f"SELECT * FROM ({live}) QUALIFY row_number() OVER (PARTITION BY url ORDER BY ord) = 1"
    key = q.page_key("url", "title", "program_id", "nsf_pd_num")
    found = "url IN (SELECT url FROM pages WHERE html IS NOT NULL)"
    log = (
        f"SELECT ord, url, {found} AS ok, CASE WHEN {found} THEN 200 END AS http_status, "
        f"CASE WHEN NOT {found} THEN 'Unknown error' END AS error, "
        f"CASE WHEN {found} THEN 'landed/' || {key} || '.html' END AS saved_path FROM ({jobs})"
    )
    resolved = (
        f"SELECT {key} AS file_stem, url, p.html FROM ({jobs}) JOIN (SELECT url, html FROM pages "
        "WHERE html IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1) p USING (url)"
    )
    first_jobs = f"SELECT * FROM ({jobs}) ORDER BY ord LIMIT 100"
    first_pages = resolved.replace(f"({jobs})", f"({first_jobs})")
    strict_money = r"(?i)\$\s*\d(?:[\d,]*\d)?(?:\.\d+)?(?:\s*(?:million\b|billion\b|[KMB]\b))?"

    def attempts(retries: int) -> str:
        first = "min(struct_pack(a := attempt, s := status, b := body)) FILTER (status BETWEEN 200 AND 299)"
        last = (
            "max(struct_pack(a := attempt, e := coalesce(error, 'HTTP ' || status))) "
            "FILTER (NOT coalesce(status BETWEEN 200 AND 299, false) AND coalesce(error, 'HTTP ' || status) IS NOT NULL)"
        )
        return (
            "SELECT url, f IS NOT NULL AS ok, f.s AS http_status, CASE WHEN f IS NULL THEN coalesce(l.e, 'Unknown error') END AS error, "
            f"f.b AS body FROM (SELECT url, {first} AS f, {last} AS l FROM ({att}) WHERE attempt <= {retries} GROUP BY url)"
        )

    tried = (
        "SELECT ord, url, coalesce(o.ok, false) AS ok, o.http_status AS http_status, "
        "CASE WHEN NOT coalesce(o.ok, false) THEN coalesce(o.error, 'Unknown error') END AS error, "
        f"CASE WHEN o.ok THEN 'landed/' || {key} || '.html' END AS saved_path "
        f"FROM ({order_jobs_sql()}) LEFT JOIN ({attempts(2)}) o USING (url)"
    )

    def tags_of(source: str, key: str, rules=None) -> str:
        tagged = (q.tags("text") if rules is None else q.tags("text", rules)).items()
        return f"SELECT {key}, {', '.join(f'{e} AS {n}' for n, e in tagged)} FROM ({source})"

    amounts = q.ranked_amounts("text")
    strict = amounts.replace(f"(?i){q.MONEY}", strict_money).replace("(text,", "(aw,")
    flat_records = _records(sol, "k, file_stem", FLAT)
    out = {
        "x1_clean_text": f"SELECT doc_id, {q.clean('text')} AS clean FROM documents",
        "x2_remove_boilerplate": v
        + f", m AS (SELECT k, {q.markup_text('v')} AS x FROM vis) SELECT k, {q.without_boilerplate('x')} AS text FROM m",
        "x3_iso_date": t + f" SELECT k, {q.iso('text')} AS iso FROM t",
        "x4_date_as_written": t + f" SELECT k, {q.raw_date('text')} AS raw FROM t",
        "x5_normalize_url": f"SELECT ord, url FROM ({rows})",
        "x6_safe_filename": f"SELECT doc_id, {q.safe_filename('text')} AS name FROM documents",
        "x7_sha1": "SELECT doc_id, sha1(text) AS sha1 FROM documents",
        "x8_page_key": f"SELECT ord, {key} AS file_stem FROM ({live})",
        "x9_money_value": t
        + f", m AS (SELECT k, {q.money_tokens('text')} AS toks FROM t), "
        "u AS (SELECT k, unnest(toks) AS raw, unnest(range(len(toks))) AS pos FROM m) "
        f"SELECT k, pos, {q.money_value('raw')} AS value FROM u",
        "x10_money_tokens": t
        + f" SELECT k, coalesce(array_to_string({q.money_tokens('text')}, '|'), '') AS tokens FROM t",
        "x11_join_list": "SELECT doc_id, array_to_string(string_split(text, ' '), '; ') AS words FROM documents",
        "x12_or_empty": f"SELECT url, attempt, coalesce(error, '') AS error FROM ({att})",
        "x13_strip": f"SELECT ord, {', '.join(f'{q.strip(f'\"{c}\"')} AS {n}' for n, c in JOB_TEXTS.items())} FROM ({cat})",
        "s5_file_stem": f"SELECT k, file_stem || '.v1' AS stem FROM ({sol})",
        "s2_job_rows": rows,
        "s1_s4_k6_catalogue_round_trip": f"SELECT url, title, program_id, nsf_pd_num FROM ({rows})",
        "s3_html_folder": "SELECT 'page_' || page_id AS file_stem, sha1(html || chr(10)) AS sha1 FROM pages",
        "p1_drop_blank_urls": f"SELECT ord, url FROM ({live})",
        "p2_reject_html_payload": "SELECT id FROM (SELECT 'page ' || page_id AS id, chr(10) || ' ' || html AS payload FROM pages "
        "UNION ALL SELECT 'doc ' || doc_id, text FROM documents) "
        f"WHERE NOT regexp_matches({q.strip('payload')}, '^(<!DOCTYPE|<html)')",
        "p3_success_status": f"SELECT url, attempt, status, status >= 200 AND status < 300 AS ok FROM ({att})",
        "p4_quarantined_pages": f"SELECT url, attempt FROM ({att}) WHERE body IS NULL",
        "p5_positive_amounts": t
        + f", m AS (SELECT k, {amounts} AS r FROM t) SELECT k, len(r) AS n, "
        "coalesce(array_to_string([a.raw FOR a IN r], '|'), '') AS ascending FROM m",
        "p6_length_gate": f"SELECT doc_id, CASE WHEN length({q.clean('text')}) > 30 THEN {q.clean('text')} END AS kept FROM documents",
        "d1_keep_first": jobs,
        "d1_keep_first_stream": jobs,
        "d2_first_n": first_jobs,
        "p7_empty_batch": "SELECT 'all' AS batch, count(*) AS records, count(*) > 0 AS exported FROM pages "
        "UNION ALL SELECT 'none', 0, false",
        "d3_first_failures": f"SELECT ord, url, error FROM ({log}) WHERE NOT ok ORDER BY ord LIMIT 10",
        "d4_page_order": f"SELECT file_stem FROM ({sol}) ORDER BY file_stem || '.html'",
        "d5_stable_order_of_amounts": t
        + f", m AS (SELECT k, {amounts} AS r FROM t), u AS (SELECT k, unnest(r) AS a, unnest(range(len(r))) AS rank FROM m) "
        "SELECT k, rank, a.raw AS raw, cast(a.pos - 1 AS bigint) AS pos FROM u",
        "j1_resolve_jobs": log,
        "j1_resolve_pages": resolved,
        "j1_resolve_landed": resolved,
        "a1_outcome_summary": f"SELECT count(*) AS total, count(*) FILTER (ok) AS ok, count(*) FILTER (NOT ok) AS failed FROM ({log})",
        "a2_payload_records": "SELECT doc_id, cast(greatest(len(string_split_regex("
        + q.strip("text")
        + r", '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]')) - 1, 0) AS bigint) AS records FROM documents",
        "a2_record_count": "SELECT count(*) AS records FROM pages WHERE html IS NOT NULL",
        "a3_amount_bounds": t
        + f", m AS (SELECT k, {amounts} AS r FROM t) SELECT k, r[1].v AS smallest, r[-1].v AS largest FROM m",
        "a4_resolve_attempts": attempts(2),
        "a4_resolve_attempts_more_retries": attempts(5),
        "h1_element_text": f"SELECT page_id, {q.markup_text(q.title_markup(q.visible('html')))} AS title FROM pages",
        "h2_page_text": _texts(pages, "page_id") + " SELECT page_id, text FROM t",
        "h2_solicitation_text": t + " SELECT k, text FROM t",
        "h3_canonical_url": v + f" SELECT k, {q.canonical('v')} AS source_url FROM vis",
        "h4_heading": v + f" SELECT k, {q.heading('v')} AS heading FROM vis",
        "h5_labelled_item": v + f" SELECT k, {q.posted_item('v')} AS item FROM vis",
        "e1_slice_between": t
        + " SELECT k, "
        + q.section(
            "text", r"\bII\.\s*Program Description\b\s*:?",
            r"\bOverall Approach\b|\bIII\.\s*Award Information\b",
        )
        + " AS section FROM t",
        "e2_identifier": t + f" SELECT k, {q.foa_id('full_title', 'file_stem')} AS foa_id FROM t",
        "e3_title": t + f" SELECT k, {q.title('full_title', 'file_stem')} AS title FROM t",
        "e4_agency": t + f" SELECT k, {q.agency('text')} AS agency FROM t",
        "e5_posted_date": t + f" SELECT k, {q.open_date('item', 'text')} AS open_date FROM t",
        "e6_due_date": t
        + f", d AS (SELECT k, {q.due_raw('text')} AS dates_raw FROM t) SELECT k, dates_raw, {q.iso('dates_raw')} AS close_date FROM d",
        "e7_description": t + f" SELECT k, {q.description('text')} AS program_description FROM t",
        "e8_award_section": t + f" SELECT k, {q.award_section('text')} AS section FROM t",
        "e9_award": t
        + f", a AS (SELECT k, {q.award_section('text')} AS aw FROM t), m AS (SELECT k, {q.ranked_amounts('aw')} AS am FROM a) "
        f"SELECT k, {q.award_total('am')} AS total_award, {q.award_range('am')} AS award_range FROM m",
        "e9_award_strict_units": t
        + f", a AS (SELECT k, {q.award_section('text')} AS aw FROM t), m AS (SELECT k, {strict} AS am FROM a) "
        f"SELECT k, {q.award_total('am')} AS total_award, {q.award_range('am')} AS award_range FROM m",
        "e10_e11_eligibility": t
        + f", s AS (SELECT k, {q.eligibility_section('text')} AS el, text FROM t), "
        f"c AS (SELECT k, {q.in_section('el')} AS a, {q.global_label('text')} AS b FROM s) "
        "SELECT k, CASE WHEN a <> '' THEN a ELSE b END AS eligibility_text FROM c",
        "t1_topic_tags": tags_of("SELECT doc_id, text FROM documents", "doc_id"),
        "t1_topic_tags_own_rules": tags_of(
            "SELECT doc_id, text FROM documents", "doc_id", WORD_RULES
        ),
        "t1_rule_table": OPENINGS,
        "t1_page_topics": _texts(pages, "page_id") + " " + tags_of("SELECT page_id, text FROM t", "page_id"),
        "t2_tag_text": _fields(sol, "k, file_stem")
        + f" SELECT k, concat_ws(' ', {TAG_FIELDS}) AS tag_text FROM f",
        "r1_records": _records(
            sol, "k, file_stem", f"k, {PLAIN}", ", 'nsf_html_local' AS parser_source"
        ),
        "r1_page_records": _records(
            pages, "page_id, file_stem", f"page_id, {PLAIN}", ", 'nsf_html_local' AS parser_source"
        ),
        "r2_flat_records": _records(sol, "k, file_stem", f"k, {FLAT}"),
        "r1_calendar_dates": _fields(sol, "k, file_stem")
        + " SELECT k, strftime(try_cast(open_date AS date), '%Y-%m-%d') AS open_date_d, "
        "strftime(try_cast(close_date AS date), '%Y-%m-%d') AS close_date_d FROM f",
        "l1_k2_json_round_trip": flat_records,
        "l1_k3_csv_round_trip": flat_records,
        "k1_json_per_record": _fields(pages, "page_id, file_stem")
        + " SELECT file_stem, title, agency, open_date FROM f",
        "k4_fetch_log_round_trip": log,
        "k5_land_pages_round_trip": resolved,
        "l2_catalogue_records": _records(first_pages, "file_stem", f"file_stem, {FLAT}"),
        "l3_url_record": _records(
            f"SELECT {q.safe_filename('url')} || '__' || substr(sha1(url), 1, 10) AS file_stem, html "
            f"FROM ({sol}) WHERE url = 'https://example.org/opportunity/7'",
            "file_stem",
            FLAT,
        ),
        "l4_fetch_batch_from_attempts": tried,
        "l4_attempts_summary": f"SELECT count(*) AS total, count(*) FILTER (ok) AS ok, count(*) FILTER (NOT ok) AS failed FROM ({tried})",
        "l4_attempts_first_failures": f"SELECT ord, url, error FROM ({tried}) WHERE NOT ok ORDER BY ord LIMIT 10",
        "l4_fetch_batch_summary": f"SELECT count(*) AS total, count(*) FILTER (ok) AS ok, count(*) FILTER (NOT ok) AS failed FROM ({log})",
    }
    return out
