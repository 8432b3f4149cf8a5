"""SQL for DuckDB of the queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

HOST_RULES = f"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
placed AS (SELECT r, len(words) AS n, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
windows AS (
  SELECT r, n, i, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS g
  FROM placed),
counted AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM windows WHERE i <= n - 7),
repeated AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM counted WHERE c > 1) GROUP BY r),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '{_WORD}') GROUP BY r),
m AS (
  SELECT doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(lines.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words
  FROM w LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
rules AS (
  SELECT source, unnest(['base', 'lines', 'symbols']) AS rule,
         unnest([base_failed, 100 * n_dup_lines > 3 * n_words, 100 * n_symbols > 10 * n_words]) AS failed FROM f),
hosts AS (
  SELECT source, rule, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS failed FROM rules
  WHERE source IS NOT NULL GROUP BY source, rule),
s AS (
  SELECT rule, (sum(failed) + 0.5) / (sum(n) + 1) AS mean, sum(n) AS n, avg(1 / n) AS inv,
         greatest(avg((failed / n) ** 2) - avg(failed / n) ** 2, 0) AS spread FROM hosts WHERE n >= 2 GROUP BY rule),
b AS (SELECT *, (spread - mean * (1 - mean) * inv) / greatest(1 - inv, 1e-9) AS between_hosts FROM s),
k AS (
  SELECT rule, mean, CASE WHEN between_hosts > 0 THEN least(greatest(mean * (1 - mean) / between_hosts - 1, 1), n)
                          ELSE greatest(n, 1) END AS strength FROM b),
v AS (
  SELECT source, max((failed + coalesce(mean * strength, 1)) / (hosts.n + coalesce(strength, 2))) <= 0.5 AS host_kept
  FROM hosts LEFT JOIN k USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(host_kept, true) AS kept
FROM f LEFT JOIN v USING (source)
"""

LINE_DEDUP = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key
  FROM l),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT r, k.doc_id, line, pos, shared.key IS NOT NULL AND k.doc_id <> keeper AS dropped
  FROM k LEFT JOIN shared ON k.key = shared.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

_CONTROLS = r"\\|<<SYS>>|<</SYS>>|<s>|</s>|\[INST\]|\[/INST\]|\[ROLE\]|\[/ROLE\]|\[TEXT\]"

CHAT = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (
  SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
         length(text) + len(regexp_extract_all(text, '{_CONTROLS}')) AS chars FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 18 WHEN 'assistant' THEN 5
           ELSE 19 + length(role) + len(regexp_extract_all(role, '{_CONTROLS}')) END)::BIGINT AS formatted_chars,
       count(*) FILTER (NOT (role = 'user' AND before IN ('', 'system', 'assistant')
           OR role = 'assistant' AND before = 'user' OR role = 'system' AND before = '')) AS n_invalid
FROM o GROUP BY conv_id
"""

NEAR_DUP = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS words FROM documents),
placed AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
s AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, n, i, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS shingle
    FROM placed) WHERE i <= greatest(n - 4, 1)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(min(reach.b), w.doc_id)) AS component_id,
       w.doc_id <= coalesce(min(reach.b), w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.a = w.doc_id GROUP BY w.doc_id, n.n
"""



def _merkle(levels: int = 7, upper: int = 4) -> str:
    """The tree level by level: `levels` over the rows of a source, `upper` over the sources."""
    field = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')".format
    names = ("doc_id", "source", "lang", "n_chars")
    leaf = " || ".join(map(field, (*names, "text")))
    altered = " || ".join(map(field, (*names, f"translate(text, '{_UPPER}', '{_LOWER}')")))
    bits = "list_transform(range(8 * length(id)), lambda i: (ascii(id[i // 8 + 1]) >> (i % 8)::INT) & 1)"
    crc = (
        f"xor(list_reduce(list_prepend(4294967295, {bits}), "
        "lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"
    )
    run = "OVER (PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN {} AND {})".format
    ctes = [
        f"d AS MATERIALIZED (SELECT *, sha256({leaf}) AS leaf, sha256({altered}) AS altered, {crc} AS crc "
        "FROM (SELECT *, doc_id::VARCHAR AS id FROM documents))",
        "l0 AS MATERIALIZED (SELECT dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, "
        "row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, "
        "count(*) OVER (PARTITION BY source) AS n, leaf AS h, doc_id, CASE WHEN crc % 5 = 0 THEN altered END AS altered FROM d)",
        "w0 AS MATERIALIZED (SELECT doc_id, tree, pos, h AS leaf, coalesce(altered, h) AS f, '' AS proof FROM l0)",
    ]
    for k in range(levels + upper):
        if k == levels:  # the subroots are the leaves of the tree over the sources
            ctes += [
                f"r{k} AS MATERIALIZED (SELECT tree, h FROM l{k})",
                f"l{k}u AS MATERIALIZED (SELECT 0 AS tree, tree AS pos, count(*) OVER () AS n, h FROM r{k})",
                f"w{k}u AS MATERIALIZED (SELECT doc_id, 0 AS tree, w.tree AS pos, leaf, f, proof, r.h AS subroot "
                f"FROM w{k} w JOIN r{k} r USING (tree))",
            ]
        own, way = ("l", "w") if k < levels else ("m", "v")
        if k == levels:
            ctes += [f"m{k} AS (SELECT * FROM l{k}u)", f"v{k} AS (SELECT * FROM w{k}u)"]
        kept = "doc_id, leaf" if k < levels else "doc_id, leaf, subroot"
        ctes += [
            f"s{k} AS MATERIALIZED (SELECT tree, pos, n, "
            f"coalesce(string_agg(h, '') {run('UNBOUNDED PRECEDING', '1 PRECEDING')}, '') AS b, "
            f"coalesce(string_agg(h, '') {run('1 FOLLOWING', 'UNBOUNDED FOLLOWING')}, '') AS a FROM {own}{k})",
            f"{own}{k + 1} AS MATERIALIZED (SELECT tree, pos // 16 AS pos, (max(n) + 15) // 16 AS n, "
            f"CASE WHEN max(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h "
            f"FROM {own}{k} GROUP BY tree, pos // 16)",
            f"{way}{k + 1} AS MATERIALIZED (SELECT {kept}, w.tree, w.pos // 16 AS pos, "
            f"CASE WHEN n = 1 THEN f ELSE sha256(b || f || a) END AS f, "
            f"proof || CASE WHEN n = 1 THEN '' ELSE b || a END AS proof FROM {way}{k} w JOIN s{k} USING (tree, pos))",
        ]
    last = levels + upper
    return (
        f"WITH {', '.join(ctes)} SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, "
        f"f AS folded_root, f = h AS verified FROM v{last} JOIN m{last} USING (tree)"
    )


ORACLES = {
    "op4_host_rules": HOST_RULES, "op5_line_dedup": LINE_DEDUP, "op7_chat": CHAT, "op8_near_dup": NEAR_DUP,
    "op11_merkle": _merkle(),
}
