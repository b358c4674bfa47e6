"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tallyframe.llm.quality_rules import RULES, STOP_WORDS, SYMBOLS


def _rules_sql() -> str:
    parts = [f"1000 * {r.what} >= {r.low} * {r.of}" for r in RULES if r.low is not None]
    parts += [f"1000 * {r.what} <= {r.high} * {r.of}" for r in RULES if r.high is not None]
    return " AND ".join(parts)


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

OP4 = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
e AS (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS i FROM d),
g AS (SELECT doc_id, i, x, lead(x, 1) OVER p AS y, lead(x, 2) OVER p AS z FROM e WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x, y, z) AS n FROM g WHERE z IS NOT NULL),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM h WHERE n > 1) GROUP BY doc_id),
c AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[{SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({_STOP})))::BIGINT AS n_stop_words,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*•]')))::BIGINT AS n_bullet_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$')))::BIGINT AS n_ellipsis_lines
  FROM d LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND {_rules_sql()} AS kept
FROM c"""


OP2 = r"""
WITH d AS (
  SELECT source, coalesce(lang, 'und') AS lang, coalesce(text, '') AS t FROM documents
  WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)),
c AS (
  SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::BIGINT AS n FROM d
  UNION ALL
  SELECT source, lang, 'words-2', (len(regexp_extract_all(t, '[^\x00-/:-@\[-`{-\x7F]+')) + len(regexp_replace(t, '[^!-/:-@\[-`{-~]', '', 'g')))::BIGINT FROM d)
SELECT source, lang, tokenizer, count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_tokens FROM c GROUP BY ALL""".replace("\\\\", "\\")


OP8 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
e AS (SELECT r, unnest(w) AS z, unnest(range(len(w))) AS i FROM d),
g AS (SELECT r, i, z, lag(z, 1) OVER p AS y, lag(z, 2) OVER p AS x FROM e WINDOW p AS (PARTITION BY r ORDER BY i)),
c1 AS (SELECT z, count(*) AS n FROM g GROUP BY z),
c2 AS (SELECT y, z, count(*) AS n FROM g WHERE i > 0 GROUP BY y, z),
c3 AS (SELECT x, y, z, count(*) AS n FROM g WHERE i > 1 GROUP BY x, y, z),
s1 AS (SELECT g.r, g.i, ln(c1.n::DOUBLE / (SELECT count(*) FROM g)) AS s FROM g JOIN c1 USING (z)),
s2 AS (SELECT g.r, g.i, CASE WHEN c2.n > 0 THEN ln(c2.n::DOUBLE / c1.n) ELSE ln(0.4) + s1.s END AS s
       FROM g JOIN s1 USING (r, i) LEFT JOIN c2 ON c2.y = g.y AND c2.z = g.z LEFT JOIN c1 ON c1.z = g.y WHERE g.i > 0),
s3 AS (SELECT g.r, g.i, CASE WHEN c3.n > 0 THEN ln(c3.n::DOUBLE / c2.n) ELSE ln(0.4) + s2.s END AS s
       FROM g JOIN s2 USING (r, i) LEFT JOIN c3 ON c3.x = g.x AND c3.y = g.y AND c3.z = g.z LEFT JOIN c2 ON c2.y = g.x AND c2.z = g.y WHERE g.i > 1),
t AS (SELECT r, sum(s) AS s FROM (SELECT r, s FROM s1 WHERE i = 0 UNION ALL SELECT r, s FROM s2 WHERE i = 1 UNION ALL SELECT r, s FROM s3) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, round(coalesce(s, 0), 4) AS log_score, round(s / len(w), 6) AS mean_log_score
FROM d LEFT JOIN t USING (r)"""


def oracle_sql() -> dict[str, str]:
    return {"op2_token_counts": OP2, "op4_quality_rules": OP4, "op8_lm_scoring": OP8}
