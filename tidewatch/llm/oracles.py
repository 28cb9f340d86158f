"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from tidewatch.llm.quality import BOILERPLATE

_SPACE = r"[\x20\x09-\x0D]"
_FITS = rf"""
    length(l) - length(translate(l, '#*$%&|<>', '')) <= 0.1 * n
    AND (n > 4 OR regexp_matches(l, '[.!?:;…”’»"'')]{_SPACE}*$'))
    AND length(regexp_replace(l, '[^\p{{Lu}}]', '', 'g')) <= greatest(0.5 * length(regexp_replace(l, '[^\p{{L}}]', '', 'g')), 1)
    AND (n > 20 OR NOT regexp_matches(lower(l), '{BOILERPLATE}'))"""

ORACLES = {
    "op6_url_rules": r"""
    WITH p AS (
        SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages),
    m AS (
        SELECT *, CASE
            WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
        FROM p)
    SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM m""",
    "op4_line_rules": rf"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    w AS MATERIALIZED (
        SELECT r, doc_id, text, list_filter(regexp_split_to_array(text, '{_SPACE}+'), lambda x: x <> '') AS w FROM d),
    lines AS MATERIALIZED (
        SELECT r, l, len(list_filter(regexp_split_to_array(l, '{_SPACE}+'), lambda x: x <> '')) AS n
        FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
    seen AS (
        SELECT r, count(*) - count(DISTINCT l) AS dup, sum(length(l)) + count(*) - 1 AS size FROM lines GROUP BY r),
    stay AS (
        SELECT r, sum(length(l)) + count(*) - 1 AS size FROM (SELECT DISTINCT r, l FROM lines WHERE {_FITS}) GROUP BY r),
    g AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
    rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, i + unnest(range(5)) AS p FROM twice) GROUP BY r),
    m AS (
        SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(translate(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
               CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols
        FROM w),
    b AS (
        SELECT m.*, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
               coalesce(stay.size, 0) >= 0.5 * coalesce(seen.size, 0) AS whole
        FROM m LEFT JOIN seen USING (r) LEFT JOIN stay USING (r) LEFT JOIN rep USING (r)),
    f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND whole AS kept FROM f""",
}
