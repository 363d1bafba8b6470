"""The registered query of URL filters, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapledger.llm.registry import query, table
from snapledger.llm.url_filter import ALLOW, BLOCK, Rule, judge_urls

RULES = [Rule("net/", BLOCK), Rule("example.net/en/", ALLOW), Rule("example.com/de/", BLOCK), Rule("org/fr/", ALLOW)]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _spelling_sql(url: str) -> str:
    """One spelling of an http URL, null for anything else."""
    scheme = f"lower(regexp_extract({url}, '^([A-Za-z]+)://', 1))"
    rest = f"regexp_extract({url}, '^[^:]*://[^/?#]*([^#]*)', 1)"
    host = f"translate(regexp_extract({url}, '^[^:]*://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}')"
    port = f"CASE {scheme} WHEN 'http' THEN ':80$' ELSE ':443$' END"
    bare = f"regexp_replace(regexp_replace(regexp_replace({host}, {port}, ''), '^www\\.', ''), '\\.(:|$)', '\\1')"
    slash = f"CASE WHEN {rest} LIKE '/%' THEN {rest} ELSE '/' || {rest} END"
    return f"CASE WHEN {scheme} IN ('http', 'https') AND {bare} <> '' THEN {bare} || {slash} END"


URLS_SQL = rf"""
    WITH RECURSIVE
    elements AS (
        SELECT url, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*>')) AS element, 'link' AS kind FROM pages
        UNION ALL
        SELECT url, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*>')), 'meta' FROM pages),
    targets AS (
        SELECT url, trim(replace(CASE
            WHEN kind = 'link' THEN coalesce(
                nullif(regexp_extract(element, '(?is)\bhref\s*=\s*"([^"]*)"', 1), ''),
                nullif(regexp_extract(element, '(?is)\bhref\s*=\s*''([^'']*)''', 1), ''),
                regexp_extract(element, '(?is)\bhref\s*=\s*([^\s"''>]+)', 1))
            ELSE regexp_extract(element, '(?is)\bcontent\s*=\s*["''][^"'']*?url\s*=\s*["'']?([^"''>]+)', 1) END, '&amp;', '&')) AS target
        FROM elements
        WHERE kind = 'link' AND regexp_matches(element, '(?is)\brel\s*=\s*["'']?[^"''>]*\bcanonical\b')
           OR kind = 'meta' AND regexp_matches(element, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b')),
    full_targets AS (
        SELECT url AS a, CASE
            WHEN target = '' THEN NULL
            WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN target
            WHEN target LIKE '//%' THEN regexp_extract(url, '^[A-Za-z]+:') || target
            WHEN target LIKE '/%' THEN regexp_extract(url, '^[A-Za-z]+://[^/?#]*') || target
            WHEN target LIKE '?%' THEN regexp_extract(url, '^[^?#]*') || target
            WHEN target LIKE '#%' THEN url
            ELSE regexp_extract(url, '^[A-Za-z]+://[^/?#]*')
                 || coalesce(nullif(regexp_extract(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '^.*/'), ''), '/') || target END AS b
        FROM targets),
    edges AS (SELECT {_spelling_sql("a")} AS a, {_spelling_sql("b")} AS b FROM full_targets),
    both_ways AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
    reached AS (SELECT a AS node, a AS other FROM both_ways UNION SELECT r.node, b.b FROM reached r JOIN both_ways b ON r.other = b.a),
    classes AS (SELECT node, min(other) AS comp FROM reached GROUP BY node),
    urls AS (SELECT page_id, url, true AS is_page FROM pages UNION ALL SELECT NULL, b, false FROM full_targets WHERE b IS NOT NULL),
    parts AS (
        SELECT page_id, is_page, {_spelling_sql("url")} AS node,
               translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), '{_UPPER}', '{_LOWER}') AS host,
               coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
        FROM urls),
    ruled AS (
        SELECT p.*, coalesce(c.comp, p.node) AS alias_of, '.' || host AS dotted,
               CASE WHEN dotted LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
                    WHEN dotted LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
                    WHEN dotted LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
                    WHEN dotted LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule,
               CASE rule WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow' WHEN 'net/' THEN 'block'
                         WHEN 'example.com/de/' THEN 'block' END AS own
        FROM parts p LEFT JOIN classes c ON p.node = c.node),
    decided AS (
        SELECT alias_of, CASE WHEN bool_or(own = 'allow') THEN 'allow' WHEN bool_or(own = 'block') THEN 'block' END AS verdict
        FROM ruled WHERE alias_of IS NOT NULL GROUP BY alias_of)
    SELECT page_id, host, path, rule, coalesce(own, d.verdict, 'allow') AS verdict, r.alias_of
    FROM ruled r LEFT JOIN decided d ON r.alias_of = d.alias_of WHERE is_page
"""


@query(URLS_SQL)
def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """All pages judged by four rules, and by what redirects and canonical links make their aliases."""
    judged = judge_urls(table(spark, folder, "pages"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "alias_of")
