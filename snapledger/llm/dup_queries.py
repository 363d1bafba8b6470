"""The registered queries of near-duplicate detection and substring dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapledger.llm.chunk_dedup import repeated_spans
from snapledger.llm.near_dup import near_duplicates
from snapledger.llm.registry import query, table

NEAR_SQL = r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    hashed AS (SELECT doc_id, hash(g) AS h FROM shingles),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM hashed a JOIN hashed b ON a.h = b.h AND a.doc_id <> b.doc_id
        GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
        WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
    reached AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
    FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id
    JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) c ON d.doc_id = c.a
"""


@query(NEAR_SQL)
def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of five-word shingles have a similarity of 0.85 or more."""
    found = near_duplicates(table(spark, folder, "documents"), shingle=5, percent=85, trees=8)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The documents with passages of some 50 words that other documents hold, too, and where they are."""
    found = repeated_spans(table(spark, folder, "documents"), average=20, min_chars=170)
    return found.select("doc_id", "n_repeated", "n_removed", "repeated", "removed")
