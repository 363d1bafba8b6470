"""The registered query of the quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm.quality import BASE, CURRENT, passes, quality_ledger
from snapledger.llm.registry import query, table

#: Measurements of every document, as MEASURES in quality.py.
MEASURED_SQL = r"""
    texts AS (
        SELECT doc_id, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM documents),
    windows AS (
        SELECT doc_id, i, list_slice(w, i, i + 4) AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM texts WHERE len(w) >= 5)),
    starts AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1),
    covered AS (
        SELECT doc_id, count(DISTINCT i + k) AS n FROM starts, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id),
    measured AS (
        SELECT texts.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
               length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
               (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
               length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals, len(list_distinct(w))::BIGINT AS n_distinct,
               len(lines)::BIGINT AS n_lines
        FROM texts LEFT JOIN covered ON texts.doc_id = covered.doc_id),
    judged AS (
        SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
               10 * n_symbols > n_words OR 2 * n_capitals > word_chars OR 2 * n_dup_lines > n_lines
               OR 50 * n_distinct < n_words AS more_failed
        FROM measured)
"""

QUALITY_SQL = f"""
    WITH {MEASURED_SQL}
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT more_failed AS kept
    FROM judged
"""


@query(QUALITY_SQL)
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger of all documents under the current policy."""
    ledger = quality_ledger(table(spark, folder, "documents"))
    return ledger.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes(BASE)).alias("base_failed"),
        passes(CURRENT).alias("kept"),
    )
