"""The registered query of line dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm.line_dedup import dedup_lines
from snapledger.llm.registry import query, table

#: translate() in DuckDB needs the letters spelt out, as lower() would also change other letters.
LINES_SQL = r"""
    lines AS (
        SELECT doc_id, i AS place, l[i] AS line,
               translate(trim(l[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
    frequent AS (
        SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
    marked AS (SELECT l.*, f.key IS NOT NULL AS gone FROM lines l LEFT JOIN frequent f ON l.key = f.key)
"""

LINE_DEDUP_SQL = f"""
    WITH {LINES_SQL}
    SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
"""


@query(LINE_DEDUP_SQL)
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of at least one character in at least ten documents lose all their occurrences."""
    kept = dedup_lines(table(spark, folder, "documents"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
