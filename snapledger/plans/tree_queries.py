"""Tree fits small enough to be written as SQL: the split search as sums per value, for a forest of one tree and for boosting.

The inputs have few values, so that every value is a bin of its own and a fit has no randomness. The labels are whole
numbers, whose sums are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.operators import modeling
from snapledger.plans.registry import query, table

KEY, LABEL = "o_custkey", "spent"
#: Counts of orders, and the count from which on they are all the same.
INPUTS = {"early": 12, "urgent": 6, "big": 6}

_TABLE_SQL = """
    t AS (
        SELECT o_custkey, CAST(sum(floor(o_totalprice / 1000)) AS DOUBLE) AS y, 1 AS node,
               least(count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01'), 12) AS early,
               least(count(*) FILTER (WHERE o_orderpriority = '1-URGENT'), 6) AS urgent,
               least(count(*) FILTER (WHERE o_totalprice > 250000), 6) AS big
        FROM orders GROUP BY 1)
"""


def _split_sql(source: str, level: int) -> str:
    """Rows of ``source`` with their nodes split once more: the split with the least squared error of each node.

    The squared error of two means is least where ``sum^2 / n`` of both sides is greatest.
    """
    return f"""
    sums{level} AS (
        SELECT node, f, v, count(*)::DOUBLE AS n, sum(y) AS s
        FROM {source} UNPIVOT (v FOR f IN (early, urgent, big)) GROUP BY 1, 2, 3),
    sides{level} AS (
        SELECT node, f, v, sum(n) OVER w AS n1, sum(s) OVER w AS s1, sum(n) OVER (PARTITION BY node, f) AS n,
               sum(s) OVER (PARTITION BY node, f) AS s
        FROM sums{level} WINDOW w AS (PARTITION BY node, f ORDER BY v)),
    best{level} AS (
        SELECT node, f, v FROM sides{level} WHERE n1 < n
        QUALIFY row_number() OVER (
            PARTITION BY node ORDER BY s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) DESC, array_position(['early', 'urgent', 'big'], f), v) = 1),
    split{level} AS (
        SELECT r.* REPLACE (2 * r.node + CASE WHEN CASE b.f WHEN 'early' THEN early WHEN 'urgent' THEN urgent ELSE big END <= b.v
                                              THEN 0 ELSE 1 END AS node)
        FROM {source} r LEFT JOIN best{level} b ON r.node = b.node)"""


def _states(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer: the inputs and the label."""
    price = F.col("o_totalprice")
    counts = {
        "early": F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"),
        "urgent": F.col("o_orderpriority") == "1-URGENT",
        "big": price > 250_000,
    }
    inputs = [F.least(F.count(F.when(c, 1)), F.lit(INPUTS[n])).cast("double").alias(n) for n, c in counts.items()]
    return table(spark, folder, "orders").groupBy(KEY).agg(F.sum(F.floor(price / 1000)).cast("double").alias(LABEL), *inputs)


def _fitted(spark: SparkSession, folder: str, candidate: modeling.Candidate) -> DataFrame:
    prepared, _ = modeling.prepare(_states(spark, folder), [KEY, LABEL], list(INPUTS))
    model = modeling.fit(prepared, LABEL, candidate, seed=1)
    # Millionths: means of doubles may differ in their last digits by the order of their rows.
    guess = F.round(F.col(modeling.predicted(LABEL)) * 1_000_000).cast("long")
    return model.transform(prepared).select(KEY, LABEL, guess.alias("predicted_millionths"))


@query(
    f"""
    WITH {_TABLE_SQL}, {_split_sql("t", 1)}, {_split_sql("split1", 2)}
    SELECT o_custkey, y AS spent, CAST(round(avg(y) OVER (PARTITION BY node) * 1000000) AS BIGINT) AS predicted_millionths FROM split2
    """
)
def train_exact_tree(spark: SparkSession, folder: str) -> DataFrame:
    """A tree of depth two on all rows, without drawing rows or inputs."""
    params = {"maxDepth": 2, "numTrees": 1, "maxBins": 32, "bootstrap": False, "featureSubsetStrategy": "all"}
    return _fitted(spark, folder, modeling.Candidate("forest", params))


@query(
    f"""
    WITH {_TABLE_SQL}, {_split_sql("t", 1)},
    first AS (SELECT * REPLACE (2 * (y - avg(y) OVER (PARTITION BY node)) AS y, 1 AS node), y AS label,
                     avg(y) OVER (PARTITION BY node) AS guess FROM split1),
    {_split_sql("first", 2)}
    SELECT o_custkey, label AS spent,
           CAST(round((guess + 0.1 * avg(y) OVER (PARTITION BY node)) * 1000000) AS BIGINT) AS predicted_millionths
    FROM split2
    """
)
def train_exact_boosting(spark: SparkSession, folder: str) -> DataFrame:
    """Two stumps: the second learns the gradient of the squared error that the first one leaves, and counts a tenth."""
    return _fitted(spark, folder, modeling.Candidate("boosted", {"maxDepth": 1, "maxIter": 2, "stepSize": 0.1, "maxBins": 32}))
