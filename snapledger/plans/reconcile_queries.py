"""Snapshot, join, audit and grouping queries.

The orders play the dated history (key ``o_custkey``, version ``o_orderkey``), the customers the
dimension. The window leaves some customers without a version in it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.operators import bloom, reconcile, shaping, skew, snapshot
from snapledger.operators.incremental import LatestTable
from snapledger.plans.registry import ORACLES, query, table
from snapledger.session import materialize, new_folder

FIRST, LAST = dt.date(1997, 1, 1), dt.date(1997, 6, 30)
KEY = "o_custkey"

_WINDOW = "CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-06-30'"
_LATEST = "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1"
_SNAPSHOT = f"SELECT * FROM orders WHERE {_WINDOW} {_LATEST}"
_NEWEST = f"SELECT * FROM orders {_LATEST}"


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders")


def _snapshot(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return snapshot.latest_in_window(
        _orders(spark, folder), KEY, ["o_orderkey"], "o_orderdate", FIRST, LAST, columns or None
    )


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").withColumnRenamed("c_custkey", KEY)


def _solvent(spark: SparkSession, folder: str) -> DataFrame:
    """A dimension that lacks some customers."""
    return _customers(spark, folder).filter(F.col("c_acctbal") > 0)


@query(_SNAPSHOT)
def snapshot_latest_in_window(spark: SparkSession, folder: str) -> DataFrame:
    return _snapshot(spark, folder)


@query(f"SELECT * FROM orders {_LATEST}")
def snapshot_latest_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The latest order of each customer from a stored table that years of orders are merged into, the later ones first."""
    orders, year = _orders(spark, folder), F.year("o_orderdate")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = LatestTable.create(orders.filter(year < 1997), new_folder(spark, "latest"), KEY, ["o_orderkey"], buckets)
    stored = stored.merge(orders.filter(year >= 1999))
    return stored.merged(orders.filter(year.between(1996, 1998)))


@query(
    f"""
    WITH s AS ({_SNAPSHOT}), n AS ({_NEWEST}), d AS (SELECT * FROM customer WHERE c_acctbal > 0),
    u AS (SELECT *, 'window' AS origin FROM s
          UNION ALL
          SELECT *, 'fallback' FROM n WHERE o_custkey NOT IN (SELECT o_custkey FROM s))
    SELECT u.o_custkey, u.o_orderkey, u.o_orderstatus, u.o_totalprice, u.o_orderdate, u.o_orderpriority,
           u.origin, d.c_name, d.c_mktsegment, d.c_acctbal
    FROM u LEFT JOIN d ON u.o_custkey = d.c_custkey
    """
)
def snapshot_with_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Latest order of each customer in the window, or of all time where the window has none."""
    picked = snapshot.latest_with_fallback(
        _orders(spark, folder), KEY, ["o_orderkey"], "o_orderdate", FIRST, LAST
    )
    customers = _solvent(spark, folder).select(KEY, "c_name", "c_mktsegment", "c_acctbal")
    return reconcile.with_optional(picked, customers, KEY)


@query(
    """
    SELECT c.c_custkey AS o_custkey, o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    """
)
def join_inner_using(spark: SparkSession, folder: str) -> DataFrame:
    """Both inputs are plain scans, so adaptive execution can split a hot customer."""
    orders = _orders(spark, folder).select(KEY, "o_orderkey", "o_totalprice")
    customers = _customers(spark, folder).select(KEY, "c_name", "c_mktsegment")
    return reconcile.matched(orders, customers, KEY)


@query(
    f"""
    WITH s AS ({_SNAPSHOT})
    SELECT c.c_custkey AS o_custkey, c.c_name, s.o_orderkey, s.o_totalprice
    FROM customer c LEFT JOIN s ON s.o_custkey = c.c_custkey
    """
)
def join_left_using(spark: SparkSession, folder: str) -> DataFrame:
    found = _snapshot(spark, folder, "o_orderkey", "o_totalprice").select(KEY, "o_orderkey", "o_totalprice")
    return reconcile.with_optional(_customers(spark, folder).select(KEY, "c_name"), found, KEY)


@query(
    f"""
    SELECT c_custkey AS o_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE {_WINDOW})
    """
)
def join_left_anti(spark: SparkSession, folder: str) -> DataFrame:
    window = shaping.in_window(_orders(spark, folder), "o_orderdate", FIRST, LAST)
    return reconcile.missing_in(_customers(spark, folder), window, KEY)


@query(
    f"""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE {_WINDOW})
    """
)
def join_left_semi(spark: SparkSession, folder: str) -> DataFrame:
    """The key list may repeat keys: they are made distinct before the shuffle."""
    window = shaping.in_window(_orders(spark, folder), "o_orderdate", FIRST, LAST)
    return reconcile.present_in(table(spark, folder, "customer"), window, "c_custkey", KEY)


_FEW = "SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000"


def _few_orders(spark: SparkSession, folder: str) -> DataFrame:
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400_000)
    return _orders(spark, folder).filter(urgent)


@query(f"SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN ({_FEW})")
def join_semi_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of few orders: a filter of their keys goes ahead of the join."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return bloom.present_filtered(lines, _few_orders(spark, folder), "l_orderkey", "o_orderkey")


@query(f"SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN ({_FEW})")
def join_anti_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """All other lines: only those that the filter cannot tell meet the keys."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return bloom.missing_filtered(lines, _few_orders(spark, folder), "l_orderkey", "o_orderkey")


@query(
    """
    SELECT l_orderkey % 97 AS bucket, count(*) AS rows FROM lineitem GROUP BY 1
    HAVING count(*) >= (SELECT 0.005 * count(*) FROM lineitem)
    """
)
def agg_frequent_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys with half a percent of the rows, from a sketch that has room for all of the keys, and so counts exactly."""
    lines = table(spark, folder, "lineitem").select((F.col("l_orderkey") % 97).alias("bucket"))
    return skew.frequent_keys(lines, "bucket", 0.005)


@query(
    f"""
    WITH s AS ({_SNAPSHOT}), n AS ({_NEWEST})
    SELECT * FROM n WHERE o_custkey NOT IN (SELECT o_custkey FROM s)
    """
)
def reconcile_fallback_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Both sides come from one table, so one pass picks the versions and tells the fallback rows."""
    picked = snapshot.latest_with_fallback(_orders(spark, folder), KEY, ["o_orderkey"], "o_orderdate", FIRST, LAST)
    return picked.filter(F.col("origin") == "fallback").drop("origin")


@query(
    f"""
    WITH s AS ({_SNAPSHOT}), n AS ({_NEWEST}),
    m AS (SELECT s.o_custkey, s.o_orderkey, s.o_totalprice, d.c_name, 'window' AS origin
          FROM s LEFT JOIN customer d ON s.o_custkey = d.c_custkey AND d.c_acctbal > 0),
    f AS (SELECT n.o_custkey, n.o_orderkey, n.o_totalprice, c.c_name, 'fallback' AS origin
          FROM n JOIN customer c ON n.o_custkey = c.c_custkey WHERE n.o_custkey NOT IN (SELECT o_custkey FROM s))
    SELECT * FROM m UNION ALL SELECT * FROM f
    """
)
def reconcile_two_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshot with its dimension, and rows of a newer table where the snapshot has none.

    The orders are read once: both tables are cut from one row per customer, which is stored.
    """
    inside = F.to_date("o_orderdate").between(F.lit(FIRST), F.lit(LAST))
    columns = ["o_orderkey", "o_totalprice"]
    periods = {"window": inside, "newest": F.lit(True)}
    latest = snapshot.latest_per_period(_orders(spark, folder), KEY, columns[:1], columns, **periods)
    latest = materialize(latest, "latest")
    found = latest.filter(F.col("window").isNotNull()).select(KEY, "window.*")
    names = _customers(spark, folder).select(KEY, "c_name")
    newer = latest.select(KEY, "newest.*").join(names, KEY)
    dimension = _solvent(spark, folder).select(KEY, "c_name")
    return reconcile.reconcile(newer, found, dimension, KEY, origin="origin")


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
    """
)
def reconcile_missing_dimension(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder).select("o_orderkey", KEY)
    return reconcile.missing_dimension(orders, _solvent(spark, folder), KEY)


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "SELECT p1.o_custkey, "
    + ", ".join(f"p{i}.p{i}_orders, p{i}.p{i}_max" for i in range(1, 6))
    + " FROM "
    + " JOIN ".join(
        f"(SELECT o_custkey, count(*) AS p{i}_orders, max(o_totalprice) AS p{i}_max FROM orders"
        f" WHERE o_orderpriority = '{p}' GROUP BY 1) p{i}"
        + ("" if i == 1 else f" ON p1.o_custkey = p{i}.o_custkey")
        for i, p in enumerate(_PRIORITIES, 1)
    )
)
def join_fold_on_key(spark: SparkSession, folder: str) -> DataFrame:
    """One table per priority, brought together by customer.

    The orders are read once: what the five tables are cut from is stored, with at most one row
    per customer and priority.
    """
    counted = (
        _orders(spark, folder)
        .groupBy(KEY, "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("max"))
    )
    stored = materialize(counted, "priorities")
    tables = [
        stored.filter(F.col("o_orderpriority") == p).select(
            KEY, F.col("orders").alias(f"p{i}_orders"), F.col("max").alias(f"p{i}_max")
        )
        for i, p in enumerate(_PRIORITIES, 1)
    ]
    return reconcile.fold_join(tables, KEY)


@query(
    """
    WITH a AS (SELECT c_custkey AS k, count(*) AS l FROM customer GROUP BY 1),
    b AS (SELECT o_custkey AS k, count(*) AS r FROM orders
          WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-06-30' GROUP BY 1)
    SELECT CAST((SELECT sum(l) FROM a) AS BIGINT) AS rows_before,
           CAST((SELECT sum(l * r) FROM a JOIN b USING (k)) AS BIGINT) AS rows_after,
           CAST((SELECT sum(l) FROM a WHERE k NOT IN (SELECT k FROM b)) AS BIGINT) AS unmatched_left_rows,
           CAST((SELECT count(*) FROM b WHERE r > 1) AS BIGINT) AS duplicated_right_keys
    """
)
def check_join_cardinality(spark: SparkSession, folder: str) -> DataFrame:
    window = shaping.in_window(_orders(spark, folder), "o_orderdate", FIRST, LAST)
    return reconcile.join_cardinality(_customers(spark, folder), window, KEY)


@query(
    """
    WITH q AS (SELECT l_orderkey AS o_orderkey, max(l_quantity) AS quantity FROM lineitem GROUP BY 1)
    SELECT o_orderkey, o_totalprice, quantity / 120 AS scaled FROM orders JOIN q USING (o_orderkey)
    """
)
def join_keyed_pairing(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables in different physical orders, paired by key instead of by position."""
    quantity = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg((F.max("l_quantity") / 120).alias("scaled"))
    )
    orders = _orders(spark, folder).select("o_orderkey", "o_totalprice")
    return reconcile.matched(orders, quantity, "o_orderkey")


@query(
    f"""
    WITH s AS ({_SNAPSHOT}), d AS (SELECT c_custkey FROM customer WHERE c_acctbal > 0),
    j AS (SELECT c.c_custkey, s.o_orderkey, d.c_custkey AS dim
          FROM customer c LEFT JOIN s ON s.o_custkey = c.c_custkey
          LEFT JOIN d ON d.c_custkey = s.o_custkey)
    SELECT 'requested' AS step, (SELECT count(*) FROM customer) AS rows
    UNION ALL SELECT 'imported', count(*) FROM j
    UNION ALL SELECT 'only_newer', count(*) FROM j WHERE o_orderkey IS NULL
    UNION ALL SELECT 'in_both', count(*) FROM j WHERE o_orderkey IS NOT NULL
    UNION ALL SELECT 'with_dimension', count(*) FROM j WHERE o_orderkey IS NOT NULL
    UNION ALL SELECT 'missing_dimension', count(*) FROM j WHERE o_orderkey IS NOT NULL AND dim IS NULL
    """
)
def audit_coverage_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.coverage_audit(
        _customers(spark, folder), _snapshot(spark, folder), _solvent(spark, folder), KEY
    )


@query(ORACLES["audit_coverage_counts"])
def audit_observed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The same counts, taken from the reconciled rows while they are written."""
    names, solvent = (customers.select(KEY, "c_name") for customers in (_customers(spark, folder), _solvent(spark, folder)))
    found = _snapshot(spark, folder, "o_orderkey").select(KEY)
    rows, seen = reconcile.reconcile_counted(names, found, solvent, KEY)
    rows.write.parquet(f"{new_folder(spark, 'reconciled')}/rows")
    return reconcile.audit_of_counts(spark, seen.get)


@query("SELECT o_custkey, max(o_orderkey) AS latest FROM orders GROUP BY 1")
def agg_group_max(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder).groupBy(KEY).agg(F.max("o_orderkey").alias("latest"))


@query("SELECT count(*) AS rows FROM lineitem")
def agg_count(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").agg(F.count(F.lit(1)).alias("rows"))


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """
)
def agg_duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])
