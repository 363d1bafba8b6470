"""Projection, schema, filter, ordering and union queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.functions import clean
from snapledger.operators import ordering, reconcile, shaping
from snapledger.plans.registry import query, table


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_returnflag FROM lineitem")
def proj_useful_columns(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def proj_drop_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Unknown names in the drop list do no harm."""
    return table(spark, folder, "orders").drop("o_orderstatus", "o_orderpriority", "o_comment")


@query(
    """
    SELECT p_partkey AS part_id, p_name AS "Name", p_brand AS "Brand", p_type, p_size AS "Size",
           p_retailprice AS "Price"
    FROM part
    """
)
def schema_rename_map(spark: SparkSession, folder: str) -> DataFrame:
    names = {
        "p_partkey": "part_id",
        "p_name": "Name",
        "p_brand": "Brand",
        "p_size": "Size",
        "p_retailprice": "Price",
        "p_container": "Container",
    }
    return shaping.rename_by_table(table(spark, folder, "part"), names)


@query(
    """
    SELECT s_suppkey, s_name AS old_s_name, s_nationkey AS old_s_nationkey, s_acctbal AS old_s_acctbal
    FROM supplier
    """
)
def schema_prefix_except_key(spark: SparkSession, folder: str) -> DataFrame:
    return shaping.prefix_except(table(spark, folder, "supplier"), "old_", ["s_suppkey"])


@query(
    """
    SELECT l_orderkey, l_linenumber, l_quantity * 1500 AS price, l_quantity * 2 AS size,
           l_tax AS tax_pred
    FROM lineitem
    """
)
def schema_strip_suffix(spark: SparkSession, folder: str) -> DataFrame:
    predicted = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_quantity") * 1500).alias("price_pred"),
        (F.col("l_quantity") * 2).alias("size_pred"),
        F.col("l_tax").alias("tax_pred"),
    )
    return shaping.strip_suffix(predicted, "_pred", ["price_pred", "size_pred"])


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
    UNION ALL
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'
    """
)
def union_aligned(spark: SparkSession, folder: str) -> DataFrame:
    """Two overlapping parts with different column orders: all rows of both stay."""
    orders = table(spark, folder, "orders")
    older = shaping.in_window(orders, "o_orderdate", last=dt.date(1997, 12, 31))
    newer = shaping.in_window(orders, "o_orderdate", first=dt.date(1996, 1, 1))
    return shaping.union_aligned(
        older.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"),
        newer.select("o_orderpriority", "o_orderstatus", "o_orderkey", "o_totalprice", "o_custkey"),
    )


@query(
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'Patch' AS source FROM
      (SELECT CAST(-1 AS BIGINT) AS c_custkey, 'Customer#patch' AS c_name, CAST(3 AS INTEGER) AS c_nationkey,
              CAST(181.5 AS DOUBLE) AS c_acctbal, NULL AS c_mktsegment)
    UNION ALL
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'Table' FROM customer
    """
)
def union_patch_rows(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").withColumn("source", F.lit("Table"))
    patch = {
        "c_name": "Customer#patch",
        "c_custkey": -1,
        "c_acctbal": 181.5,
        "c_nationkey": 3,
        "source": "Patch",
    }
    return reconcile.append_rows(customer, [patch])


@query(
    """
    WITH text AS (
      SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS a, CAST(p_size AS VARCHAR) AS b,
             CAST(p_retailprice AS VARCHAR) AS c, p_brand FROM part)
    SELECT CAST(a AS INTEGER) AS p_partkey, CAST(b AS INTEGER) AS p_size,
           CASE WHEN regexp_full_match(c, '[+-]?[0-9]+') THEN TRY_CAST(c AS INTEGER) END AS p_retailprice,
           p_brand,
           CAST(round_even(CAST(c AS DOUBLE), 0) AS INTEGER) AS p_rounded
    FROM text
    """
)
def cast_all_except(spark: SparkSession, folder: str) -> DataFrame:
    """All text columns but the brand become ints; a fraction is no int text unless rounded."""
    part = table(spark, folder, "part")
    text = part.select(
        *[F.col(c).cast("string").alias(c) for c in ("p_partkey", "p_size", "p_retailprice", "p_brand")]
    ).withColumn("p_rounded", F.col("p_retailprice"))
    ints = shaping.cast_all(text, exclude=["p_brand", "p_rounded"])
    others = ["p_partkey", "p_size", "p_retailprice", "p_brand"]
    return shaping.cast_all(ints, exclude=others, cast=clean.round_half_even)


@query("SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')")
def filter_in_list(spark: SparkSession, folder: str) -> DataFrame:
    return shaping.in_list(table(spark, folder, "customer"), "c_mktsegment", ["BUILDING", "MACHINERY", "HOUSEHOLD"])


@query(
    """
    SELECT * FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-06-30'
    """
)
def filter_date_window(spark: SparkSession, folder: str) -> DataFrame:
    return shaping.in_window(table(spark, folder, "orders"), "o_orderdate", dt.date(1997, 1, 1), dt.date(1997, 6, 30))


@query(
    """
    SELECT 'head' AS slice, position, o_orderkey, o_totalprice FROM
      (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position, * FROM orders) WHERE position <= 458
    UNION ALL
    SELECT 'rest', position, o_orderkey, o_totalprice FROM
      (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position, * FROM orders) WHERE position >= 400
    """
)
def slice_row_range(spark: SparkSession, folder: str) -> DataFrame:
    """Two overlapping row ranges of one numbering, the upper bound included."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    numbered = ordering.with_position(orders, ["o_orderkey"], ties=False)
    head = numbered.filter(F.col("position") <= 458).withColumn("slice", F.lit("head"))
    rest = numbered.filter(F.col("position") >= 400).withColumn("slice", F.lit("rest"))
    return head.unionByName(rest).select("slice", "position", "o_orderkey", "o_totalprice")


@query(
    """
    SELECT row_number() OVER (ORDER BY c_nationkey, c_custkey) - 1 AS position, c_custkey, c_nationkey, c_name
    FROM customer
    """
)
def sort_by_key(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_name")
    return ordering.with_position(customer, ["c_nationkey", "c_custkey"], ties=False)


@query(
    """
    SELECT row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|42'), o_orderkey) - 1 AS position,
           o_orderkey, o_custkey
    FROM orders
    """
)
def shuffle_seeded(spark: SparkSession, folder: str) -> DataFrame:
    """The place of each order in a repeatable permutation."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return ordering.with_position(orders, ordering.permutation_order(["o_orderkey"], seed=42), ties=False)
