"""Scalar function queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.functions import clean
from snapledger.operators import features
from snapledger.plans.registry import query, table


@query(
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS birthday,
           CAST(2015 - year(o_orderdate)
             - CASE WHEN strftime(o_orderdate, '%m%d') > '1001' THEN 1 ELSE 0 END AS INTEGER) AS age
    FROM orders
    """
)
def scalar_age_at(spark: SparkSession, folder: str) -> DataFrame:
    birthday = F.to_date("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey", birthday.alias("birthday"), clean.age_at(birthday, dt.date(2015, 10, 1)).alias("age")
    )


@query(
    """
    WITH b AS (
      SELECT o_orderkey, month(o_orderdate) AS m, day(o_orderdate) AS d, year(o_orderdate) % 100 AS y FROM orders),
    p AS (
      SELECT o_orderkey, CAST(m * 10000 + d * 100 + y AS INTEGER) AS written,
             CASE WHEN make_date(2000 + y, m, d) < DATE '2016-06-01' THEN make_date(2000 + y, m, d)
                  ELSE make_date(1900 + y, m, d) END AS birthday
      FROM b)
    SELECT o_orderkey, written, birthday,
           CAST(2016 - year(birthday)
             - CASE WHEN strftime(birthday, '%m%d') > '0601' THEN 1 ELSE 0 END AS INTEGER) AS age
    FROM p
    """
)
def scalar_two_digit_birthday(spark: SparkSession, folder: str) -> DataFrame:
    now = dt.date(2016, 6, 1)
    date = F.col("o_orderdate")
    written = (F.month(date) * 10000 + F.dayofmonth(date) * 100 + F.year(date) % 100).cast("int")
    birthday = clean.two_digit_birthday(F.col("written"), now)
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", written.alias("written"))
        .withColumn("birthday", birthday)
        .withColumn("age", clean.age_at(F.col("birthday"), now))
    )


@query(
    """
    SELECT page_id, split_part(url, '/', 3) AS host, nullif(split_part(url, '/', 6), '') AS third FROM pages
    """
)
def scalar_url_segment(spark: SparkSession, folder: str) -> DataFrame:
    """Path parts by position; pages whose URL is too short have a null in the last column."""
    url = F.col("url")
    return table(spark, folder, "pages").select(
        "page_id",
        clean.url_segment(url, 2).alias("host"),
        F.nullif(clean.url_segment(url, 5), F.lit("")).alias("third"),
    )


@query(
    """
    SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'None') || ' / ' || o_orderpriority AS pair FROM orders
    """
)
def scalar_combine_pair(spark: SparkSession, folder: str) -> DataFrame:
    """Status P plays the missing value."""
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return table(spark, folder, "orders").select(
        "o_orderkey", clean.combine_pair(status, F.col("o_orderpriority")).alias("pair")
    )


def work_rate() -> Column:
    """A composite category from an order: priority word, then a word for the status if it has one."""
    word = clean.part(F.col("o_orderpriority"), "-", 1)
    second = (
        F.when(F.col("o_orderstatus") == "F", F.lit("/ High "))
        .when(F.col("o_orderstatus") == "O", F.lit("/low"))
        .otherwise(F.lit(""))
    )
    return F.concat(word, F.lit(" "), second)


# The same composite and its two levels in SQL.
_WORK_RATE_SQL = """
    SELECT o_orderkey, split_part(o_orderpriority, '-', 2) || ' ' ||
           CASE o_orderstatus WHEN 'F' THEN '/ High ' WHEN 'O' THEN '/low' ELSE '' END AS work_rate
    FROM orders
"""
_LEVEL_SQL = """CASE WHEN lower(trim({part})) IN ('high', 'medium', 'low') THEN lower(trim({part}))
                     ELSE 'medium' END"""


@query(
    f"""
    WITH r AS ({_WORK_RATE_SQL})
    SELECT o_orderkey, work_rate, {_LEVEL_SQL.format(part="split_part(work_rate, '/', 1)")} AS att,
           {_LEVEL_SQL.format(part="split_part(work_rate, '/', 2)")} AS def
    FROM r
    """
)
def scalar_split_category(spark: SparkSession, folder: str) -> DataFrame:
    rates = table(spark, folder, "orders").select("o_orderkey", work_rate().alias("work_rate"))
    return rates.withColumns(
        {
            "att": clean.level(clean.part(F.col("work_rate"), "/", 0)),
            "def": clean.level(clean.part(F.col("work_rate"), "/", 1)),
        }
    )


@query(
    """
    WITH t AS (
      SELECT p_partkey, p_size,
             CASE p_type WHEN 'PROMO' THEN CAST(p_size AS VARCHAR) WHEN 'SMALL' THEN 'unknown'
                         WHEN 'LARGE' THEN NULL ELSE CAST(p_size AS VARCHAR) || ' cm' END AS height FROM part)
    SELECT p_partkey, height, TRY_CAST(split_part(height, ' ', 1) AS INTEGER) AS centimetres FROM t
    """
)
def scalar_parse_unit(spark: SparkSession, folder: str) -> DataFrame:
    """With the unit, without it, unreadable and missing."""
    size = F.col("p_size").cast("string")
    height = (
        F.when(F.col("p_type") == "PROMO", size)
        .when(F.col("p_type") == "SMALL", F.lit("unknown"))
        .when(F.col("p_type") == "LARGE", F.lit(None))
        .otherwise(F.concat(size, F.lit(" cm")))
    )
    return (
        table(spark, folder, "part")
        .select("p_partkey", height.alias("height"))
        .withColumn("centimetres", clean.leading_number(F.col("height")))
    )


@query(
    """
    WITH t AS (
      SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q,
             l_returnflag AS f FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, CASE f WHEN 'R' THEN q || ' kg' ELSE q END AS weight,
           CASE f WHEN 'R' THEN CAST(round_even(CAST(q AS INTEGER) * CAST(2.20462 AS DOUBLE), 0) AS INTEGER)
                  ELSE CAST(q AS INTEGER) END AS pounds
    FROM t
    """
)
def scalar_weight_to_lb(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("l_quantity").cast("int").cast("string")
    weight = F.when(F.col("l_returnflag") == "R", F.concat(number, F.lit(" kg"))).otherwise(number)
    return (
        table(spark, folder, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey", weight.alias("weight"))
        .withColumn("pounds", clean.weight_in_pounds(F.col("weight")))
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(round_even(l_quantity / 2, 0) AS INTEGER) AS half,
           CAST(round_even(-l_quantity / 2, 0) AS INTEGER) AS minus_half,
           CAST(round_even(CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE), 0) AS INTEGER) AS price
    FROM lineitem
    """
)
def scalar_round_half_even(spark: SparkSession, folder: str) -> DataFrame:
    """Halves go to the even neighbour, for numbers and for number texts."""
    half = F.col("l_quantity") / 2
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        clean.round_half_even(half).alias("half"),
        clean.round_half_even(-half).alias("minus_half"),
        clean.round_half_even(F.col("l_extendedprice").cast("string")).alias("price"),
    )


@query(
    """
    SELECT o_orderkey,
           CAST(lower(split_part(o_orderpriority, '-', 2)) = 'high' AS INTEGER) AS rate_high,
           CAST(lower(split_part(o_orderpriority, '-', 2)) = 'medium' AS INTEGER) AS rate_medium,
           CAST(lower(split_part(o_orderpriority, '-', 2)) = 'low' AS INTEGER) AS rate_low
    FROM orders
    """
)
def feature_indicators(spark: SparkSession, folder: str) -> DataFrame:
    """Values outside the domain are 0 in all columns; the source column goes."""
    word = clean.part(F.col("o_orderpriority"), "-", 1)
    rates = table(spark, folder, "orders").select("o_orderkey", word.alias("priority"))
    return features.indicators(rates, {"priority": "rate"})


@query(
    """
    SELECT l_orderkey, l_linenumber, CAST(round_even(l_extendedprice * 1000000, 0) AS BIGINT) AS large,
           CAST(round_even(l_quantity / 4, 0) AS BIGINT) AS quarter
    FROM lineitem
    """
)
def scalar_whole_number(spark: SparkSession, folder: str) -> DataFrame:
    """Halves go to the even neighbour, and numbers beyond 32 bits stay."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        clean.whole_number(F.col("l_extendedprice") * 1000000).alias("large"),
        clean.whole_number(F.col("l_quantity") / 4).alias("quarter"),
    )


@query(
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
    """
)
def scalar_text_timestamp_to_date(spark: SparkSession, folder: str) -> DataFrame:
    """The date of a timestamp written as text."""
    written = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return table(spark, folder, "orders").select("o_orderkey", clean.timestamp_text_to_date(written).alias("day"))
