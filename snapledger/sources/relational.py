"""JDBC sources with parallel reads."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class ReadSplit:
    """How to cut a table into parallel range reads over a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    parts: int


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    split: ReadSplit | None = None,
    driver: str | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a table or for a query run by the database.

    A split query is passed as a derived table, because the ``query`` option
    does not go together with a partition column.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, "fetchsize": str(fetch_size)}
    if driver:
        options["driver"] = driver
    if table is not None:
        options["dbtable"] = table
    elif split is None:
        options["query"] = query.rstrip().rstrip(";")
    else:
        options["dbtable"] = f"({query.rstrip().rstrip(';')}) AS source_rows"
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.parts),
        }
    return options


def read_table(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table=table, **kwargs)).load()


def read_query(spark: SparkSession, url: str, query: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, query=query, **kwargs)).load()


def bounds_query(column: str, table: str | None = None, query: str | None = None) -> str:
    """One row with the least and the largest value of the column that a read is split by."""
    source = table if query is None else f"({query.rstrip().rstrip(';')}) source_rows"
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {source}"


def window_query(table: str, column: str, first: dt.date, last: dt.date) -> str:
    """The rows of the days ``first`` to ``last``; works for dates, timestamps and ISO texts of them."""
    return f"SELECT * FROM {table} WHERE {column} >= '{first}' AND {column} < '{last + dt.timedelta(days=1)}'"


def read_in_parts(
    spark: SparkSession,
    url: str,
    column: str,
    parts: int,
    table: str | None = None,
    query: str | None = None,
    driver: str | None = None,
) -> DataFrame:
    """A table or query read by ``parts`` range scans over a numeric column, between bounds asked of the database.

    Rows without a value in the column come with the first part, as Spark's ranges are open at both ends.
    """
    low, high = read_query(spark, url, bounds_query(column, table, query), driver=driver).first()
    split = None if low is None else ReadSplit(column, str(low), str(high), parts)
    if query is None:
        return read_table(spark, url, table, split=split, driver=driver)
    return read_query(spark, url, query, split=split, driver=driver)
