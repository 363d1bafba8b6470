"""The latest version of each entity."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.operators.shaping import in_window


def latest_per_key(
    df: DataFrame, key: str, order_by: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """The row with the largest ``order_by`` of each key: the key and ``columns``, or all columns.

    A maximum over structs that begin with the ordering columns: each map task sorts its rows by key and sends at
    most one row per key, so a key with most of the rows costs no more than any other, and there
    is one shuffle, of reduced rows, instead of the two or three of a grouped maximum joined back. Only the wanted
    columns enter the structs and are read. Ties in the ordering are decided by the wanted columns, in their order.
    """
    wanted = list(columns) if columns is not None else [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(_largest(order_by, wanted).alias("_latest"))
    return picked.select(*_unpacked(df, key, wanted))


def _largest(order_by: Sequence[str], columns: Sequence[str], condition: Column | None = None) -> Column:
    values = F.struct(*order_by, *[c for c in columns if c not in order_by])
    return F.max(values if condition is None else F.when(condition, values))


def _unpacked(df: DataFrame, key: str, columns: Sequence[str], source: str = "_latest") -> list[Column]:
    return [F.col(key) if c == key else F.col(f"{source}.{c}").alias(c) for c in df.columns if c == key or c in columns]


def latest_per_period(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    columns: Sequence[str],
    more: Mapping[str, Column] | None = None,
    **periods: Column,
) -> DataFrame:
    """The latest version of each key in each of several periods, in one pass over the versions.

    ``periods`` name conditions; the result has the key and per period a struct of the ordering and the wanted columns,
    null where a key has no version in it. ``more`` are further aggregates of the same pass.
    """
    largest = [_largest(order_by, columns, condition).alias(name) for name, condition in periods.items()]
    further = [column.alias(name) for name, column in (more or {}).items()]
    return df.groupBy(key).agg(*largest, *further)


def latest_in_window(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    stamp: str,
    first: dt.date | None = None,
    last: dt.date | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    return latest_per_key(in_window(df, stamp, first, last), key, order_by, columns)


def latest_with_fallback(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    stamp: str,
    first: dt.date,
    last: dt.date,
    origin: str = "origin",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The latest version in the window or, for keys without one, of the whole history.

    Being in the window is the first ordering column, so one pass and one shuffle give both; the
    column ``origin`` tells ``window`` rows from ``fallback`` rows. Where the fallback rows come
    from another table, see ``reconcile.reconcile``.
    """
    inside = F.coalesce(F.to_date(F.col(stamp)).between(F.lit(first), F.lit(last)), F.lit(False))
    flagged = df.withColumn("_inside", inside)
    source = F.when(F.col("_latest._inside"), F.lit("window")).otherwise(F.lit("fallback"))
    wanted = [c for c in df.columns if c != key] if columns is None else list(columns)
    picked = flagged.groupBy(key).agg(_largest(["_inside", *order_by], wanted).alias("_latest"))
    return picked.select(*_unpacked(df, key, wanted), source.alias(origin))
