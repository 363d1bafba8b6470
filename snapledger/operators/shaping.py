"""Projection, renaming, casting, filtering and union: one ``select`` each, no shuffle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.functions import clean


def rename_by_table(df: DataFrame, table: Mapping[str, str]) -> DataFrame:
    """Rename by a translation table; names that do not occur are skipped."""
    return df.withColumnsRenamed(dict(table))


def prefix_except(df: DataFrame, prefix: str, keep: Iterable[str]) -> DataFrame:
    kept = set(keep)
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in kept})


def strip_suffix(df: DataFrame, suffix: str, columns: Iterable[str] | None = None) -> DataFrame:
    """``x_pred`` to ``x``, for all columns or the named ones."""
    wanted = df.columns if columns is None else set(columns)
    return df.withColumnsRenamed(
        {c: c.removesuffix(suffix) for c in df.columns if c in wanted and c.endswith(suffix)}
    )


def cast_all(
    df: DataFrame,
    exclude: Iterable[str] = (),
    cast: Callable[[Column], Column] = clean.text_to_int,
) -> DataFrame:
    """One conversion for all columns but the excluded ones."""
    kept = set(exclude)
    return df.select(
        *[F.col(f"`{c}`") if c in kept else cast(F.col(f"`{c}`")).alias(c) for c in df.columns]
    )


def columns_without(columns: Sequence[str], removed: Iterable[str], added: Sequence[str] = ()) -> list[str]:
    """Column-name difference that keeps the order, then the added names."""
    gone = set(removed)
    return [c for c in columns if c not in gone] + list(added)


def in_list(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def in_window(
    df: DataFrame, column: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Rows of the days ``first`` to ``last``, both included; ``None`` leaves a side open.

    On a date or timestamp column this reaches the file scan as a range filter.
    """
    day = F.to_date(F.col(column))
    if first is not None:
        df = df.filter(day >= F.lit(first))
    if last is not None:
        df = df.filter(day <= F.lit(last))
    return df


def union_aligned(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both, with the columns of the first, matched by name."""
    return first.unionByName(second.select(*first.columns))
