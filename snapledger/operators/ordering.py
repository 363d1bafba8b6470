"""Row positions, row ranges and repeatable permutations without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.session import materialize

_ROW_BITS = (1 << 33) - 1


def with_position(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "position", ties: bool = True
) -> DataFrame:
    """Add the 0-based row number in the order of ``order_by``.

    The rows are range-sorted into parts, written once with their part and their rank in it,
    and each part's rank is shifted by the rows before the part. Rows that are equal in the
    ordering are told apart by their content and at last by a salt, so that a value shared by many
    rows is cut into several parts; ``ties=False`` saves both where the ordering has no ties.
    """
    stored = materialize(_ranked_parts(df, order_by, ties), "positions")
    # One row per part, at most spark.sql.shuffle.partitions of them: the window and the
    # broadcast are over that many rows only.
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")
    starts = sizes.select("_part", before.alias("_start"))
    return stored.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.col("_rank")).alias(name)
    )


def _ranked_parts(df: DataFrame, order_by: Sequence[str | Column], ties: bool) -> DataFrame:
    ordered = list(order_by)
    sortable = df
    if ties:
        sortable = df.withColumns(
            {"_content": F.xxhash64(*df.columns), "_salt": F.monotonically_increasing_id()}
        )
        ordered += ["_content", "_salt"]
    return sortable.orderBy(*ordered).select(
        *df.columns,
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("_rank"),
    )


def row_range(
    df: DataFrame,
    order_by: Sequence[str | Column],
    first: int = 0,
    last: int | None = None,
    name: str = "position",
    ties: bool = True,
) -> DataFrame:
    """Rows ``first`` to ``last`` of the declared order, both included; ``None`` is the end."""
    numbered = with_position(df, order_by, name, ties)
    wanted = F.col(name) >= first
    if last is not None:
        wanted &= F.col(name) <= last
    return numbered.filter(wanted)


def permutation_order(key: Sequence[str], seed: int) -> list[Column]:
    """Ordering columns of a permutation that depends on key and seed alone."""
    joined = F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed)))
    return [F.md5(joined), *[F.col(k) for k in key]]


def shuffled(df: DataFrame, key: Sequence[str], seed: int) -> DataFrame:
    """The rows in a random-looking order that is the same on every run and cluster."""
    return df.orderBy(*permutation_order(key, seed))
