"""Bringing two snapshots and a dimension together."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.operators.shaping import union_aligned
from snapledger.operators.skew import split_filter
from snapledger.sources.literal import literal_rows


def distinct_keys(df: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """The keys of a table once each; duplicates are removed before the shuffle."""
    keys = df.select(F.col(key).alias(name or key))
    return keys.filter(F.col(name or key).isNotNull()).distinct()


def matched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right, key, "inner")


def with_optional(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right, key, "left")


def present_in(df: DataFrame, keys: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(distinct_keys(keys, other_key or key, key), key, "left_semi")


def missing_in(df: DataFrame, keys: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows whose key does not occur in ``keys``; for tables without very frequent keys."""
    return df.join(distinct_keys(keys, other_key or key, key), key, "left_anti")


def fallback_rows(newer: DataFrame, older: DataFrame, key: str) -> DataFrame:
    """Full rows of the newer table for the entities that the older one lacks."""
    return missing_in(newer.filter(F.col(key).isNotNull()), older, key)


def missing_dimension(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows without a dimension row. Facts may repeat a key at will, so hot keys go apart."""
    return split_filter(facts, dimension, key, present=False)


def append_rows(df: DataFrame, rows: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Append literal patch rows, matched by name, with the types of ``df``."""
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    return df.unionByName(literal_rows(df.sparkSession, rows, nullable))


def fold_join(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Inner join of a list of tables. The running result stays partitioned by the key,
    so each step moves only the table it adds."""
    return reduce(lambda joined, table: joined.join(table, key), tables)


def reconcile(
    newer: DataFrame, snapshot: DataFrame, dimension: DataFrame, key: str, origin: str | None = None
) -> DataFrame:
    """One row per entity of the newer table: its snapshot row with its dimension, or its newer
    row where the snapshot has none. The columns are those of the snapshot joined with the dimension.

    ``snapshot`` has one row per key. With ``origin`` a column of that name tells
    ``window`` rows from ``fallback`` rows.
    """
    found = with_optional(present_in(snapshot, newer, key), dimension, key)
    extra = fallback_rows(newer, snapshot, key)
    if origin:
        found = found.withColumn(origin, F.lit("window"))
        extra = extra.withColumn(origin, F.lit("fallback"))
    return union_aligned(found, extra)


def counted(df: DataFrame, **steps: Column) -> tuple[DataFrame, Observation]:
    """``df`` and what counts its rows by conditions while some action takes them, such as a sink.

    No further pass: ``observation.get`` has the counts once the action has run, as a dictionary. A row whose
    condition is null does not count.
    """
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    return df.observe(seen, *[F.count(F.when(condition, 1)).alias(name) for name, condition in steps.items()]), seen


def reconcile_counted(
    newer: DataFrame, snapshot: DataFrame, dimension: DataFrame, key: str
) -> tuple[DataFrame, Observation]:
    """The rows of :func:`reconcile`, and the counts of its steps in passing.

    Keys must be unique in all three tables and present in ``newer``, as ``join_cardinality`` tells; else use :func:`coverage_audit`.
    """
    known = dimension.withColumn("_known", F.lit(True))
    found = with_optional(present_in(snapshot, newer, key), known, key).withColumn("_origin", F.lit("window"))
    extra = fallback_rows(newer, snapshot, key).withColumns({"_known": F.lit(None).cast("boolean"), "_origin": F.lit("fallback")})
    window = F.col("_origin") == "window"
    steps = {"only_newer": ~window, "in_both": window, "missing_dimension": window & F.col("_known").isNull()}
    rows, seen = counted(union_aligned(found, extra), **steps)
    return rows.drop("_known", "_origin"), seen


def audit_of_counts(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """The counts of :func:`reconcile_counted` as the ``(step, rows)`` of :func:`coverage_audit`."""
    everyone, both = counts["only_newer"] + counts["in_both"], counts["in_both"]
    steps = {"requested": everyone, "imported": everyone, "only_newer": counts["only_newer"], "in_both": both}
    steps |= {"with_dimension": both, "missing_dimension": counts["missing_dimension"]}
    return spark.createDataFrame(list(steps.items()), "step string, rows long")


def _occurrences(key: str, **tables: DataFrame) -> DataFrame:
    """Per key the number of rows in each table: one shuffle, summed up before it."""
    tagged = [
        df.select(
            F.col(key).alias("_key"),
            *[F.lit(1 if other == name else 0).cast("long").alias(other) for other in tables],
        )
        for name, df in tables.items()
    ]
    stacked = reduce(DataFrame.unionByName, tagged)
    counted = stacked.groupBy("_key").agg(*[F.sum(name).alias(name) for name in tables])
    first, *others = tables
    # A null key matches nothing.
    return counted.select(
        "_key", first, *[F.when(F.col("_key").isNull(), 0).otherwise(F.col(n)).alias(n) for n in others]
    )


def coverage_audit(
    requested: DataFrame, snapshot: DataFrame, dimension: DataFrame, key: str
) -> DataFrame:
    """Row counts of the reconciliation steps as ``(step, rows)``, without running the joins.

    A left join yields ``l * greatest(r, 1)`` rows for a key with ``l`` and ``r`` rows, so all
    counters follow from the occurrences per key.
    """
    per_key = _occurrences(key, requested=requested, snapshot=snapshot, dimension=dimension)
    asked, old, dim = F.col("requested"), F.col("snapshot"), F.col("dimension")
    steps = {
        "requested": asked,
        "imported": asked * F.greatest(old, F.lit(1)),
        "only_newer": F.when(old == 0, asked).otherwise(0),
        "in_both": asked * old,
        "with_dimension": asked * old * F.greatest(dim, F.lit(1)),
        "missing_dimension": F.when(dim == 0, asked * old).otherwise(0),
    }
    totals = per_key.agg(*[F.coalesce(F.sum(e), F.lit(0)).cast("long").alias(n) for n, e in steps.items()])
    return totals.unpivot([], list(steps), "step", "rows")


def join_cardinality(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """What an inner join on ``key`` would do to the row count, as one row.

    Equal row counts before and after can hide unmatched rows that duplicated keys make up
    for, so both are counted on their own.
    """
    per_key = _occurrences(key, left_rows=left, right_rows=right)
    lft, rgt = F.col("left_rows"), F.col("right_rows")
    measures = {
        "rows_before": lft,
        "rows_after": lft * rgt,
        "unmatched_left_rows": F.when(rgt == 0, lft).otherwise(0),
        "duplicated_right_keys": (rgt > 1).cast("long"),
    }
    return per_key.agg(
        *[F.coalesce(F.sum(e), F.lit(0)).cast("long").alias(name) for name, e in measures.items()]
    )


def require_one_to_one(left: DataFrame, right: DataFrame, key: str) -> None:
    """Raise unless every left row has exactly one partner."""
    row = join_cardinality(left, right, key).first()
    if row["unmatched_left_rows"]:
        raise ValueError(f"{row['unmatched_left_rows']} rows have no partner on {key}")
    if row["rows_after"] != row["rows_before"]:
        raise ValueError(f"{row['duplicated_right_keys']} keys are duplicated on the right of {key}")


def duplicate_keys(df: DataFrame, keys: Sequence[str], at_least: int = 2) -> DataFrame:
    """Keys that occur repeatedly, most frequent first, as ``(*keys, count)``."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return counted.filter(F.col("count") >= at_least).orderBy(F.desc("count"), *keys)
