"""A semi- or anti-join whose fact side may have very frequent keys.

Adaptive execution splits skewed partitions only where both join inputs come straight from
a shuffle. Here the other side is reduced to distinct keys first, so the few hot keys are handled
apart: their fact rows stay where they are and meet a list of the hot keys that are present.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that a frequent-items sketch keeps count of. Its counts exceed the true ones by at most about 4 / TRACKED of all rows.
TRACKED = 10_000


def frequent_keys(df: DataFrame, key: str, share: float, tracked: int = TRACKED) -> DataFrame:
    """``(key, rows)``: the keys that may have at least ``share`` of the rows, at most ``1 / share`` of them, most frequent first.

    The counts come from a mergeable sketch of bounded size, so that one pass over the key gives them and one
    row per task is all that moves; no key is shuffled. They are upper bounds: no key with its share is missing, and one that is
    listed misses it by at most about ``4 / tracked`` of the rows. Null is no key.
    """
    if share <= 4 / tracked:
        raise ValueError(f"a share of {share} needs more than {4 / share:.0f} tracked keys")
    # Null may take one of the places.
    most = F.call_function("approx_top_k", F.col(key), F.lit(math.ceil(1 / share) + 1), F.lit(tracked))
    counted = df.agg(F.count(F.lit(1)).alias("_total"), most.alias("_most"))
    found = counted.select("_total", F.explode("_most").alias("_item")).filter(F.col("_item.item").isNotNull())
    enough = found.filter(F.col("_item.count") >= F.col("_total") * F.lit(share))
    return enough.select(F.col("_item.item").alias(key), F.col("_item.count").alias("rows"))


def hot_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Keys with at least ``share`` of all rows: never more than ``1 / share`` keys."""
    return frequent_keys(df, key, share).select(key)


def split_filter(
    facts: DataFrame, keys: DataFrame, key: str, present: bool, share: float = 0.01
) -> DataFrame:
    """The fact rows whose key is ``present`` in ``keys``, or those whose key is not.

    A sketch of the facts' keys is made once, and those with about ``share`` of the rows come to the
    driver: at most ``1 / share`` values, whatever the data. With none, which is the usual case, a plain join follows. Rows
    with a hot key are not shuffled: whether it occurs in ``keys`` is looked up once and becomes a literal list. Rows
    without a key match nothing and stay out of the shuffle, too. Nothing is salted, so a repeated task yields the same rows.
    """
    known = keys.select(key).distinct()
    hot = [r[0] for r in hot_keys(facts, key, share).collect()]
    value = F.col(key)
    cold, apart = value.isNotNull(), None if present else value.isNull()
    if hot:
        found = {r[0] for r in known.filter(value.isin(hot)).collect()}
        wanted = [k for k in hot if (k in found) == present]
        cold &= ~value.isin(hot)
        if wanted:
            apart = value.isin(wanted) if apart is None else apart | value.isin(wanted)
    result = facts.filter(cold).join(known, key, "left_semi" if present else "left_anti")
    # Hot keys and rows without one in a single filter.
    return result if apart is None else result.unionByName(facts.filter(apart))
