"""A Bloom filter of keys that thins out the rows of a fact table before they are shuffled."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per key, and the most words of 64 bits that a filter may have: 8 MB, which every task holds.
BITS_PER_KEY = 16
MAX_WORDS = 1 << 20
#: Bits that a key sets, all in one word.
PROBES = 4


@dataclass(frozen=True)
class KeyFilter:
    """Tells for almost every key that is not in a table that it is not, and never so of one that is.

    A key sets four bits of one word of 64. Words are merged by a bitwise or, so that every task sends its own words once.
    """

    words: Column
    size: int

    @classmethod
    def build(cls, keys: DataFrame, key: str, max_words: int = MAX_WORDS) -> KeyFilter | None:
        """A filter of the keys, sized by an estimate of their number, or None where it would take more than ``max_words``."""
        count = keys.agg(F.approx_count_distinct(key)).first()[0]
        size = 1 << max(4, (max(count, 1) * BITS_PER_KEY // 64).bit_length())
        if size > max_words:
            return None
        word, bits = _word(F.col(key), size), _bits(F.col(key))
        # A word that no key falls into is there as well, so that a word's place is its number.
        own = keys.filter(F.col(key).isNotNull()).select(word.alias("word"), bits.alias("bits"))
        every = keys.sparkSession.range(size).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
        merged = own.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
        ordered = merged.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))
        return cls(ordered.select(F.col("words.bits")).scalar(), size)

    def might_contain(self, value: Column) -> Column:
        """False for keys that are surely missing, and for null."""
        bits = _bits(value)
        return value.isNotNull() & (F.get(self.words, _word(value, self.size)).bitwiseAND(bits) == bits)


def _word(value: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(size)).cast("int")


def _bits(value: Column) -> Column:
    spread = F.xxhash64(F.lit("bits"), value)
    one = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(spread, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
    return reduce(Column.bitwiseOR, [one(k) for k in range(PROBES)])


def present_filtered(facts: DataFrame, keys: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """The fact rows whose key occurs in ``keys``, as by ``reconcile.present_in``, read once and thinned out before the shuffle.

    Worth its pass over the keys where few fact rows have a partner. Too many keys for a filter are a plain join.
    """
    wanted = keys.select(F.col(other_key or key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    found = KeyFilter.build(wanted, key)
    thinned = facts if found is None else facts.filter(found.might_contain(F.col(key)))
    return thinned.join(wanted, key, "left_semi")


def missing_filtered(facts: DataFrame, keys: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """The fact rows whose key does not occur in ``keys``, as by ``reconcile.missing_in``, rows without a key included.

    Rows that the filter knows to be missing are never shuffled; the others meet the keys. Worth it where most rows are missing.
    """
    wanted = keys.select(F.col(other_key or key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    found = KeyFilter.build(wanted, key)
    if found is None:
        return facts.join(wanted, key, "left_anti")
    known = found.might_contain(F.col(key))
    return facts.filter(~known).unionByName(facts.filter(known).join(wanted, key, "left_anti"))
