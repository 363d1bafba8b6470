"""Feature preparation."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger import presets
from snapledger.functions import clean
from snapledger.operators.ordering import with_position
from snapledger.operators.shaping import prefix_except


@dataclass(frozen=True)
class Standardizer:
    """Column means and sample deviations of a training table."""

    means: Mapping[str, float | None]
    deviations: Mapping[str, float | None]

    def transform(self, df: DataFrame) -> DataFrame:
        """Standardise the fitted columns; a constant column becomes null."""
        return df.withColumns({c: self.scaled(F.col(c), c) for c in self.means if c in df.columns})

    def scaled(self, value: Column, column: str) -> Column:
        mean, deviation = F.lit(self.means[column]), F.lit(self.deviations[column])
        return F.try_divide(value.cast("double") - mean, deviation)


def fit_standardizer(df: DataFrame, columns: Sequence[str]) -> Standardizer:
    """All statistics in one pass, one row to the driver."""
    row = df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_samp(c).alias(f"std_{c}") for c in columns],
    ).first()
    return Standardizer({c: row[f"mean_{c}"] for c in columns}, {c: row[f"std_{c}"] for c in columns})


def leading_columns(df: DataFrame, keep_last: int) -> list[str]:
    """All columns but the last ``keep_last`` ones."""
    return df.columns[: len(df.columns) - keep_last]


def indicators(
    df: DataFrame,
    sources: Mapping[str, str],
    domain: Sequence[str] = tuple(presets.LEVELS),
) -> DataFrame:
    """0/1 columns ``<prefix>_<value>`` for each ``{column: prefix}``, replacing the column."""
    added = {
        f"{prefix}_{value}": clean.indicator(F.col(column), value)
        for column, prefix in sources.items()
        for value in domain
    }
    return df.withColumns(added).drop(*sources)


def index_stage(
    columns: Sequence[str], labels: Sequence[str] | None = None, suffix: str = "_indexed"
) -> StringIndexer | StringIndexerModel:
    """Category to number. A closed domain needs no pass over the data; else the most
    frequent value is 0 and ties are alphabetical. Unknown values get the last index."""
    outputs = [f"{c}{suffix}" for c in columns]
    if labels is not None:
        return StringIndexerModel.from_arrays_of_labels(
            [list(labels)] * len(columns), list(columns), outputs, handleInvalid="keep"
        )
    return StringIndexer(inputCols=list(columns), outputCols=outputs, handleInvalid="keep")


def index_by_frequency(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the rank of the column's value as a double: the most frequent is 0, ties are alphabetical.

    For domains too large for a list on the driver: values are counted, numbered by a range sort and joined back.
    Rows without a value get null.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    ranked = with_position(counts, [F.desc("_n"), F.col(column)], name, ties=False)
    return df.join(ranked.select(column, F.col(name).cast("double").alias(name)), column, "left")


def one_hot_stage(columns: Sequence[str], suffix: str = "_he") -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[f"{c}_indexed" for c in columns],
        outputCols=[f"{c}{suffix}" for c in columns],
        dropLast=True,
    )


def assemble_stage(columns: Sequence[str], output: str = "feature_cols") -> VectorAssembler:
    """Rows with a null feature raise, so that none is lost unseen."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error")


def feature_stages(
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    labels: Sequence[str] | None = tuple(presets.LEVELS),
    output: str = "feature_cols",
) -> list[Transformer]:
    """Index, one-hot and assemble, in the order the columns are given."""
    stages: list = []
    if categorical:
        stages += [index_stage(categorical, labels), one_hot_stage(categorical)]
    return [*stages, assemble_stage([*numeric, *[f"{c}_he" for c in categorical]], output)]


def vector_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Replace a vector column by one plain column per element."""
    values = vector_to_array(F.col(vector))
    others = [F.col(c) for c in df.columns if c != vector]
    return df.select(*others, *[F.get(values, F.lit(i)).alias(n) for i, n in enumerate(names)])


def wide_two_snapshots(
    older: DataFrame, newer: DataFrame, key: str, prefixes: tuple[str, str] = ("old_", "new_")
) -> DataFrame:
    """One row per entity that both snapshots know, columns prefixed by their snapshot."""
    return prefix_except(older, prefixes[0], [key]).join(prefix_except(newer, prefixes[1], [key]), key)


def _hash_part(key: str, seed: int | None) -> Column:
    """32 bits that depend on the key and the seed alone, not on partitioning or run."""
    text = F.col(key).cast("string")
    if seed is not None:
        text = F.concat_ws("|", text, F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_tenth(key: str, seed: int | None = None) -> Column:
    """A number from 0 to 9 that depends on the key alone, not on partitioning or run."""
    return (_hash_part(key, seed) % 10).cast("int")


def with_fold(df: DataFrame, key: str, train_tenths: int = presets.TRAIN_TENTHS, seed: int | None = None) -> DataFrame:
    """Add ``fold``: ``train`` for ``train_tenths`` of ten hash classes of the key, else ``test``."""
    return df.withColumn(
        "fold", F.when(hash_tenth(key, seed) < train_tenths, F.lit("train")).otherwise(F.lit("test"))
    )


def poisson_limits(mean: float) -> list[float]:
    """The probabilities of at most 0, 1, 2, ... as far as a 32-bit fraction can tell them from 1."""
    limits, term, total, k = [], math.exp(-mean), 0.0, 0
    while total + term < 1 - 2.0**-33 and (k <= mean or term > 2.0**-40):
        total += term
        limits.append(total)
        k += 1
        term *= mean / k
    return limits


def sample_with_replacement(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Each row a Poisson number of times with mean ``fraction``, which may exceed 1.

    The number follows from a hash of the key and the seed through the inverse of the distribution, so the sample is
    the same for any partitioning; rows of equal keys are taken equally often.
    """
    limits = F.array(*map(F.lit, poisson_limits(fraction)))
    # Bound, so that the digest is not worked out anew for every limit.
    chance = _hash_part(key, seed) / F.lit(float(1 << 32))
    times = clean.bound(chance, lambda c: F.size(F.filter(limits, lambda limit: c >= limit)))
    return df.withColumn("_times", F.explode(F.array_repeat(F.lit(1), times))).drop("_times")


def bootstrap(df: DataFrame, key: str, seed: int, rows: int | None = None) -> DataFrame:
    """Exactly ``rows`` rows, or as many as there are, drawn with replacement, the same ones for any partitioning; an empty table gives none.

    Draw number i takes the row whose place in the order of ``key`` is a hash of i and the seed, modulo the number of rows. Draws are a
    distributed range and are counted per place before they meet the rows, so that no row travels more than once.
    """
    numbered = with_position(df, [key], "_place")
    total = numbered.agg(F.count(F.lit(1))).first()[0]
    if not total:
        return df.limit(0)
    digits = F.substring(F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit(str(seed)))), 1, 15)
    place = F.conv(digits, 16, 10).cast("long") % F.lit(total)
    draws = df.sparkSession.range(total if rows is None else rows).select(place.alias("_place")).groupBy("_place").agg(F.count(F.lit(1)).alias("_times"))
    drawn = numbered.join(draws, "_place")
    return drawn.select(*df.columns, F.explode(F.array_repeat(F.lit(1), F.col("_times").cast("int"))).alias("_one")).drop("_one")
