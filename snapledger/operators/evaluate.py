"""Prediction quality as aggregates over rows that never leave the executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger import presets

# Metrics where the larger value is the better one.
LARGER_IS_BETTER = {"r2", "var"}


def regression_metrics(label: Column, prediction: Column) -> dict[str, Column]:
    """``rmse, mse, mae, r2, var`` as aggregate columns for one ``agg``."""
    label, prediction = label.cast("double"), prediction.cast("double")
    error = label - prediction
    mse = F.avg(error * error)
    shift = F.avg(prediction) - F.avg(label)
    return {
        "rmse": F.sqrt(mse),
        "mse": mse,
        "mae": F.avg(F.abs(error)),
        "r2": F.lit(1.0) - F.try_divide(mse, F.var_pop(label)),
        "var": F.var_pop(prediction) + shift * shift,
    }


def evaluate(
    df: DataFrame, label: str, prediction: str, metrics: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """The metrics of all rows, or per group."""
    columns = regression_metrics(F.col(label), F.col(prediction))
    chosen = [columns[m].alias(m) for m in metrics or columns]
    return df.groupBy(*by).agg(*chosen) if by else df.agg(*chosen)


def mean_abs_shift(df: DataFrame, first: str, second: str) -> DataFrame:
    return df.agg(F.avg(F.abs(F.col(first) - F.col(second))).alias("mean_abs_shift"))


def residuals(df: DataFrame, key: Sequence[str], label: str, prediction: str) -> DataFrame:
    """Key, label, prediction and their difference, unsorted."""
    return df.select(
        *key,
        F.col(label).alias("label"),
        F.col(prediction).alias("prediction"),
        (F.col(label) - F.col(prediction)).alias("residual"),
    )


def histogram2d(
    df: DataFrame, x: str, y: str, bins: tuple[int, int] = presets.HISTOGRAM_BINS
) -> DataFrame:
    """Non-empty cells ``(bin_x, bin_y, from_x, from_y, n)`` of equal-width bins over the full range.

    Every bin is closed below and open above, the last one closed on both sides. A constant
    column is widened by half a unit on either side. Rows with a null in either column are left out.
    """
    axes = {"x": bins[0], "y": bins[1]}
    pairs = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    # The limits are one row, found in a single pass and used as scalar subqueries.
    limits = pairs.agg(*[f(c).alias(f"{n}_{c}") for c in axes for n, f in (("lo", F.min), ("hi", F.max))])
    grid = limits.select(*[c for axis, n in axes.items() for c in _grid(axis, n)])
    start = {axis: grid.select(f"start_{axis}").scalar() for axis in axes}
    step = {axis: grid.select(f"step_{axis}").scalar() for axis in axes}

    guesses = {
        f"guess_{axis}": F.least(F.floor((F.col(axis) - start[axis]) / step[axis]), F.lit(n - 1)).cast("int")
        for axis, n in axes.items()
    }
    located = pairs.withColumns(guesses).select(
        *[_corrected(axis, n, start[axis], step[axis]).alias(f"bin_{axis}") for axis, n in axes.items()]
    )
    counted = located.groupBy("bin_x", "bin_y").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        "bin_x",
        "bin_y",
        *[(start[axis] + F.col(f"bin_{axis}") * step[axis]).alias(f"from_{axis}") for axis in axes],
        "n",
    )


def _grid(axis: str, bins: int) -> tuple[Column, Column]:
    low, high = F.col(f"lo_{axis}"), F.col(f"hi_{axis}")
    widen = F.when(low == high, F.lit(0.5)).otherwise(F.lit(0.0))
    step = (high + widen - (low - widen)) / F.lit(float(bins))
    return (low - widen).alias(f"start_{axis}"), step.alias(f"step_{axis}")


def _corrected(axis: str, bins: int, start: Column, step: Column) -> Column:
    """The division can land one bin off at an edge; the edge itself decides."""
    value, guess = F.col(axis), F.col(f"guess_{axis}")
    down = (value < start + guess * step).cast("int")
    up = ((guess < bins - 1) & (value >= start + (guess + 1) * step)).cast("int")
    return guess - down + up


def best_candidate(scores: DataFrame, score: str, larger_is_better: bool = False) -> DataFrame:
    """The row with the best score, as one row; ties go to the first in column order."""
    others = [c for c in scores.columns if c != score]
    value = -F.col(score) if larger_is_better else F.col(score)
    best = scores.filter(F.col(score).isNotNull()).agg(
        F.min(F.struct(value.alias("_value"), *others, F.col(score))).alias("_best")
    )
    return best.select(*[f"_best.{c}" for c in scores.columns])
