import random

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from snapledger.operators import evaluate


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(1)
    values = [(float(i % 7), rnd.gauss(i % 7, 1.0)) for i in range(400)]
    return spark.createDataFrame(values, "y double, p double").cache()


def test_metrics_equal_the_evaluator(scored):
    row = evaluate.evaluate(scored, "y", "p").first()
    for metric in ("rmse", "mse", "mae", "r2", "var"):
        evaluator = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=metric)
        assert row[metric] == pytest.approx(evaluator.evaluate(scored)), metric
        assert (metric in evaluate.LARGER_IS_BETTER) == evaluator.isLargerBetter()


def test_metrics_by_group(scored):
    found = evaluate.evaluate(scored, "y", "p", ["mae", "r2"], by=["y"])
    assert found.columns == ["y", "mae", "r2"] and found.count() == 7
    assert all(r.r2 is None for r in found.collect())


def histogram(df, bins):
    counts = np.zeros(bins, dtype=int)
    for r in evaluate.histogram2d(df, "x", "y", bins).collect():
        counts[r.bin_x, r.bin_y] = r.n
    return counts


@pytest.mark.parametrize("bins", [(100, 100), (10, 7), (1, 1)])
def test_histogram_equals_numpy(spark, bins):
    rnd = random.Random(2)
    # Steps of 0.1 put many values on or next to bin edges.
    points = [(round(rnd.randrange(0, 101) * 0.1, 1), rnd.uniform(-3, 3)) for _ in range(2000)]
    df = spark.createDataFrame(points, "x double, y double")
    expected, _, _ = np.histogram2d(*zip(*points), bins=bins)
    found = histogram(df, bins)
    assert found.sum() == 2000
    assert (found == expected).all()


def test_histogram_of_a_constant_and_of_nulls(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (None, 9.0)], "x double, y double")
    expected, _, _ = np.histogram2d([5.0, 5.0], [1.0, 2.0], bins=(4, 4))
    assert (histogram(df, (4, 4)) == expected).all()
    assert histogram(df.limit(0), (4, 4)).sum() == 0


def test_shift_and_residuals(spark):
    df = spark.createDataFrame([(1, 1.0, 4.0), (2, 2.0, 1.0)], "k int, a double, b double")
    assert evaluate.mean_abs_shift(df, "a", "b").first()[0] == 2.0
    assert [tuple(r) for r in evaluate.residuals(df, ["k"], "a", "b").collect()] == [
        (1, 1.0, 4.0, -3.0),
        (2, 2.0, 1.0, 1.0),
    ]


def test_best_candidate(spark):
    scores = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 3.0), ("n", None)], "candidate string, score double")
    assert tuple(evaluate.best_candidate(scores, "score").first()) == ("a", 2.0)
    assert tuple(evaluate.best_candidate(scores, "score", larger_is_better=True).first()) == ("c", 3.0)
