import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from snapledger.operators import features
from tests.conftest import rows


def test_standardizer_uses_the_training_statistics(spark):
    train = spark.createDataFrame([(1.0, 5), (2.0, 5), (4.0, 5)], "a double, b int")
    test = spark.createDataFrame([(10.0, 5), (None, 6)], "a double, b int")
    fitted = features.fit_standardizer(train, ["a", "b"])
    mean, std = np.mean([1, 2, 4]), np.std([1, 2, 4], ddof=1)
    found = fitted.transform(test).collect()
    assert found[0].a == pytest.approx((10 - mean) / std)
    assert found[1].a is None and found[0].b is None and found[1].b is None


def test_leading_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert features.leading_columns(df, 1) == ["a", "b"]
    assert features.leading_columns(df, 0) == ["a", "b", "c"]


def test_indicators_for_both_spellings(spark):
    df = spark.createDataFrame([(1, "High"), (2, "medium"), (3, "none"), (4, None)], "k int, r string")
    found = features.indicators(df, {"r": "work_rate"})
    assert found.columns == ["k", "work_rate_high", "work_rate_medium", "work_rate_low"]
    assert rows(found) == [(1, 1, 0, 0), (2, 0, 1, 0), (3, 0, 0, 0), (4, 0, 0, 0)]


def test_string_index_order(spark):
    df = spark.createDataFrame([(v,) for v in "bbaacz"], "c string")
    fitted = features.index_stage(["c"]).fit(df)
    assert list(fitted.labelsArray[0]) == ["a", "b", "c", "z"]
    unseen = spark.createDataFrame([("q",), (None,)], "c string")
    assert [r.c_indexed for r in fitted.transform(unseen).collect()] == [4.0, 4.0]


def test_feature_stages_keep_the_given_order(spark):
    df = spark.createDataFrame([(1, 2.0, "low"), (3, 4.0, "odd")], "a int, b double, r string")
    fitted = Pipeline(stages=features.feature_stages(["b", "a"], ["r"])).fit(df)
    found = features.vector_columns(fitted.transform(df).select("feature_cols"), "feature_cols", list("bahml"))
    assert rows(found) == [(2.0, 1.0, 0.0, 0.0, 1.0), (4.0, 3.0, 0.0, 0.0, 0.0)]


def test_hash_split_is_a_partition_that_ignores_partitioning(spark):
    df = spark.range(2000).withColumn("k", F.col("id") % 500)
    first = features.with_fold(df.repartition(3), "k")
    assert rows(first) == rows(features.with_fold(df.repartition(8), "k"))
    assert first.groupBy("k").agg(F.countDistinct("fold").alias("n")).filter("n > 1").count() == 0
    train = first.filter("fold = 'train'").count()
    assert first.filter("fold = 'test'").count() == 2000 - train
    assert 0.7 < train / 2000 < 0.9
    assert rows(features.with_fold(df, "k", seed=3)) != rows(first)


def test_wide_table(spark):
    old = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    new = spark.createDataFrame([(1, 11), (3, 33)], "k int, v int")
    found = features.wide_two_snapshots(old, new, "k")
    assert found.columns == ["k", "old_v", "new_v"] and rows(found) == [(1, 10, 11)]


def test_sample_with_replacement(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    found = features.sample_with_replacement(df, "k", 2.5, seed=1)
    assert rows(found) == rows(features.sample_with_replacement(df.repartition(5), "k", 2.5, seed=1))
    assert rows(found) != rows(features.sample_with_replacement(df, "k", 2.5, seed=2))
    counts = [r["count"] for r in found.groupBy("k").count().collect()]
    assert abs(sum(counts) / 2000 - 2.5) < 0.15 and abs((2000 - len(counts)) / 2000 - 0.082) < 0.025
    assert features.sample_with_replacement(df, "k", 0.0, seed=1).count() == 0

def test_bootstrap_has_its_size(spark):
    """Exactly as many rows as asked for, the same however the table is dealt, and spread as draws are."""
    df = spark.range(1000).select((F.col("id") * 3).alias("k"), F.lit("v").alias("v"))
    first = [tuple(r) for r in features.bootstrap(df.repartition(7), "k", seed=3, rows=5000).collect()]
    second = [tuple(r) for r in features.bootstrap(df.repartition(1), "k", seed=3, rows=5000).collect()]
    assert len(first) == 5000 and sorted(first) == sorted(second)
    counts = {}
    for k, _ in first:
        counts[k] = counts.get(k, 0) + 1
    # Poisson with mean five: about 0.7 percent are never drawn.
    assert 980 < len(counts) <= 1000 and max(counts.values()) < 20
    assert features.bootstrap(df, "k", seed=3).count() == 1000
    other = sorted(tuple(r) for r in features.bootstrap(df, "k", seed=4, rows=5000).collect())
    assert other != sorted(first)
    assert features.bootstrap(df.limit(0), "k", seed=3, rows=5).collect() == []
    assert features.bootstrap(df, "k", seed=3, rows=0).collect() == []
