import random

import pytest
from pyspark.sql import functions as F

from snapledger.operators import ordering


@pytest.fixture(scope="module")
def numbers(spark):
    """A third of the rows share one value, and some rows are whole copies."""
    rnd = random.Random(5)
    values = [(42 if rnd.random() < 0.4 else rnd.randrange(1000), rnd.randrange(3)) for _ in range(3000)]
    return spark.createDataFrame(values, "v int, w int").repartition(7)


def test_positions_are_complete_and_ordered(numbers):
    found = ordering.with_position(numbers, ["v", F.desc("w")]).orderBy("position").collect()
    assert [r.position for r in found] == list(range(3000))
    assert [(r.v, -r.w) for r in found] == sorted((r.v, -r.w) for r in numbers.collect())


def test_copies_of_one_row_are_cut_into_parts(spark, numbers):
    copies = numbers.select(F.lit(1).alias("v"))
    # Without this, adaptive execution would put so few rows back together.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = ordering._ranked_parts(copies, ["v"], ties=True).groupBy("_part").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 1000
    assert ordering.with_position(copies, ["v"]).agg(F.countDistinct("position")).first()[0] == 3000


def test_unique_ordering_does_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumn("x", F.md5(F.col("id").cast("string")))
    first = ordering.with_position(df.repartition(3), ["x"], ties=False).collect()
    second = ordering.with_position(df.repartition(11), ["x"], ties=False).collect()
    assert sorted(first) == sorted(second)


def test_row_range_includes_both_ends(spark):
    df = spark.range(100).repartition(5)
    found = ordering.row_range(df, ["id"], 10, 12)
    assert sorted(r.id for r in found.collect()) == [10, 11, 12]
    assert ordering.row_range(df, ["id"], 95).count() == 5
    assert ordering.row_range(df, ["id"], 0, 1000).count() == 100


def test_permutation_is_repeatable(spark):
    df = spark.range(200)
    first = [r.id for r in ordering.shuffled(df.repartition(3), ["id"], 1).collect()]
    again = [r.id for r in ordering.shuffled(df.repartition(9), ["id"], 1).collect()]
    other = [r.id for r in ordering.shuffled(df, ["id"], 2).collect()]
    assert first == again != other
    assert sorted(first) == list(range(200)) != first


def test_no_rows(spark):
    assert ordering.with_position(spark.range(0), ["id"]).count() == 0
