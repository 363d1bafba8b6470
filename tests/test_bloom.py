import pytest
from pyspark.sql import functions as F

from snapledger.operators import bloom, reconcile, skew
from snapledger.plans import reconcile_queries
from tests.conftest import rows


@pytest.mark.parametrize("n", [0, 1, 50, 20_000])
def test_same_rows_as_the_plain_joins(spark, n):
    facts = spark.range(30_000).select(F.when(F.col("id") % 10 != 0, F.col("id") * 7 % 100_003).alias("k"), "id")
    keys = spark.range(n).select((F.col("id") * 3).alias("other")).union(spark.createDataFrame([(None,), (21,), (21,)], "other long"))
    assert rows(bloom.present_filtered(facts, keys, "k", "other")) == rows(reconcile.present_in(facts, keys, "k", "other"))
    assert rows(bloom.missing_filtered(facts, keys, "k", "other")) == rows(reconcile.missing_in(facts, keys, "k", "other"))
    names = facts.select(F.col("k").cast("string").alias("k"), "id")
    texts = keys.select(F.col("other").cast("string").alias("k"))
    assert rows(bloom.present_filtered(names, texts, "k")) == rows(reconcile.present_in(names, texts, "k"))


def test_few_are_let_through_wrongly(spark):
    """No key is lost, and of others about one in a hundred passes."""
    keys = spark.range(20_000).withColumnRenamed("id", "k")
    found = bloom.KeyFilter.build(keys, "k")
    assert keys.filter(~found.might_contain(F.col("k"))).isEmpty()
    others = spark.range(1_000_000, 1_100_000)
    assert others.filter(found.might_contain(F.col("id"))).count() < 2_000
    assert bloom.KeyFilter.build(keys, "k", max_words=64) is None


def test_the_fact_is_read_once_and_thinned_out_at_the_scan(spark, tables):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = reconcile_queries.join_semi_filtered(spark, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    assert sum("FileScan" in line and "lineitem.parquet" in line for line in lines) == 1
    # The filter stands right below the exchange of the fact rows.
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(l_orderkey" in line)
    assert "Filter" in lines[exchange + 1] and "shiftleft" in lines[exchange + 1] and "ubquery" in lines[exchange + 1]


def test_frequent_keys(spark):
    """Found without a shuffle by key, whatever else there is; counts are upper bounds with a stated error."""
    df = spark.range(200_000).select(F.when(F.col("id") % 4 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") + 100).alias("k"))
    (row,) = skew.frequent_keys(df, "k", 0.2, tracked=1000).collect()
    assert row.k == 7 and 50_000 <= row.rows <= 50_000 + 4 / 1000 * 200_000
    plan = skew.frequent_keys(df, "k", 0.2)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SinglePartition" in plan
    assert skew.frequent_keys(df.limit(0), "k", 0.2).collect() == []
    nulls = df.select(F.lit(None).cast("long").alias("k"))
    assert skew.frequent_keys(nulls, "k", 0.2).collect() == []
    with pytest.raises(ValueError):
        skew.frequent_keys(df, "k", 0.001, tracked=100)
