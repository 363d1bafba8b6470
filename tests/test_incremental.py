import random

import pytest
from pyspark.sql import functions as F

from snapledger.operators.incremental import LatestTable
from snapledger.operators.snapshot import latest_per_key
from tests.conftest import rows

SCHEMA = "k long, version long, v string"


def _versions(seed, keys, n):
    r = random.Random(seed)
    return [(r.choice([*range(keys), None]), r.randrange(50), r.choice(["a", "b", None])) for _ in range(n)]


def test_merges_equal_a_full_pass(spark, tmp_path):
    """Whatever comes in which merge, late, twice, or not at all."""
    days = [_versions(s, 40 + 20 * s, 60) for s in range(4)]
    everything = spark.createDataFrame([v for day in days for v in day], SCHEMA).filter("k IS NOT NULL")
    expected = rows(latest_per_key(everything, "k", ["version"]))
    for number, order in enumerate(([0, 1, 2, 3], [3, 1, 0, 2], [2, 2, 3, 0, 1, 3])):
        first, *rest = order
        table = LatestTable.create(spark.createDataFrame(days[first], SCHEMA), f"{tmp_path}/{number}", "k", ["version"], 5)
        for day in rest:
            table = table.merge(spark.createDataFrame(days[day], SCHEMA))
        assert rows(table.read(spark)) == expected and table.version == len(rest)
        again = LatestTable.open(spark, f"{tmp_path}/{number}", "k", ["version"], 5)
        assert again.version == table.version and rows(again.read(spark)) == expected
        assert rows(table.merge(spark.createDataFrame([], SCHEMA)).read(spark)) == expected
    empty = LatestTable.create(spark.createDataFrame([], SCHEMA), f"{tmp_path}/e", "k", ["version"], 5)
    assert empty.read(spark).isEmpty()
    assert rows(empty.merge(everything).read(spark)) == expected
    with pytest.raises(ValueError):
        LatestTable.open(spark, str(tmp_path), "k", ["version"], 5)


def test_stored_rows_are_not_shuffled(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = spark.range(50_000).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("version"), F.lit("x").alias("v"))
        table = LatestTable.create(large, f"{tmp_path}/t", "k", ["version"], 16)
        day = spark.createDataFrame([(7, 2, "y"), (60_000, 1, "z")], SCHEMA)
        merged = table.merged(day)
        merged.collect()
        plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    column = lines[join + 1].index(":-")
    other = next(i for i, line in enumerate(lines) if i > join and line[column : column + 2] == "+-")
    stored = "\n".join(lines[join + 1 : other])
    assert "Bucketed: true" in stored and "Exchange" not in stored and "Exchange" in plan
    after = table.merge(day)
    found = {r.k: r.v for r in after.read(spark).filter("k IN (7, 8, 60000)").collect()}
    assert found == {7: "y", 8: "x", 60_000: "z"}
    files = spark.read.parquet(after.path).inputFiles()
    assert len(files) <= 16
