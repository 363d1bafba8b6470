import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from snapledger.operators import reconcile, shaping, skew, snapshot
from tests.conftest import rows

HISTORY = [
    (10, 1, dt.datetime(2015, 1, 1, 8), "before"),
    (11, 1, dt.datetime(2015, 9, 1, 8), "inside"),
    (13, 1, dt.datetime(2016, 2, 1, 23), "last day"),
    (12, 1, dt.datetime(2015, 8, 1, 0), "first day"),
    (14, 1, dt.datetime(2016, 2, 2, 0), "after"),
    (20, 2, dt.datetime(2014, 1, 1, 8), "only before"),
    (21, 2, None, "no date"),
]
FIRST, LAST = dt.date(2015, 8, 1), dt.date(2016, 2, 1)


@pytest.fixture
def history(spark):
    return spark.createDataFrame(HISTORY, "id int, k int, day timestamp_ntz, text string")


def test_latest_in_window(history):
    found = snapshot.latest_in_window(history, "k", ["id"], "day", FIRST, LAST)
    assert found.columns == history.columns
    assert [r.text for r in found.collect()] == ["last day"]


def test_latest_with_fallback(history):
    found = snapshot.latest_with_fallback(history, "k", ["id"], "day", FIRST, LAST)
    assert rows(found.select("k", "text", "origin")) == [(1, "last day", "window"), (2, "no date", "fallback")]


def test_latest_breaks_ties_by_content(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z")], "k int, o int, v string")
    for parts in (1, 2, 3):
        assert rows(snapshot.latest_per_key(df.repartition(parts), "k", ["o"])) == [(1, 5, "b")]


def test_window_with_open_ends(history):
    assert shaping.in_window(history, "day", last=dt.date(2015, 8, 1)).count() == 3
    assert shaping.in_window(history, "day", first=dt.date(2016, 2, 2)).count() == 1


@pytest.fixture
def tables(spark):
    rnd = random.Random(3)
    left = [(None if rnd.random() < 0.05 else rnd.choice([7] * 10 + list(range(20))), i) for i in range(300)]
    right = [(None if rnd.random() < 0.05 else rnd.choice([7] * 5 + list(range(10, 30))), i) for i in range(40)]
    return (
        spark.createDataFrame(left, "k int, l int").repartition(5),
        spark.createDataFrame(right, "k int, r int").repartition(3),
    )


@pytest.mark.parametrize("present", [True, False])
@pytest.mark.parametrize("share", [0.01, 0.2, 1.1])
def test_split_filter_equals_plain_join(tables, present, share):
    left, right = tables
    # The hot key 7 once among the other side's keys and once not.
    for other in (right, right.filter("k <> 7")):
        found = skew.split_filter(left, other, "k", present, share)
        assert rows(found) == rows(left.join(other, "k", "left_semi" if present else "left_anti"))


def test_hot_keys_are_bounded(tables):
    left, _ = tables
    assert [r.k for r in skew.hot_keys(left, "k", 0.2).collect()] == [7]
    assert skew.hot_keys(left, "k", 0.01).count() <= 100


def test_semi_and_anti_make_the_whole(tables):
    left, right = tables
    present = reconcile.present_in(left, right, "k")
    missing = reconcile.missing_in(left, right, "k")
    assert rows(present.unionByName(missing)) == rows(left)
    assert rows(missing) == rows(reconcile.missing_dimension(left, right, "k"))


def test_key_of_another_name(tables):
    left, right = tables
    renamed = right.withColumnRenamed("k", "other")
    assert rows(reconcile.present_in(left, renamed, "k", "other")) == rows(reconcile.present_in(left, right, "k"))


def test_cardinality_finds_what_equal_totals_hide(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(2,), (2,)], "k int")
    row = reconcile.join_cardinality(left, right, "k").first()
    assert tuple(row) == (2, 2, 1, 1)
    with pytest.raises(ValueError):
        reconcile.require_one_to_one(left, right, "k")
    with pytest.raises(ValueError):
        reconcile.require_one_to_one(right.limit(1), right, "k")
    reconcile.require_one_to_one(right, left, "k")


def test_cardinality_against_joins(tables):
    left, right = tables
    row = reconcile.join_cardinality(left, right, "k").first()
    assert row.rows_before == left.count()
    assert row.rows_after == left.join(right, "k").count()
    assert row.unmatched_left_rows == left.join(right, "k", "left_anti").count()
    repeated = right.filter("k IS NOT NULL").groupBy("k").count().filter("count > 1")
    assert row.duplicated_right_keys == repeated.count()


def test_audit_against_joins(spark, tables):
    asked, old = tables
    dimension = spark.createDataFrame([(7,), (7,), (12,), (None,)], "k int").withColumn("d", F.lit(1))
    found = {r.step: r.rows for r in reconcile.coverage_audit(asked, old, dimension, "k").collect()}
    imported = asked.join(old, "k", "left")
    both = imported.filter("r IS NOT NULL")
    with_dimension = both.join(dimension, "k", "left")
    assert found == {
        "requested": asked.count(),
        "imported": imported.count(),
        "only_newer": imported.filter("r IS NULL").count(),
        "in_both": both.count(),
        "with_dimension": with_dimension.count(),
        "missing_dimension": with_dimension.filter("d IS NULL").count(),
    }


def test_audit_of_nothing(spark):
    empty = spark.createDataFrame([], "k int")
    assert all(r.rows == 0 for r in reconcile.coverage_audit(empty, empty, empty, "k").collect())


def test_append_rows_keeps_types(spark):
    df = spark.createDataFrame([(1, "a")], "k bigint, n string")
    found = reconcile.append_rows(df, [{"n": "b", "k": -1}])
    assert found.dtypes == df.dtypes and rows(found) == [(-1, "b"), (1, "a")]


def test_union_aligned_matches_names(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 9, 2)], "v string, extra int, k int")
    assert rows(shaping.union_aligned(a, b)) == [(1, "x"), (2, "y")]


def test_reconcile(spark):
    newer = spark.createDataFrame([(1, "n1", 5), (2, "n2", 6), (None, "n0", 7)], "k int, name string, v int")
    old = spark.createDataFrame([(1, 50), (3, 70)], "k int, v int")
    dimension = spark.createDataFrame([(1, "d1")], "k int, name string")
    found = reconcile.reconcile(newer, old, dimension, "k", origin="origin")
    assert rows(found.select("k", "v", "name", "origin")) == [(1, 50, "d1", "window"), (2, 6, "n2", "fallback")]


def test_fold_and_duplicates(spark):
    tables = [spark.createDataFrame([(1, i), (i, i)], f"k int, v{i} int") for i in (2, 3, 4)]
    assert rows(reconcile.fold_join(tables, "k")) == [(1, 2, 3, 4)]
    df = spark.createDataFrame([(1,), (1,), (2,), (2,), (2,), (3,)], "k int")
    assert [tuple(r) for r in reconcile.duplicate_keys(df, ["k"]).collect()] == [(2, 3), (1, 2)]


def test_shaping(spark):
    df = spark.createDataFrame([("1", "x", "2.5")], "a string, b_pred string, c string")
    assert shaping.rename_by_table(df, {"a": "A", "zz": "Z"}).columns == ["A", "b_pred", "c"]
    assert shaping.prefix_except(df, "p_", ["a"]).columns == ["a", "p_b_pred", "p_c"]
    assert shaping.strip_suffix(df, "_pred").columns == ["a", "b", "c"]
    assert tuple(shaping.cast_all(df, exclude=["b_pred"]).first()) == (1, "x", None)
    assert shaping.columns_without(["c", "a", "b"], ["a"], ["z"]) == ["c", "b", "z"]


def test_counts_in_passing(spark, tmp_path):
    """The rows are those of the plain operator; the counts equal the audit and cost no pass of their own."""
    newer = spark.range(1, 60).select(F.col("id").alias("k"), F.lit("n").alias("v"), F.lit("d").alias("w"))
    old = spark.range(40, 90).select(F.col("id").alias("k"), F.lit("o").alias("v"))
    dim = spark.range(50, 55).select(F.col("id").alias("k"), F.lit("known").alias("w"))
    found, seen = reconcile.reconcile_counted(newer, old, dim, "k")
    found.write.parquet(f"{tmp_path}/rows")
    assert rows(spark.read.parquet(f"{tmp_path}/rows")) == rows(reconcile.reconcile(newer, old, dim, "k"))
    assert seen.get == {"only_newer": 39, "in_both": 20, "missing_dimension": 15}
    assert rows(reconcile.audit_of_counts(spark, seen.get)) == rows(reconcile.coverage_audit(newer, old, dim, "k"))
    none, empty = reconcile.counted(newer.limit(0), some=F.col("k") > 3)
    none.collect()
    assert empty.get == {"some": 0}
