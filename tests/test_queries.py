"""Every registered query: same rows as its SQL, and a plan that holds at scale."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from snapledger.plans import model_queries, registry

QUERIES, ORACLES = registry.QUERIES, registry.ORACLES
NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}
MODELS = {n for n, f in QUERIES.items() if f.__module__ == model_queries.__name__}


@pytest.fixture(scope="module")
def database(tables):
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    return connection


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == MODELS


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, tables, database, name):
    df = QUERIES[name](spark, tables)
    columns = sorted(df.columns)
    cursor = database.execute(ORACLES[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    order = [list(described).index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == described
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == expected
    assert expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODELS))
def test_plan(spark, tables, name):
    df = QUERIES[name](spark, tables)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in plan
    # The only windows are those over the part sizes of a numbering.
    assert "Window [" not in plan or "position" in df.columns or name in {"feature_string_index", "sample_bootstrap"}


def test_window_filter_reaches_the_scan(spark, tables):
    plan = QUERIES["snapshot_latest_in_window"](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_hot_key_of_two_plain_scans_is_split(spark, tmp_path):
    hot = F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000)
    priced = {"o_totalprice": F.col("id") * 1.0, "o_custkey": hot.cast("bigint")}
    orders = spark.range(0, 200_000, 1, 16).withColumns(priced).withColumnRenamed("id", "o_orderkey")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    names = {"c_name": F.lit("n"), "c_mktsegment": F.lit("s")}
    spark.range(1000).withColumnRenamed("id", "c_custkey").withColumns(names).write.parquet(
        f"{tmp_path}/customer.parquet"
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = QUERIES["join_inner_using"](spark, str(tmp_path))
        assert len(df.collect()) == 200_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["join_left_using", "reconcile_fallback_rows", "feature_wide_two_snapshots", "reconcile_missing_dimension"]
)
def test_the_fact_is_read_once(spark, tables, name):
    """And, where nothing is hot, a filter by a dimension reads rows without a key apart."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scans = [line for line in plan.splitlines() if "orders.parquet" in line and "FileScan" in line]
    nulls_only = [line for line in scans if "IsNull(o_custkey)" in line]
    assert len(scans) - len(nulls_only) == 1


def test_only_wanted_columns_of_the_latest_version_are_read(spark, tables):
    plan = QUERIES["join_left_using"](spark, tables)._jdf.queryExecution().executedPlan().toString()
    (scan,) = [line for line in plan.splitlines() if "orders.parquet" in line and "FileScan" in line]
    assert "o_orderpriority" not in scan and "o_orderstatus" not in scan


def test_narrow_reads(spark, tables):
    plan = QUERIES["agg_group_max"](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and {"origin", "o_custkey"} <= set(df.columns)


@pytest.mark.parametrize("name", sorted(MODELS))
def test_model_queries(spark, tables, name):
    df = QUERIES[name](spark, tables)
    found = df.collect()
    assert found and not any(v is None for r in found for v in r)
    if name == "tune_candidates":
        assert min(found, key=lambda r: r.score).selected and sum(r.selected for r in found) == 1


def test_model_queries_repeat(spark, tables):
    first, second = (QUERIES["predict_multi_target"](spark, tables).collect() for _ in range(2))
    assert sorted(first) == sorted(second)


def test_customer_states(spark, tables, database):
    """The one-pass training table against SQL."""
    expected = database.execute(
        """
        SELECT o_custkey, count(*), round(sum(o_totalprice), 2), max(o_totalprice),
               CASE WHEN max_by(o_orderpriority, o_orderkey) IN ('2-HIGH', '3-MEDIUM', '5-LOW')
                    THEN lower(split_part(max_by(o_orderpriority, o_orderkey), '-', 2)) ELSE 'medium' END
        FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1
        """
    ).fetchall()
    states = model_queries.customer_table(spark, tables)
    assert states.count() == database.execute("SELECT count(DISTINCT o_custkey) FROM orders").fetchall()[0][0]
    found = {
        r.o_custkey: (r.new_orders, round(r.new_spent, 2), r.new_largest, r.new_Att_WR) for r in states.collect()
    }
    for key, *values in expected:
        assert found[key] == tuple(values)
