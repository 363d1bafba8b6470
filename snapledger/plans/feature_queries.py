"""Feature and evaluation queries."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.operators import evaluate, features, shaping, snapshot
from snapledger.plans.registry import query, table

_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) + 0.0 AS {c}" for c in _NUMBERS
    )
    + " FROM lineitem"
)
def feature_zscore(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *_NUMBERS)
    scaled = features.fit_standardizer(lineitem, _NUMBERS).transform(lineitem)
    return scaled.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in _NUMBERS})


_INDEXED = """
    SELECT p_partkey, p_brand, p_type, b.i AS p_brand_indexed, t.i AS p_type_indexed FROM part
    JOIN (SELECT p_brand, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS DOUBLE) AS i
          FROM part GROUP BY 1) b USING (p_brand)
    JOIN (SELECT p_type, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS DOUBLE) AS i
          FROM part GROUP BY 1) t USING (p_type)
"""


@query(_INDEXED)
def feature_string_index(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    for column in ("p_brand", "p_type"):
        part = features.index_by_frequency(part, column, f"{column}_indexed")
    return part.select("p_partkey", "p_brand", "p_type", "p_brand_indexed", "p_type_indexed")


# The closed domain of order priorities.
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "SELECT o_orderkey, "
    + ", ".join(
        f"CAST(o_orderpriority = '{p}' AS INTEGER) AS priority_{i}" for i, p in enumerate(_PRIORITIES)
    )
    + " FROM orders"
)
def feature_one_hot(spark: SparkSession, folder: str) -> DataFrame:
    """The last index is dropped: with the extra index for unknown values it is that one."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    stages = [features.index_stage(["o_orderpriority"], _PRIORITIES), features.one_hot_stage(["o_orderpriority"])]
    encoded = Pipeline(stages=stages).fit(orders).transform(orders)
    names = [f"priority_{i}" for i in range(len(_PRIORITIES))]
    plain = features.vector_columns(encoded.select("o_orderkey", "o_orderpriority_he"), "o_orderpriority_he", names)
    return plain.select("o_orderkey", *[F.col(n).cast("int").alias(n) for n in names])


@query(
    "SELECT o_orderkey, o_totalprice AS f0, CAST(o_custkey AS DOUBLE) AS f1, "
    + ", ".join(
        f"CAST(o_orderpriority = '{p}' AS INTEGER) + CAST(0 AS DOUBLE) AS f{i}"
        for i, p in enumerate(_PRIORITIES, 2)
    )
    + " FROM orders"
)
def feature_assemble(spark: SparkSession, folder: str) -> DataFrame:
    """Numeric columns, then the one-hot columns, as one vector shown element by element."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    stages = features.feature_stages(["o_totalprice", "o_custkey"], ["o_orderpriority"], _PRIORITIES)
    assembled = Pipeline(stages=stages).fit(orders).transform(orders).select("o_orderkey", "feature_cols")
    return features.vector_columns(assembled, "feature_cols", [f"f{i}" for i in range(7)])


@query(
    """
    SELECT o_orderkey, o_custkey,
           CASE WHEN CAST('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 10 < 8
                THEN 'train' ELSE 'test' END AS fold
    FROM orders
    """
)
def split_hash(spark: SparkSession, folder: str) -> DataFrame:
    """All orders of a customer fall into the same fold."""
    return features.with_fold(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_custkey")


_MID, _LATE = dt.date(1997, 12, 31), dt.date(1999, 12, 31)


@query(
    """
    WITH w1 AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
                QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1),
    w2 AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1),
    w3 AS (SELECT o_custkey, count(*) AS target_orders, max(o_totalprice) AS target_price FROM orders
           WHERE o_orderdate >= TIMESTAMP '2000-01-01' GROUP BY 1)
    SELECT w1.o_custkey, w1.o_totalprice AS old_o_totalprice, w1.o_orderpriority AS old_o_orderpriority,
           w2.o_totalprice AS new_o_totalprice, w2.o_orderpriority AS new_o_orderpriority,
           target_orders, target_price
    FROM w1 JOIN w2 USING (o_custkey) JOIN w3 USING (o_custkey)
    """
)
def feature_wide_two_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """The latest order of two periods side by side, with targets from a third, in one pass over the orders."""
    stamp, columns = F.to_date("o_orderdate"), ["o_totalprice", "o_orderpriority"]
    older, newer = stamp <= F.lit(_MID), (stamp > F.lit(_MID)) & (stamp <= F.lit(_LATE))
    after = F.when(stamp > F.lit(_LATE), F.col("o_totalprice"))
    sums = {"target_orders": F.count(after), "target_price": F.max(after)}
    periods = {"old": older, "new": newer}
    orders = table(spark, folder, "orders")
    both = snapshot.latest_per_period(orders, "o_custkey", ["o_orderkey"], columns, sums, **periods)
    known = both.filter(F.col("old").isNotNull() & F.col("new").isNotNull() & (F.col("target_orders") > 0))
    wide = [F.col(f"{p}.{c}").alias(f"{p}_{c}") for p in periods for c in columns]
    return known.select("o_custkey", *wide, *sums)


_SAMPLE_SQL = " + ".join(f"(u >= {limit!r})::INTEGER" for limit in features.poisson_limits(2.5))


@query(
    f"""
    SELECT o_orderkey, o_totalprice FROM (
        SELECT o_orderkey, o_totalprice, unnest(range(0, {_SAMPLE_SQL})) AS i FROM (
            SELECT o_orderkey, o_totalprice,
                   CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|7'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
            FROM orders))
    """
)
def sample_with_replacement(spark: SparkSession, folder: str) -> DataFrame:
    """Each order two and a half times on average."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return features.sample_with_replacement(orders, "o_orderkey", fraction=2.5, seed=7)


@query(
    """
    WITH places AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS place FROM orders),
    draws AS (
        SELECT CAST('0x' || substr(md5(CAST(i AS VARCHAR) || '|7'), 1, 15) AS BIGINT) % (SELECT count(*) FROM orders) AS place
        FROM (SELECT unnest(range((SELECT count(*) FROM orders))) AS i))
    SELECT o_orderkey, o_totalprice FROM places JOIN draws USING (place)
    """
)
def sample_bootstrap(spark: SparkSession, folder: str) -> DataFrame:
    """As many orders as there are, drawn with replacement."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return features.bootstrap(orders, "o_orderkey", seed=7)


def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    """A closed-form prediction of the line price."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_extendedprice").alias("price"),
        (F.col("l_quantity") * 1500).alias("price_pred"),
        (F.col("l_quantity") * 1400 + 2500).alias("other_pred"),
    )


_PREDICTIONS = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_extendedprice AS price,
           l_quantity * 1500 AS price_pred, l_quantity * 1400 + 2500 AS other_pred
    FROM lineitem
"""


@query(
    f"""
    WITH p AS ({_PREDICTIONS})
    SELECT round(sqrt(avg((price - price_pred) * (price - price_pred))), 4) AS rmse,
           round(avg((price - price_pred) * (price - price_pred)), 2) AS mse,
           round(avg(abs(price - price_pred)), 4) AS mae,
           round(1 - avg((price - price_pred) * (price - price_pred)) / var_pop(price), 6) AS r2,
           round(avg((price_pred - m) * (price_pred - m)), 2) AS var
    FROM p, (SELECT avg(price) AS m FROM p)
    """
)
def eval_regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = evaluate.evaluate(_predictions(spark, folder), "price", "price_pred")
    digits = {"rmse": 4, "mse": 2, "mae": 4, "r2": 6, "var": 2}
    return found.select(*[F.round(m, d).alias(m) for m, d in digits.items()])


@query(f"SELECT round(avg(abs(price_pred - other_pred)), 4) AS mean_abs_shift FROM ({_PREDICTIONS})")
def eval_mean_abs_shift(spark: SparkSession, folder: str) -> DataFrame:
    shift = evaluate.mean_abs_shift(_predictions(spark, folder), "price_pred", "other_pred")
    return shift.select(F.round("mean_abs_shift", 4).alias("mean_abs_shift"))


@query(
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, price AS label, price_pred AS prediction,
           price - price_pred AS residual
    FROM ({_PREDICTIONS})
    """
)
def eval_residuals(spark: SparkSession, folder: str) -> DataFrame:
    key = ["l_orderkey", "l_linenumber", "l_partkey"]
    return evaluate.residuals(_predictions(spark, folder), key, "price", "price_pred")


def _bin(axis: str) -> str:
    return f"""least(CAST(floor(({axis} - lo_{axis}) / step_{axis}) AS INTEGER), 99)"""


def _corrected(axis: str) -> str:
    return f"""g_{axis} - CAST({axis} < lo_{axis} + g_{axis} * step_{axis} AS INTEGER)
        + CAST(g_{axis} < 99 AND {axis} >= lo_{axis} + (g_{axis} + 1) * step_{axis} AS INTEGER)"""


@query(
    f"""
    WITH p AS (SELECT price AS x, price_pred AS y FROM ({_PREDICTIONS})),
    s AS (SELECT min(x) AS lo_x, (max(x) - min(x)) / 100 AS step_x,
                 min(y) AS lo_y, (max(y) - min(y)) / 100 AS step_y FROM p),
    g AS (SELECT *, {_bin("x")} AS g_x, {_bin("y")} AS g_y FROM p, s),
    b AS (SELECT *, CAST({_corrected("x")} AS INTEGER) AS bin_x, CAST({_corrected("y")} AS INTEGER) AS bin_y FROM g)
    SELECT bin_x, bin_y, round(min(lo_x + bin_x * step_x), 4) AS from_x,
           round(min(lo_y + bin_y * step_y), 4) AS from_y, count(*) AS n
    FROM b GROUP BY 1, 2
    """
)
def eval_histogram2d(spark: SparkSession, folder: str) -> DataFrame:
    cells = evaluate.histogram2d(_predictions(spark, folder), "price", "price_pred")
    return cells.withColumns({c: F.round(c, 4) for c in ("from_x", "from_y")})


# Slopes of the closed-form candidates.
_SLOPES = [900, 1200, 1500, 1800, 2100, 2400]


@query(
    "SELECT candidate, slope, round(rmse, 4) AS rmse FROM ("
    + " UNION ALL ".join(
        f"SELECT 'k{k}' AS candidate, {k} AS slope,"
        f" sqrt(avg((l_extendedprice - {k} * l_quantity) * (l_extendedprice - {k} * l_quantity))) AS rmse FROM lineitem"
        for k in _SLOPES
    )
    + ") ORDER BY rmse LIMIT 1"
)
def select_best_candidate(spark: SparkSession, folder: str) -> DataFrame:
    """All candidates are scored in one pass over the lines; the lowest error wins."""
    lineitem = table(spark, folder, "lineitem")
    label = F.col("l_extendedprice")
    scores = lineitem.agg(
        *[
            evaluate.regression_metrics(label, F.col("l_quantity") * k)["rmse"].alias(f"k{k}")
            for k in _SLOPES
        ]
    ).unpivot([], [f"k{k}" for k in _SLOPES], "candidate", "rmse")
    slope = F.substring("candidate", 2, 9).cast("int")
    table_of_scores = scores.select("candidate", slope.alias("slope"), "rmse")
    return evaluate.best_candidate(table_of_scores, "rmse").withColumn("rmse", F.round("rmse", 4))
