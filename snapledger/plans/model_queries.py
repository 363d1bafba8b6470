"""Training, selection and scoring queries.

The entities are the customers. Their state is what their orders add up to by a given day; the
states of two days are the features, that of the last day gives six targets and a total score.
All of it comes from one pass over the orders. The queries use small grids; the full one is
``modeling.full_grid()``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger import presets
from snapledger.functions import clean
from snapledger.operators import features, modeling, shaping
from snapledger.plans import workload
from snapledger.plans.registry import query, table
from snapledger.session import materialize

KEY, SEED = "o_custkey", 11
TARGETS, LEVELS = presets.TARGETS, presets.LEVELS
_DAYS = {"old": dt.date(1997, 12, 31), "new": dt.date(1999, 12, 31), "last": None}
_SMALL = modeling.Candidate("forest", {"maxDepth": 5, "numTrees": 20, "maxBins": 15})


def customer_table(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer with both earlier states, the targets, the score and the fold."""
    orders = table(spark, folder, "orders")
    price, day = F.col("o_totalprice"), F.to_date("o_orderdate")
    # The level of the latest order: its position in the domain rides along in the version number,
    # so that all aggregates are plain numbers and hash aggregation applies.
    word = clean.level(clean.part(F.col("o_orderpriority"), "-", 1))
    rate = F.array_position(F.array(*map(F.lit, LEVELS)), word) - 1

    def state(name: str, last: dt.date | None) -> list:
        known = day.isNotNull() if last is None else day <= F.lit(last)
        # Sums of cents are exact, so the values do not depend on the order of the rows.
        cents = F.when(known, F.round(price * 100).cast("long"))

        def share(condition) -> Column:
            return F.coalesce(F.sum(F.when(known & condition, 1)), F.lit(0))

        return [
            F.count(F.when(known, 1)).alias(f"{name}_orders"),
            F.coalesce(F.sum(cents) / 100.0, F.lit(0.0)).alias(f"{name}_spent"),
            F.coalesce(F.max(F.when(known, price)), F.lit(0.0)).alias(f"{name}_largest"),
            share(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias(f"{name}_urgent"),
            share(F.col("o_orderstatus") == "F").alias(f"{name}_done"),
            share(price > 250_000).alias(f"{name}_big"),
            F.max(F.when(known, F.col("o_orderkey") * len(LEVELS) + rate)).alias(f"{name}_Att_WR"),
        ]

    states = orders.groupBy(KEY).agg(*[c for n, d in _DAYS.items() for c in state(n, d)])
    measures = ["orders", "spent", "largest", "urgent", "done", "big"]
    scales = [1, 10_000, 5_000, 1, 1, 1]
    targets = {t: F.col(f"last_{m}") / F.lit(float(s)) for t, m, s in zip(TARGETS, measures, scales)}
    overall = F.col("last_spent") / 20_000.0 + F.col("last_largest") / 10_000.0 + F.col("last_urgent") * 2.0
    return features.with_fold(
        states.withColumns(
            targets
            | {presets.OVERALL: overall}
            | {f"{n}_Att_WR": _level_name(F.col(f"{n}_Att_WR")) for n in ("old", "new")}
        ).drop(*[c for c in states.columns if c.startswith("last_")]),
        KEY,
    )


def _level_name(packed: Column) -> Column:
    names = F.array(*map(F.lit, LEVELS))
    return F.coalesce(F.get(names, (packed % len(LEVELS)).cast("int")), F.lit(presets.DEFAULT_LEVEL))


def _inputs(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric and categorical inputs."""
    inputs = shaping.columns_without(df.columns, [KEY, "fold", presets.OVERALL, *TARGETS])
    return [c for c in inputs if not c.endswith("_WR")], [c for c in inputs if c.endswith("_WR")]


def _prepared(spark: SparkSession, folder: str) -> DataFrame:
    customers = customer_table(spark, folder)
    numeric, categorical = _inputs(customers)
    keep = [KEY, "fold", presets.OVERALL, *TARGETS]
    prepared, _ = modeling.prepare(customers, keep, numeric, categorical)
    return prepared


def _train(prepared: DataFrame) -> DataFrame:
    return prepared.filter(F.col("fold") == "train")


def _fit_and_score(spark: SparkSession, folder: str, candidate: modeling.Candidate) -> DataFrame:
    """Fit on the train fold, score everybody."""
    prepared = _prepared(spark, folder)
    model = modeling.fit(_train(prepared), "sho", candidate, SEED)
    return modeling.score({"sho": model}, prepared, rounded=False).select(KEY, "fold", "sho", "sho_pred")


@query()
def train_random_forest(spark: SparkSession, folder: str) -> DataFrame:
    candidate = modeling.Candidate("forest", {"maxDepth": 10, "numTrees": 60, "maxBins": presets.FOREST_BINS})
    return _fit_and_score(spark, folder, candidate)


@query()
def train_gbt(spark: SparkSession, folder: str) -> DataFrame:
    return _fit_and_score(spark, folder, modeling.Candidate("boosted", {"maxIter": 10}))


@query()
def tune_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Validation score of each candidate; ``selected`` marks the one with the lowest error."""
    candidates = [_SMALL, *modeling.forests([10], [20]), *modeling.boosted([2, 5, 10])]
    train = _train(_prepared(spark, folder))
    found = modeling.search(train, KEY, "sho", candidates, SEED, train_ratio=presets.OVERALL_TRAIN_RATIO)
    return modeling.score_table([found], train)


@query()
def predict_multi_target(spark: SparkSession, folder: str) -> DataFrame:
    """A model per target on the same stored features; predictions become columns, without joins."""
    customers = customer_table(spark, folder).drop(presets.OVERALL)
    return workload.predict_attributes(customers, KEY, TARGETS, [_SMALL], SEED).rows


def _stored_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Written once, where several stages need the table, so that the orders are read once."""
    return materialize(customer_table(spark, folder), "customers")


def _actual(customers: DataFrame) -> DataFrame:
    return customers.select(KEY, presets.OVERALL, *TARGETS)


@query()
def predict_cascade(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted attributes of the test fold feed a second model trained on the true ones."""
    customers = _stored_customers(spark, folder)
    first = workload.predict_attributes(customers.drop(presets.OVERALL), KEY, TARGETS, [_SMALL], SEED)
    second = workload.predict_overall(
        first.rows, _actual(customers), KEY, extra=(), candidates=[_SMALL], seed=SEED
    )
    return second.rows


@query()
def score_counterfactual_shift(spark: SparkSession, folder: str) -> DataFrame:
    """How the score of each test customer moves when predictions replace its true attributes."""
    customers = _stored_customers(spark, folder)
    first = workload.predict_attributes(customers.drop(presets.OVERALL), KEY, TARGETS, [_SMALL], SEED)
    return workload.overall_shift(_actual(customers), first.rows, KEY, _SMALL, seed=SEED)
