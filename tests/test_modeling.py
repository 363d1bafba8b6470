import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from snapledger.operators import evaluate, features, modeling
from tests.conftest import rows


@pytest.fixture(scope="module")
def prepared(spark):
    rnd = random.Random(4)
    levels = ["high", "medium", "low"]
    data = []
    for i in range(400):
        a, b, level = rnd.uniform(0, 10), rnd.uniform(0, 10), rnd.choice(levels)
        data.append((i, a, b, level, 3 * a + b + levels.index(level), a - b))
    df = features.with_fold(spark.createDataFrame(data, "k int, a double, b double, r string, y double, z double"), "k")
    return df, *modeling.prepare(df, ["k", "y", "z", "fold"], ["a", "b"], ["r"])


SMALL = [
    modeling.Candidate("forest", {"maxDepth": 1, "numTrees": 2}),
    modeling.Candidate("forest", {"maxDepth": 6, "numTrees": 10}),
    modeling.Candidate("boosted", {"maxIter": 3}),
]


def fold(df, name):
    return df.filter(F.col("fold") == name)


def test_full_grid():
    names = [c.name for c in modeling.full_grid()]
    assert len(names) == len(set(names)) == 11
    forest, boosted = modeling.full_grid()[0], modeling.full_grid()[-1]
    assert (forest.params["maxDepth"], forest.params["numTrees"], forest.params["maxBins"]) == (10, 60, 15)
    assert boosted.params == {"maxIter": 200}


def test_param_grid(spark):
    forest = RandomForestRegressor()
    assert len(modeling.param_grid(forest, {"maxDepth": [1, 2], "numTrees": [3, 4, 5]})) == 6
    with pytest.raises(ValueError):
        modeling.param_grid(forest, {"maxDepth": 3})


def test_estimator_label(spark):
    assert modeling.estimator_label(GBTRegressor()) == "GBTRegressor"
    pipeline = Pipeline(stages=features.feature_stages(["a"], ["r"]) + [RandomForestRegressor()])
    assert modeling.estimator_label(pipeline) == "OneHotEncoder:RandomForestRegressor"


@pytest.mark.parametrize("candidate", SMALL[1:], ids=lambda c: c.family)
def test_models_beat_the_mean(prepared, candidate):
    _, stored, _ = prepared
    model = modeling.fit(fold(stored, "train"), "y", candidate, 1)
    scored = modeling.score({"y": model}, fold(stored, "test"), rounded=False)
    found = evaluate.evaluate(scored, "y", "y_pred").first()
    assert found.r2 > 0.5


def test_search_takes_the_lowest_error(prepared):
    df, stored, _ = prepared
    train = fold(stored, "train")
    found = modeling.search(train, "k", "y", SMALL, seed=1)
    assert found.best == min(range(3), key=lambda i: found.scores[i]) != 0
    again = modeling.search(train, "k", "y", SMALL, seed=1, parallelism=1)
    assert again.scores == pytest.approx(found.scores)
    table = modeling.score_table([found], df)
    best = evaluate.best_candidate(table.select("candidate", "score"), "score").first()
    assert best.candidate == table.filter("selected").first().candidate == SMALL[found.best].name
    # The winner is the one that scores.
    expected = "GBT" if SMALL[found.best].family == "boosted" else "RandomForest"
    assert type(found.model).__name__.startswith(expected)


def test_groups():
    other = modeling.Candidate("boosted", {"maxIter": 2, "maxDepth": 2})
    candidates = [SMALL[1], *modeling.boosted([4, 1, 7]), other]
    assert modeling._groups(candidates, "rmse") == [[0], [1, 2, 3], [4]]
    assert modeling._groups(candidates, "r2") == [[0], [1], [2], [3], [4]]
    assert len(modeling._groups(modeling.full_grid(), "rmse")) == 7


@pytest.mark.parametrize("metric", ["rmse", "mae"])
def test_one_boosted_fit_validates_its_shorter_versions(prepared, metric):
    _, stored, _ = prepared
    learn, check = fold(stored, "train"), fold(stored, "test")
    group = modeling.boosted([4, 1, 7])
    alone = [modeling._validate(learn, check, "y", [c], 1, metric)[0] for c in group]
    assert modeling._validate(learn, check, "y", group, 1, metric) == pytest.approx(alone)


def test_validation_rows_do_not_depend_on_partitions(prepared):
    _, stored, _ = prepared
    candidates = [modeling.Candidate("boosted", {"maxIter": n, "maxDepth": 2}) for n in (1, 3)]
    scores = [
        modeling.search(fold(stored, "train").repartition(parts, "k"), "k", "y", candidates, seed=1).scores
        for parts in (1, 1, 5)
    ]
    assert scores[0] == pytest.approx(scores[1]) and scores[0] == pytest.approx(scores[2], rel=0.2)


def test_search_takes_the_highest_r2(prepared):
    _, stored, _ = prepared
    found = modeling.search(fold(stored, "train"), "k", "y", SMALL[:2], seed=1, metric="r2")
    assert found.best == max(range(2), key=lambda i: found.scores[i]) == 1


def test_targets_share_the_stored_table(prepared):
    _, stored, _ = prepared
    found = modeling.search_targets(fold(stored, "train"), "k", ["y", "z"], SMALL[1:2], seed=1)
    assert found["y"].scores == [None] and found["y"].best == 0
    scored = modeling.score({t: s.model for t, s in found.items()}, stored)
    assert dict(scored.dtypes)["y_pred"] == dict(scored.dtypes)["z_pred"] == "int"
    assert scored.count() == 400
    swapped = modeling.with_predicted_inputs(scored, ["y", "z"])
    assert {"y", "z", "y_true", "z_true"} <= set(swapped.columns)
    assert rows(swapped.select("k", "y")) == rows(scored.select("k", "y_pred"))


def test_counterfactual(prepared):
    df, stored, stages = prepared
    model = modeling.fit(fold(stored, "train"), "y", SMALL[1], 1)
    same = modeling.counterfactual(stages, model, df, ["k"], {"a": F.col("a")}, "y")
    assert same.columns == ["k", "base_pred", "shifted_pred", "abs_shift"]
    assert same.agg(F.max("abs_shift")).first()[0] == 0.0
    moved = modeling.counterfactual(stages, model, df, ["k"], {"a": F.col("a") + 5}, "y")
    assert moved.count() == 400 and moved.agg(F.avg("abs_shift")).first()[0] > 1.0
    plain = modeling.score({"y": model}, stored, rounded=False)
    assert rows(moved.select("k", "base_pred")) == rows(plain.select("k", "y_pred"))
