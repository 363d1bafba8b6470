"""Training, candidate search and scoring with Spark ML."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger import presets
from snapledger.functions.clean import round_half_even
from snapledger.operators import evaluate
from snapledger.operators.features import feature_stages, hash_tenth
from snapledger.session import ensure_checkpoint_dir, materialize, persisted

FEATURES = "feature_cols"
SCORE_SCHEMA = "label string, candidate string, metric string, score double, selected boolean"
_FAMILIES = {"forest": RandomForestRegressor, "boosted": GBTRegressor}
_MODELS = (RandomForestRegressionModel, GBTRegressionModel)
# Keep the node of each row instead of shipping the trees for every level, and put twice the usual
# number of nodes into one pass over the data. The memory is per running task.
_PASSES = {"cacheNodeIds": True, "maxMemoryInMB": 512}


def predicted(label: str) -> str:
    return f"{label}_pred"


@dataclass(frozen=True)
class Candidate:
    """One estimator family with its parameters."""

    family: str
    params: Mapping[str, object] = field(default_factory=dict)

    def estimator(self, label: str, seed: int) -> Estimator:
        kind = _FAMILIES[self.family]
        return kind(
            featuresCol=FEATURES,
            labelCol=label,
            predictionCol=predicted(label),
            seed=seed,
            checkpointInterval=10,
            **(_PASSES | dict(self.params)),
        )

    @property
    def name(self) -> str:
        params = ", ".join(f"{k}={v}" for k, v in self.params.items())
        return f"{_FAMILIES[self.family].__name__}({params})"


def forests(depths: Sequence[int], trees: Sequence[int], bins: int = presets.FOREST_BINS) -> list[Candidate]:
    return [
        Candidate("forest", {"maxDepth": d, "numTrees": n, "maxBins": bins}) for d in depths for n in trees
    ]


def boosted(iterations: Sequence[int]) -> list[Candidate]:
    return [Candidate("boosted", {"maxIter": n}) for n in iterations]


def full_grid() -> list[Candidate]:
    """The eleven candidates of the original search."""
    return forests(presets.FOREST_DEPTHS, presets.FOREST_TREES) + boosted(presets.BOOSTED_ITERATIONS)


def param_grid(estimator: Estimator, values: Mapping[str, Sequence]) -> list[dict]:
    """Parameter maps of an estimator from ``{name: list of values}``."""
    builder = ParamGridBuilder()
    for name, options in values.items():
        if isinstance(options, str) or not isinstance(options, Sequence):
            raise ValueError(f"{name} needs a list of values")
        builder.addGrid(estimator.getParam(name), options)
    return builder.build()


def estimator_label(pipeline: Pipeline | Estimator) -> str:
    """Class names of the estimators of a pipeline joined by ``:``."""
    stages = pipeline.getStages() if isinstance(pipeline, Pipeline) else [pipeline]
    return ":".join(type(s).__name__ for s in stages if isinstance(s, Estimator))


def prepare(
    table: DataFrame,
    keep: Sequence[str],
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    levels: Sequence[str] | None = tuple(presets.LEVELS),
) -> tuple[DataFrame, PipelineModel]:
    """Assemble the features once, store them and return them with the fitted feature stages.

    All targets and candidates train on the stored table: nothing upstream runs again, and the
    rows keep their partitions even when an executor is lost. The rows are dealt to at least
    as many partitions as there are cores, since tree training passes over them many times; by a hash of the key,
    the first of ``keep``, and in its order, so that the random choices of training fall alike however the input was laid out.
    """
    spark = table.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    stages = Pipeline(stages=feature_stages(numeric, categorical, levels, FEATURES)).fit(table)
    dealt = table.repartition(parts, keep[0]).sortWithinPartitions(keep[0])
    assembled = stages.transform(dealt).select(*keep, FEATURES)
    return materialize(assembled, "features"), stages


def fit(train: DataFrame, label: str, candidate: Candidate, seed: int) -> Model:
    ensure_checkpoint_dir(train.sparkSession)
    return candidate.estimator(label, seed).fit(train)


@dataclass(frozen=True)
class StoredModels:
    """Fitted models of several labels with the stages that prepare their inputs.

    ``inputs`` are the names and types of the columns that the stages read, in the order of the training table. A feature vector knows no
    names, so a table is only scored if it has all of them with the same types; their order in the table does not matter.
    """

    stages: PipelineModel
    models: Mapping[str, Model]
    inputs: Sequence[tuple[str, str]]

    @classmethod
    def of(cls, stages: PipelineModel, models: Mapping[str, Model], table: DataFrame) -> StoredModels:
        """The models with the inputs that ``stages`` read from their training table."""
        read = _inputs_of(stages)
        return cls(stages, dict(models), [(n, t) for n, t in table.dtypes if n in read])

    def save(self, spark: SparkSession, path: str) -> None:
        """Write everything below ``path``; the description comes last, so that an unfinished folder does not load."""
        self.stages.write().overwrite().save(f"{path}/stages")
        for label, model in self.models.items():
            model.write().overwrite().save(f"{path}/models/{label}")
        kinds = {label: type(model).__name__ for label, model in self.models.items()}
        described = json.dumps({"inputs": self.inputs, "models": kinds}, sort_keys=True)
        spark.createDataFrame([(described,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/description")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> StoredModels:
        """What :meth:`save` wrote. Stages that read other columns than the description says are an error."""
        described = json.loads(spark.read.text(f"{path}/description").first()[0])
        stages = PipelineModel.load(f"{path}/stages")
        inputs = [tuple(x) for x in described["inputs"]]
        if _inputs_of(stages) != {n for n, _ in inputs}:
            raise ValueError(f"the stages in {path} do not read the columns of its description")
        known = {c.__name__: c for c in _MODELS}
        models = {label: known[kind].load(f"{path}/models/{label}") for label, kind in described["models"].items()}
        widths = {model.numFeatures for model in models.values()}
        if len(widths) > 1:
            raise ValueError(f"the models in {path} learnt from vectors of different lengths: {sorted(widths)}")
        return cls(stages, models, inputs)

    def check(self, table: DataFrame) -> None:
        """Raise unless the table has every input, with the type that it had in training."""
        kinds = dict(table.dtypes)
        missing = [n for n, _ in self.inputs if n not in kinds]
        if missing:
            raise ValueError(f"no column {', '.join(missing)}")
        other = [f"{n} is {kinds[n]}, was {t}" for n, t in self.inputs if kinds[n] != t]
        if other:
            raise ValueError("; ".join(other))

    def score(self, table: DataFrame, keep: Sequence[str], rounded: bool = False) -> DataFrame:
        """``keep`` and ``<label>_pred`` of every model for all rows of the table."""
        self.check(table)
        prepared = self.stages.transform(table).select(*keep, FEATURES)
        return score(self.models, prepared, rounded).drop(FEATURES)


def _inputs_of(stages: PipelineModel) -> set[str]:
    """The columns that fitted stages read but do not make themselves."""
    read: set[str] = set()
    made: set[str] = set()
    for stage in stages.stages:
        for name in ("inputCols", "inputCol", "outputCols", "outputCol"):
            if stage.hasParam(name) and stage.isSet(name):
                value = stage.getOrDefault(name)
                (read if name.startswith("input") else made).update([value] if isinstance(value, str) else value)
    return read - made


@dataclass(frozen=True)
class Search:
    """The chosen model of one label and the validation score of every candidate.

    A lone candidate is not validated and has no score.
    """

    label: str
    model: Model
    candidates: Sequence[Candidate]
    scores: Sequence[float | None]
    metric: str

    @property
    def best(self) -> int:
        return best_score(self.scores, self.metric)

    def rows(self) -> list[tuple]:
        return [
            (self.label, c.name, self.metric, s, i == self.best)
            for i, (c, s) in enumerate(zip(self.candidates, self.scores))
        ]


def best_score(scores: Sequence[float | None], metric: str) -> int:
    """Place of the lowest error, or of the highest value for metrics like ``r2``."""
    if len(scores) == 1:
        return 0
    choose = max if metric in evaluate.LARGER_IS_BETTER else min
    return choose(range(len(scores)), key=lambda i: scores[i])


# Metrics that a boosted model reports for each of its iterations in one pass, by their loss.
_LOSSES = {"rmse": "squared", "mse": "squared", "mae": "absolute"}


def _groups(candidates: Sequence[Candidate], metric: str) -> list[list[int]]:
    """Candidates that one fit can validate.

    Boosting adds tree after tree, so a model of 200 iterations contains those of 10, 50, 100
    and 150: candidates that differ in nothing else need only the longest one.
    """
    groups: dict = {}
    for i, c in enumerate(candidates):
        others = tuple(sorted((k, str(v)) for k, v in c.params.items() if k != "maxIter"))
        shared = c.family == "boosted" and metric in _LOSSES and "maxIter" in c.params
        groups.setdefault(others if shared else i, []).append(i)
    return list(groups.values())


def _validate(
    learn: DataFrame, check: DataFrame, label: str, group: Sequence[Candidate], seed: int, metric: str
) -> list[float]:
    if len(group) == 1:
        scored = fit(learn, label, group[0], seed).transform(check)
        evaluator = RegressionEvaluator(labelCol=label, predictionCol=predicted(label), metricName=metric)
        return [float(evaluator.evaluate(scored))]
    longest = max(group, key=lambda c: c.params["maxIter"])
    losses = fit(learn, label, longest, seed).evaluateEachIteration(check, _LOSSES[metric])
    at = [losses[c.params["maxIter"] - 1] for c in group]
    return [math.sqrt(v) for v in at] if metric == "rmse" else list(at)


def search_targets(
    train: DataFrame,
    key: str,
    labels: Sequence[str],
    candidates: Sequence[Candidate],
    seed: int,
    train_ratio: float = presets.ATTRIBUTE_TRAIN_RATIO,
    metric: str = "rmse",
    parallelism: int = 4,
) -> dict[str, Search]:
    """A train/validation search per label; each winner is fitted on all of ``train``.

    The validation rows are ``1 - train_ratio`` of ten hash classes of the key, the same for all
    labels and candidates, and both parts are cached once for all of them. Rows outside ``train``
    take no part in the choice, so they can measure the chosen model. ``parallelism`` fits run at
    a time.
    """
    ensure_checkpoint_dir(train.sparkSession)
    learns = hash_tenth(key, seed) < round(train_ratio * 10)
    scores = {label: [None] * len(candidates) for label in labels}
    pool = ThreadPool(parallelism)
    run = inheritable_thread_target(train.sparkSession)
    try:
        if len(candidates) > 1:
            with persisted(train.filter(learns)) as learn, persisted(train.filter(~learns)) as check:
                # Boosting goes one tree at a time and takes longest, so it starts first.
                groups = sorted(_groups(candidates, metric), key=lambda g: candidates[g[0]].family != "boosted")
                tasks = [(label, group) for group in groups for label in labels]

                def validate(task: tuple) -> list[float]:
                    label, group = task
                    return _validate(learn, check, label, [candidates[i] for i in group], seed, metric)

                for (label, group), found in zip(tasks, pool.map(run(validate), tasks, chunksize=1)):
                    for i, value in zip(group, found):
                        scores[label][i] = value

        def winner(label: str) -> Model:
            return fit(train, label, candidates[best_score(scores[label], metric)], seed)

        models = pool.map(run(winner), labels, chunksize=1)
    finally:
        pool.close()
    return {t: Search(t, model, list(candidates), scores[t], metric) for t, model in zip(labels, models)}


def search(
    train: DataFrame, key: str, label: str, candidates: Sequence[Candidate], seed: int, **options
) -> Search:
    """:func:`search_targets` for one label."""
    return search_targets(train, key, [label], candidates, seed, **options)[label]


def score_table(searches: Sequence[Search], df: DataFrame) -> DataFrame:
    """One row per label and candidate."""
    rows = [row for found in searches for row in found.rows()]
    return df.sparkSession.createDataFrame(rows, SCORE_SCHEMA)


def score(models: Mapping[str, Model], prepared: DataFrame, rounded: bool = True) -> DataFrame:
    """Append ``<label>_pred`` for every model; no join is needed to bring them together."""
    scored = prepared
    for model in models.values():
        scored = model.transform(scored)
    if rounded:
        scored = scored.withColumns(
            {predicted(label): round_half_even(F.col(predicted(label))) for label in models}
        )
    return scored


def with_predicted_inputs(scored: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Let the predictions take the place of the true attributes, kept as ``<t>_true``."""
    renames = {t: f"{t}_true" for t in targets} | {predicted(t): t for t in targets}
    return scored.withColumnsRenamed(renames)


def counterfactual(
    stages: PipelineModel,
    model: Model,
    table: DataFrame,
    keep: Sequence[str],
    replacements: Mapping[str, Column],
    label: str,
) -> DataFrame:
    """Score every row as it is and with replaced inputs: ``base_pred, shifted_pred, abs_shift``."""

    def scored(df: DataFrame, name: str) -> DataFrame:
        extra = [c for c in df.columns if c not in table.columns]
        result = model.transform(stages.transform(df))
        return result.select(*table.columns, *extra, F.col(predicted(label)).alias(name))

    both = scored(scored(table, "base_pred").withColumns(dict(replacements)), "shifted_pred")
    return both.select(
        *keep, "base_pred", "shifted_pred", F.abs(F.col("base_pred") - F.col("shifted_pred")).alias("abs_shift")
    )
