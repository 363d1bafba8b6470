"""The yearly player workload end to end, from raw tables to predictions.

Every step is a DataFrame -> DataFrame function; nothing runs before a sink but model
fitting, its statistics and the stored feature table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from snapledger import presets
from snapledger.functions import clean
from snapledger.operators import evaluate, features, modeling, reconcile, shaping, snapshot
from snapledger.session import materialize

TEXT_COLUMNS = ("Name", "Work_Rate")


def club_roster(
    players: DataFrame,
    names: DataFrame,
    key: str,
    clubs: Sequence[str] = tuple(presets.CLUBS),
    check: bool = True,
) -> DataFrame:
    """Players of the wanted clubs with the id taken from their page URL.

    The name join must neither lose nor repeat a player, else this raises.
    """
    wanted = shaping.in_list(players, "Club", clubs).drop(*presets.CLUB_FILE_UNUSED)
    if check:
        reconcile.require_one_to_one(wanted, names, "Name")
    found = reconcile.matched(wanted, names, "Name")
    return found.withColumn(key, clean.url_segment(F.col("url"))).drop("url")


def useful_rows(newest: DataFrame, keys: DataFrame, keys_name: str, key: str = "ID") -> DataFrame:
    """The useful columns of the entities in a key list."""
    return reconcile.present_in(newest.select(*presets.USEFUL_COLUMNS), keys, key, keys_name)


def ages_from_short_birthdays(people: DataFrame, now: dt.date) -> DataFrame:
    """Birthdays written ``MMDDYY`` as dates, with the whole years at ``now``."""
    birthday = clean.two_digit_birthday(F.col("birthday"), now)
    return people.withColumn("birthday", birthday).withColumn("age", clean.age_at(F.col("birthday"), now))


@dataclass(frozen=True)
class SnapshotTables:
    """Parts of the yearly snapshot, all in the newer file's column names."""

    snapshot: DataFrame
    dimension: DataFrame
    newer: DataFrame


def snapshot_tables(
    history: DataFrame,
    dimension: DataFrame,
    newer: DataFrame,
    key: str,
    patches: Sequence[Mapping[str, Any]] = (),
    first: dt.date = presets.WINDOW_START,
    last: dt.date = presets.WINDOW_END,
    as_of: dt.date = presets.AGE_AS_OF,
) -> SnapshotTables:
    """Latest versions in the window, the dimension with ages, and the newer file.

    Heights become centimetres and weights pounds on all sides before any union.
    """
    people = reconcile.append_rows(dimension, patches) if patches else dimension
    birthday = clean.timestamp_text_to_date(F.col("birthday"))
    people = people.withColumn("Age", clean.age_at(birthday, as_of)).drop(*presets.DIMENSION_UNUSED)

    rates = clean.combine_pair(F.col("attacking_work_rate"), F.col("defensive_work_rate"))
    versions = (
        history.withColumns({"Work_Rate": rates, "date": clean.timestamp_text_to_date(F.col("date"))})
        .drop(*presets.HISTORY_UNUSED)
    )
    latest = snapshot.latest_in_window(versions, key, ["id"], "date", first, last).drop("id", "date")
    return SnapshotTables(
        _common_types(shaping.rename_by_table(latest, presets.COLUMN_TRANSLATION), key),
        _common_types(shaping.rename_by_table(people, presets.COLUMN_TRANSLATION), key),
        _common_types(newer, key),
    )


def whole_numbers(df: DataFrame, key: str, exclude: Sequence[str] = ()) -> DataFrame:
    """The key and all other columns but the excluded ones as 64-bit integers, halves to the even neighbour."""
    return shaping.cast_all(df, exclude=exclude, cast=clean.whole_number)


def _common_types(df: DataFrame, key: str) -> DataFrame:
    """Units and types that all sides share: ints but for names and work rates.

    Texts may carry a unit; numbers are in centimetres and pounds already.
    """
    units = {"Height": clean.leading_number, "Weight": clean.weight_in_pounds}
    texts = {name for name, kind in df.dtypes if kind == "string"}
    df = df.withColumns({c: f(F.col(c)) for c, f in units.items() if c in texts})
    return whole_numbers(df, key, TEXT_COLUMNS)


def yearly_snapshot(tables: SnapshotTables, key: str) -> DataFrame:
    """One row per entity of the newer file: its old version, or its newer row where it has none."""
    return reconcile.reconcile(tables.newer, tables.snapshot, tables.dimension, key)


def counted_snapshot(tables: SnapshotTables, key: str) -> tuple[DataFrame, Observation]:
    """:func:`yearly_snapshot` with the counts of its audit, which are there once its rows have been written."""
    return reconcile.reconcile_counted(tables.newer, tables.snapshot, tables.dimension, key)


def snapshot_audit(tables: SnapshotTables, key: str) -> DataFrame:
    return reconcile.coverage_audit(tables.newer, tables.snapshot, tables.dimension, key)


def cleaned_year(raw: DataFrame, key: str) -> DataFrame:
    """Text columns of a yearly file as numbers and two work-rate categories."""
    numbers = _common_types(raw.drop("Name"), key)
    rates = F.col("Work_Rate")
    return numbers.withColumns(
        {
            "Att_WR": clean.level(clean.part(rates, "/", 0)),
            "Def_WR": clean.level(clean.part(rates, "/", 1)),
        }
    ).drop("Work_Rate")


def two_year_table(
    older: DataFrame, newer: DataFrame, targets: DataFrame, key: str, prefixes: tuple[str, str] = ("old_", "new_")
) -> DataFrame:
    """Features of two cleaned years and the targets of the third, with the fold of each entity."""
    wide = features.wide_two_snapshots(older, newer, key, prefixes)
    return features.with_fold(wide.join(targets, key), key)


@dataclass(frozen=True)
class Predictions:
    """Scored held-out rows, the candidate scores, the error on the held-out rows, and the chosen models."""

    rows: DataFrame
    candidates: DataFrame
    errors: DataFrame
    models: modeling.StoredModels


def predict_attributes(
    table: DataFrame,
    key: str,
    targets: Sequence[str] = tuple(presets.TARGETS),
    candidates: Sequence[modeling.Candidate] | None = None,
    seed: int = 1,
    **options,
) -> Predictions:
    """Choose and fit a model per target on the train fold and score the test fold."""
    categorical = [c for c in table.columns if c.endswith("_WR")]
    numeric = shaping.columns_without(table.columns, [key, "fold", *targets, *categorical])
    prepared, stages = modeling.prepare(table, [key, "fold", *targets], numeric, categorical)
    train, test = (prepared.filter(F.col("fold") == f).drop("fold") for f in ("train", "test"))
    found = modeling.search_targets(train, key, targets, candidates or modeling.full_grid(), seed, **options)
    models = {t: s.model for t, s in found.items()}
    pairs = [c for t in targets for c in (modeling.predicted(t), t)]
    # Scoring is the costly part: its result is stored for both the rows and the errors.
    scored = materialize(modeling.score(models, test, rounded=False).select(key, *pairs), "scored")
    return Predictions(
        _rounded(scored, targets),
        modeling.score_table(list(found.values()), table),
        held_out_errors(scored, targets),
        modeling.StoredModels.of(stages, models, table),
    )


def _rounded(scored: DataFrame, targets: Sequence[str]) -> DataFrame:
    names = [modeling.predicted(t) for t in targets]
    return scored.withColumns({n: clean.round_half_even(F.col(n)) for n in names})


def held_out_errors(scored: DataFrame, targets: Sequence[str]) -> DataFrame:
    """``(target, rmse, mae, r2)`` of all targets in one pass over the scored rows."""
    metrics = ("rmse", "mae", "r2")
    row = scored.agg(
        *[
            F.struct(
                F.lit(t).alias("target"),
                *[evaluate.regression_metrics(F.col(t), F.col(modeling.predicted(t)))[m].alias(m) for m in metrics],
            ).alias(t)
            for t in targets
        ]
    )
    return row.select(F.inline(F.array(*targets)))


def predict_overall(
    predicted_attributes: DataFrame,
    actual: DataFrame,
    key: str,
    targets: Sequence[str] = tuple(presets.TARGETS),
    label: str = presets.OVERALL,
    extra: Sequence[str] = ("age",),
    candidates: Sequence[modeling.Candidate] | None = None,
    seed: int = 1,
    **options,
) -> Predictions:
    """Second stage: learn the overall score from true attributes, score predicted ones.

    Entities with predicted attributes are held out of the training.
    """
    options = {"train_ratio": presets.OVERALL_TRAIN_RATIO} | options
    inputs = shaping.strip_suffix(predicted_attributes.drop(*targets), "_pred")
    columns = [key, label, *extra, *targets]
    scoring = actual.select(key, label, *extra).join(inputs, key).select(*columns)
    training = reconcile.missing_in(actual.select(*columns), inputs, key)
    prepared, stages = modeling.prepare(training, [key, label], [*extra, *targets])
    found = modeling.search(prepared, key, label, candidates or modeling.full_grid(), seed, **options)
    scored = materialize(found.model.transform(stages.transform(scoring)).drop(modeling.FEATURES), "scored")
    return Predictions(
        _rounded(scored, [label]),
        modeling.score_table([found], actual),
        held_out_errors(scored, [label]),
        modeling.StoredModels.of(stages, {label: found.model}, training),
    )


def overall_shift(
    newest: DataFrame,
    predicted_attributes: DataFrame,
    key: str,
    candidate: modeling.Candidate,
    targets: Sequence[str] = tuple(presets.TARGETS),
    label: str = presets.OVERALL,
    categories: Sequence[str] = ("work_rate_att", "work_rate_def"),
    scale: float | None = None,
    seed: int = 1,
) -> DataFrame:
    """How the overall score of an entity moves when predictions replace its true attributes.

    The model learns from the entities without predictions; numbers are standardised with their
    statistics. Predictions are standardised likewise, or divided by ``scale``. Rows are paired by key.
    """
    found = [c for c in categories if c in newest.columns]
    table = features.indicators(newest, {c: c for c in found})
    numeric = shaping.columns_without(newest.columns, [key, label, *found])
    inputs = shaping.columns_without(table.columns, [key, label])
    training = reconcile.missing_in(table, predicted_attributes, key)
    standard = features.fit_standardizer(training, numeric)
    # A constant column has no deviation to divide by and nothing to teach.
    inputs = [c for c in inputs if c not in numeric or standard.deviations[c]]
    prepared, stages = modeling.prepare(standard.transform(training), [key, label], inputs)
    model = modeling.fit(prepared, label, candidate, seed)

    guesses = {t: F.col(modeling.predicted(t)).cast("double") for t in targets if t in inputs}
    replacements = {t: g / F.lit(scale) if scale else standard.scaled(g, t) for t, g in guesses.items()}
    scoring = predicted_attributes.select(key, *[modeling.predicted(t) for t in targets])
    return modeling.counterfactual(
        stages, model, standard.transform(table).join(scoring, key), [key], replacements, label
    )
