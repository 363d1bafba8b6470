"""Command line: ``spark-submit`` this module's file, or ``python -m snapledger.jobs <step> ...``."""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger import presets, sinks
from snapledger.functions import clean
from snapledger.operators import evaluate, modeling, reconcile, shaping
from snapledger.plans import workload
from snapledger.session import build_session, stored
from snapledger.sources import delimited, relational


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="snapledger")
    steps = parser.add_subparsers(dest="step", required=True)

    roster = steps.add_parser("roster", help="players of the wanted clubs with their ids")
    roster.add_argument("--players", required=True)
    roster.add_argument("--names", required=True)
    roster.add_argument("--ids-out", required=True)

    snap = steps.add_parser("snapshot", help="old version of each entity of the newer file")
    snap.add_argument("--url", required=True, help="JDBC URL of the history database")
    snap.add_argument("--driver")
    snap.add_argument("--history-table", default="Player_Attributes")
    snap.add_argument("--dimension-table", default="Player")
    snap.add_argument("--parts", type=int, default=64, help="parallel range reads of a table")
    snap.add_argument("--newer", required=True)
    snap.add_argument("--newer-key", help="name of the key in the newer file")
    snap.add_argument("--first", type=dt.date.fromisoformat, default=presets.WINDOW_START)
    snap.add_argument("--last", type=dt.date.fromisoformat, default=presets.WINDOW_END)
    snap.add_argument("--as-of", type=dt.date.fromisoformat, default=presets.AGE_AS_OF)

    useful = steps.add_parser("useful", help="useful columns of the entities in a key list")
    useful.add_argument("--newest", required=True)
    useful.add_argument("--keys", required=True)
    useful.add_argument("--keys-name", required=True)

    attributes = steps.add_parser("attributes", help="predict the attributes of the third year")
    attributes.add_argument("--older", required=True)
    attributes.add_argument("--newer", required=True)
    attributes.add_argument("--newer-key", help="name of the key in the newer file")
    attributes.add_argument("--targets", required=True)
    attributes.add_argument("--targets-key", default="id")

    overall = steps.add_parser("overall", help="predict the overall score from predicted attributes")
    overall.add_argument("--predictions", required=True)
    overall.add_argument("--actual", required=True)

    score = steps.add_parser("score", help="predict with the models that the attributes or overall step stored")
    score.add_argument("--models", required=True, help="the folder models of that step's output")
    score.add_argument("--features", required=True, help="a table as that step learnt from, such as its features")

    shift = steps.add_parser("shift", help="move of the overall score under predicted attributes")
    shift.add_argument("--newest", required=True)
    shift.add_argument("--predictions", required=True)
    shift.add_argument("--predictions-key", default="id")
    shift.add_argument("--scale", type=float, help="divide predictions by this instead of standardising")
    shift.add_argument("--trees", type=int, default=presets.FOREST_TREES[0])
    shift.add_argument("--depth", type=int, default=presets.FOREST_DEPTHS[0])

    ages = steps.add_parser("ages", help="birthdays written MMDDYY as dates with ages")
    ages.add_argument("--url", required=True, help="JDBC URL")
    ages.add_argument("--driver")
    ages.add_argument("--query", default="select * from Player")
    ages.add_argument("--split-column", default="id")
    ages.add_argument("--parts", type=int, default=16)
    ages.add_argument("--now", type=dt.date.fromisoformat, default=dt.date.today())
    ages.add_argument("--out", required=True)

    for step in (roster, snap, useful, attributes, overall, score, shift):
        step.add_argument("--key", required=True, help="name of the entity key")
        step.add_argument("--out", required=True)
    for step in (attributes, overall, shift):
        step.add_argument("--seed", type=int, default=1)
        step.add_argument("--parallelism", type=int, default=4)
    return parser


def run(spark: SparkSession, argv: list[str]) -> None:
    args = _parser().parse_args(argv)
    globals()[f"_{args.step}"](spark, args)


@contextmanager
def _taken(spark: SparkSession, rejects: str, **files: str) -> Iterator[list[DataFrame]]:
    """The rows of each file as texts, parsed once and stored; lines that don't fit are written to ``rejects``, by input."""
    with ExitStack() as stack:
        found = {name: stack.enter_context(delimited.checked(spark, path)) for name, path in files.items()}
        lost = [c.rejected.select(F.lit(name).alias("input"), *delimited.REJECT_COLUMNS) for name, c in found.items()]
        sinks.write_csv(reduce(DataFrame.unionByName, lost), rejects, escape_line_breaks=True)
        yield [c.accepted for c in found.values()]


def _roster(spark: SparkSession, args: argparse.Namespace) -> None:
    with _taken(spark, f"{args.out}-rejects", players=args.players, names=args.names) as (players, names):
        roster = workload.club_roster(players, names, args.key)
        sinks.write_key_list(roster, args.key, args.ids_out)
        sinks.write_csv(roster, args.out)


def _snapshot(spark: SparkSession, args: argparse.Namespace) -> None:
    # The database sends only the days of the window.
    versions = relational.window_query(args.history_table, "date", args.first, args.last)
    parts = {"column": "id", "parts": args.parts, "driver": args.driver}
    history = relational.read_in_parts(spark, args.url, query=versions, **parts)
    dimension = relational.read_in_parts(spark, args.url, table=args.dimension_table, **parts)
    newer = delimited.read_text_columns(spark, args.newer, mode="PERMISSIVE")
    newer = newer.withColumnRenamed(args.newer_key or args.key, args.key)
    tables = workload.snapshot_tables(
        history, dimension, newer, args.key, [presets.patch_player(args.key)], args.first, args.last, args.as_of
    )
    # The history is read once; what is left of it has one row per entity.
    with stored(tables.snapshot, "snapshot") as latest:
        tables = replace(tables, snapshot=latest)
        # The rows are stored before they are numbered; the audit is counted in passing.
        rows, seen = workload.counted_snapshot(tables, args.key)
        with stored(rows, "reconciled") as found:
            sinks.write_csv(reconcile.audit_of_counts(spark, seen.get), f"{args.out}/audit")
            sinks.write_csv_with_position(found, f"{args.out}/rows", [args.key])


def _useful(spark: SparkSession, args: argparse.Namespace) -> None:
    newest = delimited.read_text_columns(spark, args.newest, mode="PERMISSIVE")
    keys = delimited.read_text_columns(spark, args.keys, mode="PERMISSIVE")
    sinks.write_csv(workload.useful_rows(newest, keys, args.keys_name, args.key), args.out)


def _attributes(spark: SparkSession, args: argparse.Namespace) -> None:
    files = {"older": args.older, "newer": args.newer, "targets": args.targets}
    with _taken(spark, f"{args.out}/rejects", **files) as (older, newer, targets):
        older = workload.cleaned_year(older, args.key)
        newer = workload.cleaned_year(newer.withColumnRenamed(args.newer_key or args.key, args.key), args.key)
        targets = targets.withColumnRenamed(args.targets_key, args.key)
        targets = workload.whole_numbers(targets.select(args.key, *presets.TARGETS), args.key)
        with stored(workload.two_year_table(older, newer, targets, args.key), "wide") as table:
            sinks.write_csv_with_position(table, f"{args.out}/features", [args.key])
            found = workload.predict_attributes(table, args.key, seed=args.seed, parallelism=args.parallelism)
            _write_predictions(found, args)


def _overall(spark: SparkSession, args: argparse.Namespace) -> None:
    columns = [args.key, *[f"{t}_pred" for t in presets.TARGETS]]
    predictions = delimited.read_text_columns(spark, args.predictions).select(*columns)
    with _taken(spark, f"{args.out}/rejects", actual=args.actual) as (actual,):
        found = workload.predict_overall(
            shaping.cast_all(predictions, [args.key], clean.round_half_even).withColumn(
                args.key, F.col(args.key).try_cast("bigint")
            ),
            workload.whole_numbers(actual.select(args.key, presets.OVERALL, "age", *presets.TARGETS), args.key),
            args.key,
            seed=args.seed,
            parallelism=args.parallelism,
        )
        _write_predictions(found, args)


def _score(spark: SparkSession, args: argparse.Namespace) -> None:
    stored_models = modeling.StoredModels.load(spark, args.models)
    wanted = T.StructType([T.StructField(args.key, T.LongType()), *[T.StructField(n, _type(t)) for n, t in stored_models.inputs]])
    with delimited.checked(spark, args.features, wanted) as found:
        sinks.write_csv(found.rejected, f"{args.out}/rejects", escape_line_breaks=True)
        scored = stored_models.score(found.accepted, [args.key], rounded=True)
        sinks.write_csv_with_position(scored, f"{args.out}/predictions", [args.key])


def _type(name: str) -> T.DataType:
    return T.StructType.fromDDL(f"x {name}")["x"].dataType


def _shift(spark: SparkSession, args: argparse.Namespace) -> None:
    columns = [args.predictions_key, *[f"{t}_pred" for t in presets.TARGETS]]
    predictions = delimited.read_text_columns(spark, args.predictions).select(*columns)
    predictions = predictions.withColumnRenamed(args.predictions_key, args.key)
    # Predictions keep their fractions.
    predictions = shaping.cast_all(predictions, [args.key], lambda c: c.try_cast("double")).withColumn(
        args.key, F.col(args.key).try_cast("bigint")
    )
    candidate = modeling.Candidate(
        "forest", {"maxDepth": args.depth, "numTrees": args.trees, "maxBins": presets.FOREST_BINS}
    )
    with _taken(spark, f"{args.out}/rejects", newest=args.newest) as (newest,):
        rates = [c for c in newest.columns if c.startswith("work_rate_")]
        moved = workload.overall_shift(
            workload.whole_numbers(newest, args.key, rates),
            predictions,
            args.key,
            candidate,
            scale=args.scale,
            seed=args.seed,
        )
        sinks.write_csv(moved, f"{args.out}/rows")
        sinks.write_csv(evaluate.mean_abs_shift(moved, "base_pred", "shifted_pred"), f"{args.out}/mean")


def _ages(spark: SparkSession, args: argparse.Namespace) -> None:
    people = relational.read_in_parts(
        spark, args.url, query=args.query, column=args.split_column, parts=args.parts, driver=args.driver
    )
    sinks.write_csv(workload.ages_from_short_birthdays(people, args.now), args.out)


def _write_predictions(found: workload.Predictions, args: argparse.Namespace) -> None:
    sinks.write_csv_with_position(found.rows, f"{args.out}/predictions", [args.key])
    sinks.write_csv(found.candidates, f"{args.out}/candidates")
    sinks.write_csv(found.errors, f"{args.out}/errors")
    found.models.save(found.rows.sparkSession, f"{args.out}/models")


def main() -> None:
    run(build_session("snapledger"), sys.argv[1:])


if __name__ == "__main__":
    main()
