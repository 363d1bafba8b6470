"""The yearly workload end to end on a small invented league."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from snapledger import jobs, presets
from snapledger.operators import modeling
from snapledger.plans import workload
from snapledger.sources import delimited, relational
from tests.conftest import rows

KEY = "player"
CANDIDATES = [
    modeling.Candidate("forest", {"maxDepth": 4, "numTrees": 5}),
    modeling.Candidate("boosted", {"maxIter": 2}),
]
SKILLS = [n for n in presets.COLUMN_TRANSLATION if n not in ("player_name", "height", "weight", "Age", "Work_Rate")]


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(9)

    def version(number, player, day):
        return (number, player, -player, day, "high", rnd.choice(["low", None]), *[rnd.randrange(99) for _ in SKILLS])

    history = [
        version(1, 1, "2015-07-31 00:00:00"),
        version(2, 1, "2015-09-01 00:00:00"),
        version(3, 1, "2016-02-01 00:00:00"),
        version(4, 1, "2016-02-02 00:00:00"),
        version(5, 2, "2015-09-01 00:00:00"),
        version(6, 9, "2015-09-01 00:00:00"),
        version(7, 197937, "2015-09-01 00:00:00"),
    ]
    columns = ["id", KEY, "player_api_id", "date", "attacking_work_rate", "defensive_work_rate", *SKILLS]
    history = spark.createDataFrame(history, columns).withColumns(
        {"potential": F.lit(1), "preferred_foot": F.lit("left")}
    )
    people = [(1, 11, "One", 1, "1990-10-02 00:00:00", 180.34, 150), (2, 12, "Two", 9, "1980-01-01 00:00:00", 170.0, 140)]
    dimension = spark.createDataFrame(
        people, f"id bigint, player_api_id bigint, player_name string, {KEY} bigint, birthday string, height double, weight bigint"
    )
    newer_columns = [KEY, *presets.COLUMN_TRANSLATION.values()]
    newer = [
        [str(p), *[{"Name": f"N{p}", "Height": "181 cm", "Weight": "70 kg", "Work_Rate": "High / Low"}.get(c, "50") for c in newer_columns[1:]]]
        for p in (1, 2, 3, 197937)
    ]
    return history, dimension, spark.createDataFrame(newer, newer_columns)


def test_snapshot(tables):
    history, dimension, newer = tables
    found = workload.snapshot_tables(history, dimension, newer, KEY, [presets.patch_player(KEY)])
    snapshot = workload.yearly_snapshot(found, KEY)
    assert set(snapshot.columns) == {KEY, *presets.COLUMN_TRANSLATION.values()}
    by_key = {r[KEY]: r for r in snapshot.collect()}
    assert sorted(by_key) == [1, 2, 3, 197937] and snapshot.count() == 4
    third = {r.id: r for r in history.collect()}[3]
    assert (by_key[1].Rating, by_key[1].Name, by_key[1].Age, by_key[1].Height, by_key[1].Weight) == (
        third.overall_rating, "One", 24, 180, 150,
    )
    assert by_key[1].Work_Rate.startswith("high / ")
    # Known to the history but not to the dimension, and known to the newer file alone.
    assert by_key[2].Name is None and by_key[2].Rating is not None
    assert (by_key[3].Name, by_key[3].Height, by_key[3].Weight, by_key[3].Rating) == ("N3", 181, 154, 50)
    assert (by_key[197937].Age, by_key[197937].Height) == (26, 193)
    audit = {r.step: r.rows for r in workload.snapshot_audit(found, KEY).collect()}
    assert audit == {
        "requested": 4, "imported": 4, "only_newer": 1, "in_both": 3, "with_dimension": 3, "missing_dimension": 1,
    }


def test_snapshot_and_ages_jobs(spark, tables, tmp_path, monkeypatch):
    """The database reads are replaced; the rest of the jobs runs."""
    history, dimension, newer = tables
    short = spark.createDataFrame([(1, 21390)], "id int, birthday int")
    asked = []

    def read(spark, url, column, parts, table=None, query=None, driver=None):
        asked.append((column, table, query))
        return dimension if table else short if "WHERE" not in query else history

    monkeypatch.setattr(relational, "read_in_parts", read)
    newer.withColumnRenamed(KEY, "api_id").write.csv(f"{tmp_path}/newer", header=True)
    argv = ["snapshot", "--url", "jdbc:x", "--newer", f"{tmp_path}/newer", "--newer-key", "api_id"]
    jobs.run(spark, [*argv, "--key", KEY, "--out", f"{tmp_path}/out"])
    assert asked[0][0] == "id" and asked[0][2].startswith("SELECT * FROM Player_Attributes WHERE date >= '")
    found = delimited.read_inferred(spark, f"{tmp_path}/out/rows")
    assert sorted(r[KEY] for r in found.collect()) == [1, 2, 3, 197937]
    audit = {r.step: r.rows for r in delimited.read_inferred(spark, f"{tmp_path}/out/audit").collect()}
    assert audit["only_newer"] == 1 and audit["in_both"] == 3
    jobs.run(spark, ["ages", "--url", "jdbc:x", "--now", "2016-06-01", "--out", f"{tmp_path}/ages"])
    assert delimited.read_inferred(spark, f"{tmp_path}/ages").first().age == 26


def test_roster(spark, tmp_path):
    (tmp_path / "players.csv").write_text(
        "Name,Club,Nationality,Rating\nA,Arsenal,X,80\nB,Elsewhere,X,70\nC,Chelsea,X,75\nbroken,Chelsea\n"
    )
    (tmp_path / "names.csv").write_text("Name,url\nA,/player/11/a\nB,/player/12/b\nC,/player/13/c\n")
    argv = ["roster", "--players", f"{tmp_path}/players.csv", "--names", f"{tmp_path}/names.csv"]
    jobs.run(spark, [*argv, "--key", "pid", "--ids-out", f"{tmp_path}/ids", "--out", f"{tmp_path}/out"])
    assert rows(delimited.read_text_columns(spark, f"{tmp_path}/ids")) == [("11",), ("13",)]
    assert rows(delimited.read_text_columns(spark, f"{tmp_path}/out").select("Name", "Club", "Rating", "pid")) == [
        ("A", "Arsenal", "80", "11"), ("C", "Chelsea", "75", "13"),
    ]
    lost = delimited.read_text_columns(spark, f"{tmp_path}/out-rejects", line_breaks="escaped").collect()
    assert [(r.input, r.reason, r.n_fields, r.line) for r in lost] == [("players", "too few fields", "2", "broken,Chelsea")]
    assert lost[0].file.endswith("players.csv")
    (tmp_path / "few.csv").write_text("Name,url\nA,/player/11/a\n")
    with pytest.raises(ValueError):
        workload.club_roster(
            delimited.read_text_columns(spark, f"{tmp_path}/players.csv", mode="DROPMALFORMED"),
            delimited.read_text_columns(spark, f"{tmp_path}/few.csv"),
            "pid",
        )


def test_useful_rows(spark, tmp_path):
    header = ",".join([*presets.USEFUL_COLUMNS, "more"])
    lines = [",".join([str(i), *["1"] * len(presets.USEFUL_COLUMNS)]) for i in range(5)]
    (tmp_path / "newest.csv").write_text("\n".join([header, *lines]) + "\n")
    (tmp_path / "keys.csv").write_text("pid\n1\n3\n3\n77\n")
    argv = ["useful", "--newest", f"{tmp_path}/newest.csv", "--keys", f"{tmp_path}/keys.csv", "--keys-name", "pid"]
    jobs.run(spark, [*argv, "--key", "ID", "--out", f"{tmp_path}/out"])
    found = delimited.read_text_columns(spark, f"{tmp_path}/out")
    assert found.columns == presets.USEFUL_COLUMNS and sorted(r.ID for r in found.collect()) == ["1", "3"]


@pytest.fixture(scope="module")
def league(spark):
    """Two yearly files and a third with the targets, all as text."""
    rnd = random.Random(2)
    years = {"older": [], "newer": [], "targets": []}
    for p in range(120):
        skill = rnd.randrange(40, 90)
        for year in ("older", "newer"):
            years[year].append(
                (str(p), f"P{p}", str(skill + rnd.randrange(5)), f"{170 + p % 20} cm", "70 kg", rnd.choice(["High / Low", "low / odd"]))
            )
        targets = [skill + rnd.randrange(4) for _ in presets.TARGETS]
        years["targets"].append((str(p), str(sum(targets) // 6), str(20 + p % 15), *map(str, targets)))
    yearly = [KEY, "Name", "Rating", "Height", "Weight", "Work_Rate"]
    names = {"older": yearly, "newer": yearly, "targets": [KEY, "overall", "age", *presets.TARGETS]}
    return {year: spark.createDataFrame(data, names[year]) for year, data in years.items()}


def test_wide_keys_survive(spark):
    df = spark.createDataFrame([("8000000000", "7", "x")], "k string, a string, b string")
    assert tuple(workload.whole_numbers(df, "k").first()) == (8_000_000_000, 7, None)
    df = spark.createDataFrame([("1", "79.6", 3e9, 2.5)], "k string, a string, b double, c double")
    assert tuple(workload.whole_numbers(df, "k").first()) == (1, 80, 3_000_000_000, 2)


def test_cleaned_year(league):
    row = workload.cleaned_year(league["older"], KEY).orderBy(KEY).first()
    assert (row.Height, row.Weight) == (170, 154) and {row.Att_WR, row.Def_WR} <= set(presets.LEVELS)
    assert "Name" not in row.asDict() and "Work_Rate" not in row.asDict()


def test_predictions(league):
    targets = workload.whole_numbers(league["targets"], KEY)
    table = workload.two_year_table(
        workload.cleaned_year(league["older"], KEY),
        workload.cleaned_year(league["newer"], KEY),
        targets.select(KEY, *presets.TARGETS),
        KEY,
    )
    assert {"old_Rating", "new_Rating", "old_Att_WR", "new_Def_WR", "fold", "pac"} <= set(table.columns)
    first = workload.predict_attributes(table, KEY, candidates=CANDIDATES, seed=3)
    held_out = table.filter("fold = 'test'").count()
    assert first.rows.count() == held_out > 0
    assert first.rows.columns == [KEY, *[c for t in presets.TARGETS for c in (f"{t}_pred", t)]]
    assert first.candidates.count() == 12 and first.candidates.filter("selected").count() == 6
    errors = {r.target: r for r in first.errors.collect()}
    assert set(errors) == set(presets.TARGETS) and all(e.r2 > 0.3 for e in errors.values())

    second = workload.predict_overall(first.rows, targets, KEY, candidates=CANDIDATES, seed=3)
    assert second.rows.columns == [KEY, "overall", "age", *presets.TARGETS, "overall_pred"]
    assert second.rows.count() == held_out
    # The inputs of the second stage are the predictions, not the true values.
    assert rows(second.rows.select(KEY, "pac")) == rows(first.rows.select(KEY, "pac_pred"))
    assert second.errors.first().rmse < 15


def test_short_birthdays(spark):
    people = spark.createDataFrame([(1, 21390), (2, 10125)], "id int, birthday int")
    found = workload.ages_from_short_birthdays(people, dt.date(2016, 6, 1))
    assert rows(found) == [(1, dt.date(1990, 2, 13), 26), (2, dt.date(1925, 1, 1), 91)]


def test_overall_shift(spark, tmp_path):
    rnd = random.Random(6)
    newest, guesses = [], []
    for p in range(150):
        values = [rnd.randrange(40, 90) for _ in presets.TARGETS]
        newest.append((p, sum(values) // 6, 180, "High", rnd.choice(["Low", "Medium"]), *values))
        if p % 5 == 0:
            guesses.append((p, *[v + (20 if p % 2 else 0) for v in values]))
    columns = ["ID", "overall", "height_cm", "work_rate_att", "work_rate_def", *presets.TARGETS]
    spark.createDataFrame(newest, columns).write.csv(f"{tmp_path}/newest", header=True)
    names = ["id", *[f"{t}_pred" for t in presets.TARGETS]]
    spark.createDataFrame(guesses, names).write.csv(f"{tmp_path}/guesses", header=True)
    argv = ["shift", "--newest", f"{tmp_path}/newest", "--predictions", f"{tmp_path}/guesses", "--key", "ID"]
    jobs.run(spark, [*argv, "--trees", "5", "--depth", "4", "--out", f"{tmp_path}/out"])
    moved = delimited.read_inferred(spark, f"{tmp_path}/out/rows")
    assert moved.count() == 30
    # True values as predictions move nothing, values 20 higher raise the score.
    assert moved.filter("ID % 2 = 0").agg(F.max("abs_shift")).first()[0] == 0.0
    # Five trees need not move every single row: some fall into the same leaves with either values.
    move = F.col("shifted_pred") - F.col("base_pred")
    least, mean = moved.filter("ID % 2 = 1").agg(F.min(move), F.avg(move)).first()
    assert least >= 0 and mean > 3
    mean = delimited.read_inferred(spark, f"{tmp_path}/out/mean").first()[0]
    assert mean == pytest.approx(moved.agg(F.avg("abs_shift")).first()[0])
    jobs.run(spark, [*argv, "--trees", "2", "--depth", "2", "--scale", "120", "--out", f"{tmp_path}/scaled"])
    assert delimited.read_inferred(spark, f"{tmp_path}/scaled/rows").count() == 30


def test_prediction_jobs(spark, league, tmp_path, monkeypatch):
    monkeypatch.setattr(modeling, "full_grid", lambda: CANDIDATES[:1])
    for name, df in league.items():
        df.drop(*(["Name"] if name != "targets" else [])).write.csv(f"{tmp_path}/{name}", header=True)
    argv = ["attributes", "--older", f"{tmp_path}/older", "--newer", f"{tmp_path}/newer", "--targets", f"{tmp_path}/targets"]
    jobs.run(spark, [*argv, "--targets-key", KEY, "--key", KEY, "--out", f"{tmp_path}/a"])
    predictions = delimited.read_inferred(spark, f"{tmp_path}/a/predictions")
    # The stored models give the same scores, to all rows of the features and so to those that were held out.
    argv = ["score", "--models", f"{tmp_path}/a/models", "--features", f"{tmp_path}/a/features", "--key", KEY]
    jobs.run(spark, [*argv, "--out", f"{tmp_path}/s"])
    again = delimited.read_inferred(spark, f"{tmp_path}/s/predictions")
    names = [KEY, *[f"{t}_pred" for t in presets.TARGETS]]
    assert set(rows(predictions.select(*names))) < set(rows(again.select(*names))) and again.count() > predictions.count()
    found = modeling.StoredModels.load(spark, f"{tmp_path}/a/models")
    table = delimited.read_inferred(spark, f"{tmp_path}/a/features")
    with pytest.raises(ValueError, match="no column new_Rating"):
        found.check(table.drop("new_Rating"))
    with pytest.raises(ValueError, match="new_Rating is string"):
        found.check(table.withColumns({n: F.col(n).cast(t) for n, t in found.inputs}).withColumn("new_Rating", F.lit("x")))
    assert predictions.columns[:3] == ["position", KEY, "pac_pred"]
    assert [r.position for r in predictions.orderBy(KEY).collect()] == list(range(predictions.count()))
    jobs.run(
        spark,
        ["overall", "--predictions", f"{tmp_path}/a/predictions", "--actual", f"{tmp_path}/targets", "--key", KEY, "--out", f"{tmp_path}/o"],
    )
    scored = delimited.read_inferred(spark, f"{tmp_path}/o/predictions")
    assert scored.count() == predictions.count() and "overall_pred" in scored.columns
    assert delimited.read_inferred(spark, f"{tmp_path}/o/errors").count() == 1
