import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger import sinks
from snapledger.session import ensure_checkpoint_dir, materialize, new_folder, persisted, shared_folder
from snapledger.sources import delimited, literal, relational

LINES = "id,n,v\n1,a,2\n2,b\n3,c,4,5\n"
SCHEMA = T.StructType(
    [T.StructField("id", T.IntegerType()), T.StructField("n", T.StringType()), T.StructField("v", T.IntegerType())]
)


@pytest.fixture
def path(tmp_path):
    (tmp_path / "a.csv").write_text(LINES)
    return str(tmp_path)


def test_malformed_lines_go_whatever_is_selected(spark, path):
    for df in (
        delimited.read_text_columns(spark, path, mode="DROPMALFORMED"),
        delimited.read_text_columns(spark, path, ["id", "n", "v"], mode="DROPMALFORMED"),
        delimited.read_typed(spark, path, SCHEMA, mode="DROPMALFORMED"),
    ):
        assert df.count() == 1
        assert len(df.select("n").collect()) == 1
        assert len(df.collect()) == 1
        assert df.filter("id > 0").count() == 1


def test_permissive_keeps_all_lines(spark, path):
    df = delimited.read_typed(spark, path, SCHEMA, mode="PERMISSIVE")
    assert sorted(tuple(r) for r in df.collect() if r.v is not None) == [(1, "a", 2), (3, "c", 4)]
    assert df.count() == len(df.select("n").collect()) == 3


def test_a_torn_line_is_an_error_by_default(spark, path):
    for df in (delimited.read_text_columns(spark, path), delimited.read_typed(spark, path, SCHEMA).select("id")):
        with pytest.raises(Exception, match="(?i)malformed"):
            df.collect()


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a,other\n1,2,x\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    assert tuple(delimited.read_typed(spark, str(tmp_path), schema).first()) == (2, 1)
    with pytest.raises(ValueError, match="no column c"):
        delimited.read_text_columns(spark, str(tmp_path), ["a", "c"])
    (tmp_path / "b.csv").write_text("a,b,other\n1,2,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        delimited.read_typed(spark, str(tmp_path), schema).collect()


def test_texts_survive(spark, tmp_path):
    values = ["a\nb", "", None, ' "q", x ', "50%0A\r\n", "\\n", "%25", ",", "''", '"']
    df = spark.createDataFrame(list(enumerate(values)), "id int, t string")
    sinks.write_csv(df, f"{tmp_path}/e", escape_line_breaks=True)
    sinks.write_csv(df, f"{tmp_path}/q")
    for name, how in (("e", "escaped"), ("q", "quoted")):
        found = delimited.read_typed(spark, f"{tmp_path}/{name}", df.schema, line_breaks=how)
        assert [r.t for r in found.orderBy("id").collect()] == values


def test_unreadable_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,n,v\n1,a,x\n2,b,\n3,c,4\n")
    kept = delimited.read_typed(spark, str(tmp_path), SCHEMA)
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "a", None), (2, "b", None), (3, "c", 4)]
    strict = delimited.read_typed(spark, str(tmp_path), SCHEMA, drop_unreadable=True)
    assert sorted(r.id for r in strict.collect()) == [2, 3]
    assert strict.count() == len(strict.select("n").collect()) == 2


def test_blank_header_is_dropped(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",id,pac\n0,7,80\n1,8,81\n")
    assert delimited.read_text_columns(spark, str(tmp_path)).columns == ["id", "pac"]
    inferred = delimited.read_inferred(spark, str(tmp_path))
    assert dict(inferred.dtypes) == {"id": "int", "pac": "int"}


def test_literal_rows_follow_the_schema(spark):
    df = literal.literal_rows(spark, [{"b": "x", "a": 1}, {"a": 2}], "a int, b string")
    assert [tuple(r) for r in df.collect()] == [(1, "x"), (2, None)]
    with pytest.raises(ValueError):
        literal.literal_rows(spark, [{"c": 1}], "a int")


def test_jdbc_options():
    split = relational.ReadSplit("id", "0", "1000", 8)
    table = relational.jdbc_options("jdbc:x", table="t", split=split, driver="d")
    assert table == {
        "url": "jdbc:x",
        "fetchsize": "10000",
        "driver": "d",
        "dbtable": "t",
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "1000",
        "numPartitions": "8",
    }
    assert relational.jdbc_options("jdbc:x", query="select 1;")["query"] == "select 1"
    derived = relational.jdbc_options("jdbc:x", query="select * from t;", split=split)
    assert derived["dbtable"] == "(select * from t) AS source_rows" and "query" not in derived
    for wrong in ({}, {"table": "t", "query": "q"}):
        with pytest.raises(ValueError):
            relational.jdbc_options("jdbc:x", **wrong)


def test_reads_are_split_between_the_bounds(spark, monkeypatch):
    asked = []

    def read(name):
        def reader(spark, url, source, split=None, driver=None):
            asked.append((name, source, split))
            return spark.createDataFrame([(3, 900)], "low int, high int")

        return reader

    monkeypatch.setattr(relational, "read_query", read("query"))
    monkeypatch.setattr(relational, "read_table", read("table"))
    relational.read_in_parts(spark, "jdbc:x", "id", 8, table="t")
    window = relational.window_query("t", "date", dt.date(2015, 1, 1), dt.date(2015, 12, 31))
    assert window == "SELECT * FROM t WHERE date >= '2015-01-01' AND date < '2016-01-01'"
    relational.read_in_parts(spark, "jdbc:x", "id", 8, query=window + ";")
    split = relational.ReadSplit("id", "3", "900", 8)
    assert asked == [
        ("query", "SELECT MIN(id) AS low, MAX(id) AS high FROM t", None),
        ("table", "t", split),
        ("query", f"SELECT MIN(id) AS low, MAX(id) AS high FROM ({window}) source_rows", None),
        ("query", window + ";", split),
    ]


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(i % 3, f"n{i}", i / 7) for i in range(50)], "k int, n string, v double")
    sinks.write_csv(df, f"{tmp_path}/a")
    assert sorted(map(tuple, delimited.read_typed(spark, f"{tmp_path}/a", df.schema).collect())) == sorted(
        map(tuple, df.collect())
    )
    sinks.write_key_list(df, "k", f"{tmp_path}/k")
    assert delimited.read_text_columns(spark, f"{tmp_path}/k").columns == ["k"]
    sinks.write_csv_with_position(df, f"{tmp_path}/p", ["v"])
    positions = delimited.read_inferred(spark, f"{tmp_path}/p")
    assert positions.columns == ["position", "k", "n", "v"]
    assert [r.n for r in positions.orderBy("position").collect()] == [f"n{i}" for i in range(50)]
    sinks.write_csv(df, f"{tmp_path}/by", partition_by=["k"])
    assert delimited.read_inferred(spark, f"{tmp_path}/by").filter("k = 1").count() == 17


def test_fixed_decimals(spark):
    df = spark.createDataFrame([(1.0, 2.346), (None, -0.5)], "a double, b double")
    assert [r.value for r in sinks.fixed_decimal_lines(df, ["a", "b"]).collect()] == ["1.00 2.35", "nan -0.50"]


def test_fixed_decimals_round_as_c(spark):
    values = [1.005, 0.125, 2.675, 0.375, -0.125, 1e15 / 8, 1e20, -0.001, float("nan"), float("inf"), -float("inf"), 0.0, 999.995]
    values += [k / 8 for k in range(40)] + [k + 0.005 for k in range(200)] + [k / 1000 for k in range(0, 3000, 5)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 1, 2, 3):
        found = sinks.fixed_decimal_lines(df, ["v"], digits).collect()
        assert [r.value for r in found] == [f"{v:.{digits}f}" for v in values]


def test_shared_folder_is_the_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    ensure_checkpoint_dir(spark)
    assert not spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty()


def test_materialize_reads_what_it_wrote(spark):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    stored = materialize(df, "test")
    assert stored.inputFiles() and stored.schema == df.schema.__class__([*stored.schema.fields])
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.collect()))
    with persisted(df) as kept:
        assert kept.is_cached and kept.count() == 100
    assert not df.is_cached


def test_rejected_lines(spark, tmp_path):
    """Every line is accepted or rejected with its file and reason, whatever is asked of the two tables."""
    (tmp_path / "a.csv").write_text('id,n,v\n1,a,2\n2,b\n3,c,4,5\n4,"x, ""y""",\nfive,e,6\n6,"torn,7\n')
    (tmp_path / "b.csv").write_text("id,n,v\n7,,8\n8,i,nine\n,,\n")
    found = delimited.read_checked(spark, str(tmp_path), SCHEMA)
    assert sorted(map(tuple, found.accepted.collect()), key=repr) == [(1, "a", 2), (4, 'x, "y"', None), (7, None, 8), (None, None, None)]
    rows = sorted((r.file.rsplit("/", 1)[1], r.reason, r.column, r.n_fields, r.line) for r in found.rejected.collect())
    expected = [
        ("a.csv", "too few fields", None, 2, "2,b"), ("a.csv", "too many fields", None, 4, "3,c,4,5"),
        ("a.csv", "too few fields", None, 2, '6,"torn,7'), ("a.csv", "unreadable value", "id", 3, "five,e,6"),
        ("b.csv", "unreadable value", "v", 3, "8,i,nine"),
    ]
    assert rows == sorted(expected)
    assert found.accepted.count() == 4 and found.rejected.select("line").count() == 5
    assert {r.reason: r.rows for r in found.counts().collect()} == {
        "": 4, "too few fields": 2, "too many fields": 1, "unreadable value": 2,
    }
    # Without a schema all values are texts, and only the number of fields counts; columns are found by name.
    with delimited.checked(spark, str(tmp_path)) as texts:
        assert texts.accepted.columns == ["id", "n", "v"] and texts.accepted.count() == 6 and texts.rejected.count() == 3
    some = delimited.read_checked(spark, str(tmp_path), T.StructType([SCHEMA["v"], SCHEMA["id"]]))
    assert some.accepted.columns == ["v", "id"] and some.accepted.count() == 4
    with pytest.raises(ValueError, match="no column w"):
        delimited.read_checked(spark, str(tmp_path), T.StructType([T.StructField("w", T.StringType())]))


def test_rejects_with_line_breaks(spark, tmp_path):
    values = ["a\nb", "", None, "50%0A\r\n"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, t string")
    sinks.write_csv(df, f"{tmp_path}/q")
    sinks.write_csv(df, f"{tmp_path}/e", escape_line_breaks=True)
    for name, how in (("e", "escaped"), ("q", "quoted")):
        found = delimited.read_checked(spark, f"{tmp_path}/{name}", df.schema, line_breaks=how)
        assert [r.t for r in found.accepted.orderBy("id").collect()] == values and found.rejected.isEmpty()
    spark.createDataFrame([], df.schema).write.csv(f"{tmp_path}/none", header=True)
    empty = delimited.read_checked(spark, f"{tmp_path}/none")
    assert empty.accepted.isEmpty() and empty.rejected.isEmpty()


def test_a_failed_write_leaves_the_old_files(spark, tmp_path):
    path = f"{tmp_path}/out"
    good = spark.createDataFrame([(1, "a"), (2, None), (2, None), (3, "")], "id int, t string")
    sinks.write_csv(good, path)
    bad = good.withColumn("t", F.when(F.col("id") == 3, F.raise_error(F.lit("torn"))).otherwise(F.col("t")))
    with pytest.raises(Exception, match="torn"):
        sinks.write_csv(bad, path)
    found = delimited.read_typed(spark, path, good.schema)
    assert sinks.verified(found, path).count() == 4
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out"]
    # Written again, over the first result, and in parts.
    sinks.write_csv(good.filter("id < 3"), path)
    assert sinks.read_manifest(spark, path)["rows"] == 3 and delimited.read_typed(spark, path, good.schema).count() == 3
    sinks.write_csv(good, f"{tmp_path}/deeper/parts", partition_by=["id"])
    assert delimited.read_text_columns(spark, f"{tmp_path}/deeper/parts/id=1").collect() == [("a",)]
    sinks.write_csv(good.limit(0), f"{tmp_path}/none")
    assert sinks.read_manifest(spark, f"{tmp_path}/none") == {"columns": ["id", "t"], "rows": 0, "checksum": 0}


def test_lost_and_changed_rows_are_found(spark, tmp_path):
    path = f"{tmp_path}/out"
    df = spark.range(100).select(F.col("id").cast("int").alias("id"), (F.col("id") / 7).alias("v"))
    sinks.write_csv(df, path)
    read = delimited.read_typed(spark, path, df.schema)
    assert sinks.verified(read, path).count() == 100
    for other in (read.filter("id <> 5"), read.withColumn("v", F.when(F.col("id") != 5, F.col("v"))), read.union(read.filter("id = 5"))):
        with pytest.raises(ValueError, match="written"):
            sinks.verified(other, path)
