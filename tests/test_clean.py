import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapledger.functions import clean


def apply(spark, values, function, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "function, values, expected",
    [
        (clean.level, [" High ", "None", "", None, "low"], ["high", "medium", "medium", "medium", "low"]),
        (clean.leading_number, ["193 cm", "193", None, "x"], [193, 193, None, None]),
        (clean.weight_in_pounds, ["70 kg", "154", None, "x kg", "x"], [154, 154, None, None, None]),
        (clean.round_half_even, ["0.5", "1.5", "2.5", "-0.5", None, "x"], [0, 2, 2, 0, None, None]),
        (clean.text_to_int, ["12", "90.0", "", None, "-3"], [12, None, None, None, -3]),
        (clean.url_segment, ["/player/183277/x", "a", None], ["183277", None, None]),
        (lambda c: clean.indicator(c, "high"), ["High", "high", "low", None], [1, 1, 0, 0]),
        (
            clean.timestamp_text_to_date,
            ["1988-12-01 00:00:00", "broken", None],
            [dt.date(1988, 12, 1), None, None],
        ),
    ],
)
def test_texts(spark, function, values, expected):
    assert apply(spark, values, function) == expected


def test_round_numbers(spark):
    assert apply(spark, [0.5, 1.5, 2.5, -1.5, None], clean.round_half_even, "double") == [0, 2, 2, -2, None]


def test_split_category(spark):
    first = apply(spark, ["high / low", "high", None], lambda c: clean.level(clean.part(c, "/", 0)))
    second = apply(spark, ["high / low", "high", None], lambda c: clean.level(clean.part(c, "/", 1)))
    assert first == ["high", "high", "medium"]
    assert second == ["low", "medium", "medium"]


def test_part_takes_its_separator_literally(spark):
    assert apply(spark, ["a.b|c"], lambda c: clean.part(c, ".", 1)) == ["b|c"]
    assert apply(spark, ["a.b|c"], lambda c: clean.part(c, "|", 1)) == ["c"]


def test_combine_pair(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b")], "x string, y string")
    assert [r[0] for r in df.select(clean.combine_pair(F.col("x"), F.col("y"))).collect()] == ["a / b", "None / b"]


@pytest.mark.parametrize(
    "as_of, born, age",
    [
        (dt.date(2015, 10, 1), dt.date(1988, 12, 1), 26),
        (dt.date(2015, 10, 1), dt.date(1988, 10, 1), 27),
        (dt.date(2015, 10, 1), dt.date(1988, 10, 2), 26),
        (dt.date(2015, 10, 1), dt.date(1988, 2, 29), 27),
        (dt.date(2015, 2, 28), dt.date(1988, 2, 29), 26),
        (dt.date(2015, 2, 28), None, None),
    ],
)
def test_age(spark, as_of, born, age):
    assert apply(spark, [born], lambda c: clean.age_at(c, as_of), "date") == [age]


def test_two_digit_birthday(spark):
    now = dt.date(2016, 6, 1)
    found = apply(spark, [21390, 123168, 10125, None, 999999], lambda c: clean.two_digit_birthday(c, now), "int")
    assert found == [dt.date(1990, 2, 13), dt.date(1968, 12, 31), dt.date(1925, 1, 1), None, None]
