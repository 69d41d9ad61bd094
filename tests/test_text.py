"""Text, numbers and bounds."""

import random
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from plumbline.functions.text import (
    blank_to_null,
    check_id,
    number_text,
    percent_text,
    render_description,
)
from plumbline.functions.values import bound, is_numeric_text, split_list


def test_numeric_text(frame):
    yes = ["12", "1.5", "1e5", " 7 ", "-3", ".5", "5.", "+1.0E-3"]
    no = ["abc", "1d", "NaN", "Infinity", "", "$5", "1 2", "--1", "."]
    df = frame("t string", [(t,) for t in yes + no])
    found = df.select("t", is_numeric_text(F.col("t")).alias("ok")).collect()
    assert {row["t"] for row in found if row["ok"]} == set(yes)


def test_percent_text_rounds_the_exact_value(frame):
    random.seed(5)
    pairs = [(random.randint(0, d), d) for d in random.choices(range(1, 200000), k=3000)]
    pairs += [(k, 20000) for k in range(1, 3000)] + [(k, 32) for k in range(33)]
    df = frame("v bigint, d bigint", pairs).withColumn("share", F.col("v") / F.col("d"))
    for row in df.select("share", percent_text("share").alias("text")).collect():
        exact = Decimal(row["share"] * 100).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert row["text"] == ("0%" if row["share"] == 0 else f"{exact}%")


def test_percent_text_of_nothing_and_of_more_than_all(frame):
    df = frame("share double", [(None,), (0.0,), (1.5,), (0.00001,)])
    found = [row[0] for row in df.select(percent_text("share")).collect()]
    assert found == ["0%", "0%", "150.00%", "0.00%"]


def test_number_text(frame):
    df = frame("n double", [(5.0,), (7.5,), (0.0,), (100.0,)])
    assert [row[0] for row in df.select(number_text(F.col("n"))).collect()] == [
        "5", "7.5", "0", "100",
    ]


def test_check_id(frame):
    df = frame(
        "a string, b string, c string", [("FIELD", " Is Required ", None), ("T", " ", "x Y")]
    )
    found = [row[0] for row in df.select(check_id(*map(F.col, "abc"))).collect()]
    assert found == ["field_isrequired", "t_xy"]


def test_render_description(frame):
    df = frame(
        "name string, nameLonger string, odd string", [("N", "L", r"a$1\2@name"), (None, "L", "o")]
    )
    template = F.lit("@nameLonger and @name, @odd; @unknown!")
    columns = ["name", "nameLonger", "odd"]
    found = [row[0] for row in df.select(render_description(template, columns)).collect()]
    assert found == [r"L and N, a$1\2@name; !", "L and , o; !"]


def test_blank_to_null(frame):
    df = frame("a string, b string, n int", [(" ", "x", 1), ("\t\n", "", 2), (" y ", None, 3)])
    rows = blank_to_null(df).collect()
    assert [tuple(r) for r in rows] == [(None, "x", 1), (None, None, 2), (" y ", None, 3)]


@pytest.mark.parametrize(
    ("text", "datatype", "value"),
    [
        ("1950", None, 1950),
        ("'19500131'", "date", date(1950, 1, 31)),
        ("1950-01-31", "datetime", date(1950, 1, 31)),
        ("'1950-01-31'", "date", date(1950, 1, 31)),
        ("DATEADD(dd, 1, DATE'2020-02-28')", "date", date(2020, 2, 29)),
        ("year(DATE'2020-02-28') + 1", "integer", 2021),
    ],
)
def test_bound(spark, text, datatype, value):
    assert spark.range(1).select(bound(text, datatype)).first()[0] == value


def test_bound_of_today(spark):
    late = spark.range(1).select(
        bound("DATEADD(dd,1,GETDATE())", "date") > F.current_date(),
        bound("YEAR(GETDATE())+1") > F.year(F.current_date()),
    )
    assert tuple(late.first()) == (True, True)


def test_split_list():
    assert split_list("a,b , c") == ["a", "b", "c"]
    assert split_list("Meas Value','Device") == ["Meas Value", "Device"]
    assert split_list([1, 2]) == ["1", "2"]
