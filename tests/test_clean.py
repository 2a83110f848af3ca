import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from crashlake.functions import clean as C
from crashlake.operators import normalize as N
from helpers import base_row, feed


def one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_ids(spark):
    assert one_col(spark, ["12", "12.0", "3.7", "x", None, " 7 ", "-3.7"], C.parse_id) == \
        [12, 12, 3, None, None, 7, -3]


def test_big_id_keeps_digits(spark):
    assert one_col(spark, ["9007199254740993"], C.parse_id) == [9007199254740993]


def test_dates(spark):
    got = one_col(spark, ["01/31/2023", "02/30/2023", "2023-01-31T00:00:00.000", "1/5/2023", "zz", None],
                  C.parse_date)
    assert got == [dt.date(2023, 1, 31), None, dt.date(2023, 1, 31), dt.date(2023, 1, 5), None, None]


def test_times(spark):
    assert one_col(spark, ["8:05", "23:59", "zz", "08:05:07", "25:00"], C.parse_time) == \
        ["08:05:00", "23:59:00", None, "08:05:07", None]


def test_strip_is_python_strip(spark):
    assert one_col(spark, ["\tSedan\n", " a b ", " x ", "   "], C.stripped_or_null) == \
        ["Sedan", "a b", "x", None]


def test_na_tokens(spark):
    assert one_col(spark, ["NA", "N/A", "null", "NaN", "None", "", "n/a", "ok", " NA"], C.na_to_null) == \
        [None] * 7 + ["ok", " NA"]


def test_zip(spark):
    assert one_col(spark, ["11201", "11201.0", None, "1120A"], C.parse_zip) == ["11201", "11201", None, "1120A"]


def test_coordinates(spark):
    assert one_col(spark, ["40.12345678", "1234.5", None, "abc"], C.parse_coordinate) == \
        [Decimal("40.123457"), None, None, None]


def test_counts(spark):
    assert one_col(spark, ["-1", None, "2.0", "2.5", "x"], C.parse_count) == [-1, None, 2, 3, None]


def test_clean_feed_issues_and_dropped_ids(spark):
    f = feed(spark, [
        base_row("1", latitude="1234.5"),
        base_row("2", number_of_persons_injured="-1"),
        base_row("x"),
        base_row("3", number_of_persons_killed="NA", zip_code="11201.0", borough=" BRONX\t"),
    ])
    got = {r.collision_id: r for r in N.clean_feed(f).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1]["_issues"] == ["latitude_invalid"]
    assert got[2]["_issues"] == ["number_of_persons_injured_negative"]
    assert got[3]["_issues"] == []
    assert got[3]["number_of_persons_killed"] is None
    assert got[3]["zip_code"] == "11201"
    assert got[3]["borough"] == "BRONX"


def test_only_plain_numbers_are_numbers(spark):
    odd = ["12d", "3.7f", "0x1p3", "1L", "Infinity", "NaN", "1e2", "+4", ".5", "5."]
    assert one_col(spark, odd, C.parse_id) == [None] * 6 + [100, 4, 0, 5]
    assert one_col(spark, odd, C.parse_count) == [None] * 6 + [100, 4, 1, 5]
    assert one_col(spark, odd[:4], C.parse_coordinate) == [None] * 4
