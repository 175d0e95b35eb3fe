import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stipend.functions import amounts, codes, dates


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def day(text):
    return dt.date.fromisoformat(text)


def test_money_text(spark):
    rows = [("1.015",), ("2.675",), ("0.125",), ("-0.004",), (None,), ("7",), ("NaN",), ("1e3",)]
    got = values(spark, rows, "v string", amounts.money_text(F.col("v")))
    assert got == ["1.01", "2.68", "0.12", "-0.00", None, "7.00", None, "1000.00"]


def test_money_text_rejects_other_text(spark):
    with pytest.raises(PySparkException):
        values(spark, [("abc",)], "v string", amounts.money_text(F.col("v")))


def test_int_trunc(spark):
    rows = [("15",), ("15.9",), ("-3.9",), (None,), ("NaN",)]
    assert values(spark, rows, "v string", amounts.int_trunc(F.col("v"))) == [15, 15, -3, None, None]


def test_growth(spark):
    rows = [(10.0, None), (None, 10.0), (10.0, 0.0), (10.0, 10.0), (15.0, 10.0), (None, None)]
    got = values(spark, rows, "c double, p double", amounts.growth(F.col("c"), F.col("p")))
    assert got == [-1.0, -1.0, -1.0, 0.0, 0.5, -1.0]


def test_growth_over_zero_as_floating_point(spark):
    rows = [(10.0, 0.0), (-1.0, 0.0), (None, 0.0), (10.0, None), (15.0, 10.0), (0.0, 0.0)]
    got = values(
        spark, rows, "c double, p double", amounts.growth(F.col("c"), F.col("p"), zero_as_missing=False))
    assert got[:-1] == [float("inf"), float("-inf"), -1.0, -1.0, 0.5] and math.isnan(got[-1])
    bands = codes.growth_band(F.col("g"), F.lit(Decimal("0.0450")))
    assert values(spark, [(g,) for g in got], "g double", bands)[:2] == [None, 1]
    assert values(spark, [(got[-1],)], "g double", bands) == [None]


def test_growth_of_decimals_is_a_double_division(spark):
    rows = [(Decimal("10.00"), Decimal("3.00"))]
    got = values(
        spark, rows, "c decimal(14,2), p decimal(14,2)", amounts.growth(F.col("c"), F.col("p"))
    )
    assert got == [10.0 / 3.0 - 1.0]


def test_month_shift_keeps_to_the_month_end(spark):
    rows = [(day("2024-03-31"),), (day("2023-03-31"),), (day("2024-02-29"),)]
    assert values(spark, rows, "d date", dates.shift_months(F.col("d"), -1)) == [
        day("2024-02-29"), day("2023-02-28"), day("2024-01-29")]
    assert values(spark, rows, "d date", dates.shift_months(F.col("d"), -12))[2] == day("2023-02-28")


def test_interval_days(spark):
    rows = [(day("2024-02-01"), day("2024-02-29")), (day("2024-02-05"), day("2024-02-05"))]
    schema = "s date, e date"
    assert values(spark, rows, schema, dates.days_inclusive(F.col("s"), F.col("e"))) == [29, 1]
    share = dates.proration(F.col("s"), F.col("e"), F.col("s"))
    assert values(spark, rows, schema, share) == [1.0, 1.0 / 29.0]


def test_overlaps_is_closed(spark):
    rows = [(day("2024-01-31"), day("2024-02-01")), (day("2024-01-01"), day("2024-01-31")),
            (day("2024-03-01"), day("2024-03-02")), (day("2024-02-29"), day("2024-03-02"))]
    month = [F.lit(d).cast("date") for d in ("2024-02-01", "2024-02-29")]
    got = values(spark, rows, "s date, e date", dates.overlaps(F.col("s"), F.col("e"), *month))
    assert got == [True, False, False, True]


def test_dates_from_and_to_text(spark):
    rows = [("2024-05-06",), ("no date",), (None,)]
    assert values(spark, rows, "v string", dates.iso_date(dates.as_date(F.col("v")))) == [
        "2024-05-06", None, None]


def test_focus_code(spark):
    rows = [("E",), ("I",), ("C",), ("D",), ("X",), ("e",), (None,)]
    assert values(spark, rows, "v string", codes.focus_code(F.col("v"))) == [1, 2, 3, 4, 0, 0, 0]


def test_area_default(spark):
    rows = [(None, "L"), (None, "EA"), (None, "EB"), ("7", "EB")]
    got = values(spark, rows, "a string, t string", codes.area_default(F.col("a"), F.col("t")))
    assert got == ["NP", "NP", "3781", "7"]


def test_growth_band_edges(spark):
    rows = [(v,) for v in (0.0, 0.0449, 0.04495, 0.0450, 0.0549, 0.055, 0.0949, 0.095, 2000.0,
                           2000.5, -0.2, None)]
    got = values(spark, rows, "g double", codes.growth_band(F.col("g"), F.lit(Decimal("0.0450"))))
    assert got == [1, 1, None, 2, 2, 3, 6, 7, 7, None, 1, 1]
