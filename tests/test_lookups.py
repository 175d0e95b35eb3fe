import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stipend.operators import lookups
from stipend.operators.recode import one_pass, recode
from stipend import fixed_values as fixed

RATES = "rate decimal(14,4), begda date, endda date"


def rates(spark, *months):
    rows = [(Decimal(r), dt.date(2024, m, 1), dt.date(2024, m, 28)) for r, m in months]
    return spark.createDataFrame(rows, RATES)


def as_of(spark, table, text):
    column = lookups.value_as_of(table, F.lit(text).cast("date"), "rate")
    return spark.range(1).select(column.alias("rate")).collect()[0].rate


def test_value_as_of(spark):
    table = rates(spark, ("0.0450", 1), ("0.0500", 2))
    assert as_of(spark, table, "2024-01-01") == Decimal("0.0450")
    assert as_of(spark, table, "2024-02-28") == Decimal("0.0500")
    assert as_of(spark, table, "2024-03-01") is None


def test_value_as_of_must_be_unique(spark):
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        as_of(spark, rates(spark, ("0.0450", 1), ("0.0500", 1)), "2024-01-05")


def test_previous_month_is_a_date(spark):
    row = spark.range(1).select(lookups.previous_month().alias("d"), F.current_date().alias("t")).first()
    assert 28 <= (row.t - row.d).days <= 31


def test_band_table(spark):
    rows = lookups.band_table(rates(spark, ("0.0450", 1))).orderBy("band").collect()
    got = [(str(r.low), str(r.high), r.band) for r in rows]
    assert got == [
        ("0.0000", "0.0449", 1), ("0.0450", "0.0549", 2), ("0.0550", "0.0649", 3),
        ("0.0650", "0.0749", 4), ("0.0750", "0.0849", 5), ("0.0850", "0.0949", 6),
        ("0.0950", "2000.0000", 7),
    ]


def test_tariff_lookup_defaults_to_zero(spark):
    tariff = spark.createDataFrame(
        [(1, 2, 3, Decimal("10.00"), Decimal("20.00"), Decimal("30.00"))],
        "case_id int, focus int, band int, pay_leader decimal(14,2), pay_manager decimal(14,2), "
        "pay_leader_focus decimal(14,2)")
    pairs = spark.createDataFrame(
        [("both", 1, 2, 2, 3), ("b", 1, 0, 2, 3), ("no band", 1, 2, 2, None)],
        "n string, case_id int, focus_a int, focus_b int, band int")
    got = {r.n: tuple(map(float, r[5:])) for r in lookups.tariff_lookup(pairs, tariff).collect()}
    assert got == {
        "both": (20.0, 10.0, 30.0, 20.0), "b": (20.0, 10.0, 30.0, 0.0), "no band": (0.0,) * 4}


def test_recode_is_whole_cell_and_keeps_nulls(spark):
    df = spark.createDataFrame(
        [("OXX TEPIC", 1), ("oxx tepic", 2), ("OXX TEPIC 2", 3), (None, 4), ("10GTO Leon", None)],
        "a string, b int")
    got = [tuple(r) for r in recode(df, fixed.PLACE_NAMES + fixed.DIVISION_NAMES).collect()]
    assert got == [("OXXO GUADALAJARA ORIENTE", "1"), ("oxx tepic", "2"), ("OXX TEPIC 2", "3"),
                   (None, "4"), ("10GTO Leon Norte", None)]
    filled = recode(df, [], null_text="nan").collect()
    assert (filled[3].a, filled[4].b) == ("nan", "nan")


def test_recode_twice_changes_nothing(spark):
    pairs = fixed.PLACE_NAMES + fixed.DIVISION_NAMES
    df = spark.createDataFrame([(old,) for old, _ in pairs] + [(new,) for _, new in pairs], "a string")
    once = recode(df, pairs)
    assert recode(once, pairs).collect() == once.collect()
    assert once.exceptAll(df.filter("false")).count() == len(pairs) * 2


def test_one_pass_equals_the_sequence():
    pairs = [("a", "b"), ("b", "c"), ("x", "a"), ("c", "d"), ("a", "z")]
    mapping = one_pass(pairs)
    for start in "abcdxyz":
        value = start
        for old, new in pairs:
            value = new if value == old else value
        assert mapping.get(start, start) == value


def test_recode_columns_with_dots(spark):
    df = spark.createDataFrame([("a", "a")], "`x.y` string, z string")
    assert recode(df, [("a", "b")]).collect()[0].asDict() == {"x.y": "b", "z": "b"}
