import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stipend.operators import latest

SCHEMA = "id int, LGART string, ZSTAT string, DATUM date, ZUTIMER string"


def day(n):
    return dt.date(2024, 5, n)


ROWS = [
    (1, "A", "N", day(1), "09:00:00"),
    (2, "A", "N", day(2), "08:00:00"),
    (3, "A", "N", day(2), "10:00:00"),
    (4, "A", "N", day(2), "10:00:00"),
    (5, "A", "P", day(2), "10:00:00"),
    (6, "A", "P", day(3), "23:00:00"),
    (7, "A", "N", None, "23:00:00"),
    (8, "A", "N", day(2), None),
    (9, "B", "N", day(2), "10:00:00"),
    (10, "B", "P", day(2), "11:00:00"),
    (11, "C", "N", day(4), None),
    (12, None, "N", day(9), "01:00:00"),
]


@pytest.fixture
def records(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_strict_keeps_ties(records):
    assert ids(latest.latest_batch(records, "A")) == [3, 4]


def test_loose_is_empty_when_the_newest_run_is_processed(records):
    assert ids(latest.latest_batch(records, "B")) == [9]
    assert ids(latest.latest_batch(records, "B", strict=False)) == []
    assert ids(latest.latest_batch(records, "A", strict=False)) == [3, 4]


def test_null_time_and_unknown_category(records):
    assert ids(latest.latest_batch(records, "C")) == []
    assert ids(latest.latest_batch(records, "Z")) == []


def test_all_categories(records):
    assert ids(latest.latest_batch(records)) == [12]
    assert ids(latest.latest_batch(records.filter("LGART is not null"))) == []
    assert ids(latest.latest_batch(records.filter("LGART < 'C'"))) == [3, 4, 9]


@pytest.mark.parametrize("strict", [True, False])
def test_by_category_equals_one_run_per_category(records, strict):
    expected = [
        i for c in "ABC" for i in ids(latest.latest_batch(records, c, strict=strict))
    ]
    got = latest.latest_batch_by(records, strict=strict)
    assert got.columns == records.columns
    assert ids(got) == sorted(expected)


def test_by_category_without_rows(records):
    assert ids(latest.latest_batch_by(records.filter("id < 0"))) == []


def test_dates_reach_the_scan(spark, records, tmp_path):
    records.write.parquet(str(tmp_path / "r"))
    batch = latest.latest_batch(spark.read.parquet(str(tmp_path / "r")), "A")
    assert ids(batch) == [3, 4]
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "ReusedSubquery" in plan
    assert "Join" not in plan


def test_partitioned_by_date(spark, records, tmp_path):
    records.write.partitionBy("DATUM").parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    assert ids(latest.latest_batch(stored, "A")) == [3, 4]
    assert ids(latest.latest_batch_by(stored)) == [3, 4, 9]


def test_newest_per_family(spark):
    rows = [("a", 1, 10), ("a", 2, 11), ("a", 2, 12), ("b", 1, 13), ("c", None, 14)]
    df = spark.createDataFrame(rows, "family string, run int, id int")
    assert ids(latest.newest_per_family(df, "family", "run")) == [11, 12, 13]


def test_row_count(records):
    assert latest.row_count(records).collect()[0].row_count == len(ROWS)


@pytest.mark.parametrize("strict", [True, False])
def test_times_of_any_form_by_category(spark, strict):
    rng = random.Random(8)
    times = ["10:00:00", "09:59:59", "23:00:00", "9:00:00", "24:00", "", "noon", "10:00:00 ", "99:99:99", None]
    rows = [(rng.choice("abcd"), rng.choice(["2024-01-01", "2024-01-02", None]), rng.choice(times),
             rng.choice(["N", "P", None]), n) for n in range(300)]
    df = spark.createDataFrame(rows, "LGART string, DATUM string, ZUTIMER string, ZSTAT string, n int").repartition(4)
    got = latest.latest_batch_by(df, strict=strict)
    assert got.columns == df.columns
    want = set()
    for c in "abcd":
        want |= {r.n for r in latest.latest_batch(df, c, strict).collect()}
    assert {r.n for r in got.collect()} == want and want


def test_newest_batches_take_two_scans(spark, tmp_path, monkeypatch):
    df = spark.range(100).select(
        F.lit("a").alias("LGART"), F.lit("2024-01-01").cast("date").alias("DATUM"), F.lit("10:00:00").alias("ZUTIMER"),
        F.lit("N").alias("ZSTAT"), "id")
    df.write.parquet(str(tmp_path / "r"))
    plans, plain = [], latest.stage

    def seen(rows, label):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return plain(rows, label)

    monkeypatch.setattr(latest, "stage", seen)
    got = latest.latest_batch_by(spark.read.parquet(str(tmp_path / "r")), strict=False)
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    location = str(tmp_path / "r")
    assert [plan.count(f"[file:{location}]") for plan in plans] == [1, 0, 1]
    assert "SortAggregate" not in plans[0] and got.count() == 100
