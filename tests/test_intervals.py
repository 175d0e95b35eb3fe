"""Interval joins in bins against brute force, and how many pairs they compare."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stipend.operators import intervals, joins

DAY = dt.date(2015, 1, 1)
LEFT, RIGHT = "k int, i int, s date, e date", "k2 int, j int, s2 date, e2 date, `_bin` int"
ARGS = ("k", "k2", ("s", "e"), ("s2", "e2"))


def made(rng, n, keys, length):
    out = []
    for i in range(n):
        start = DAY + dt.timedelta(days=rng.randrange(3650))
        end = start + dt.timedelta(days=rng.randrange(-3, length))
        out.append((rng.choice(keys), i, start, end))
    far = [(dt.date(1900, 1, 1), dt.date(9999, 12, 31)), (None, DAY), (DAY, None), (dt.date(1800, 1, 1), dt.date(1801, 1, 1))]
    return out + [(keys[0], n + m, *ends) for m, ends in enumerate(far)]


def sides(spark, left, right):
    return (spark.createDataFrame(left, LEFT).repartition(3),
            spark.createDataFrame([(*r, 9) for r in right], RIGHT).repartition(3))


def expected(left, right):
    return sorted(
        (a[1], b[1]) for a in left for b in right
        if None not in (a[0], a[2], a[3], b[2], b[3]) and a[0] == b[0] and a[2] <= b[3] and a[3] >= b[2])


@pytest.mark.parametrize("crowded", [0, 2000, 10**9])
def test_binned_join_equals_brute_force(spark, crowded):
    rng = random.Random(6)
    left, right = made(rng, 150, [1, 1, 2, None, 5], 40), made(rng, 200, [1, 1, 1, 2, 3], 25)
    got = intervals.binned_interval_join(*sides(spark, left, right), *ARGS, crowded=crowded)
    assert got.columns == ["k", "i", "s", "e", "k2", "j", "s2", "e2", "_bin"]
    assert sorted((r.i, r.j) for r in got.collect()) == expected(left, right)
    some = intervals.binned_interval_join(*sides(spark, left, right), *ARGS, F.col("j") % 2 == 0, crowded)
    assert sorted((r.i, r.j) for r in some.collect()) == [p for p in expected(left, right) if p[1] % 2 == 0]
    none = intervals.binned_interval_join(*sides(spark, left, [])[:2], *ARGS, crowded=crowded)
    assert none.count() == 0


def test_months_over_ten_years_meet_far_fewer(spark):
    rng = random.Random(2)
    left = [(1, n, DAY + dt.timedelta(days=30 * n), DAY + dt.timedelta(days=30 * n + 29)) for n in range(120)]
    right = [(1, n, *(DAY + dt.timedelta(days=d) for d in (s, s + rng.randrange(60)))) for n in range(300)
             for s in [rng.randrange(3600)]]
    l, r = sides(spark, left, right)
    binned = intervals.with_bins(l, r, *ARGS, crowded=1000)
    met = binned[0].join(binned[1], (F.col("k") == F.col("k2")) & (F.col("_bin_l") == F.col("_bin_r"))).count()
    assert 5 * met <= len(left) * len(right)
    got = intervals.binned_interval_join(l, r, *ARGS, crowded=1000)
    assert sorted((x.i, x.j) for x in got.collect()) == expected(left, right)


def test_one_month_periods_are_joined_as_before(spark):
    month = (DAY, DAY + dt.timedelta(days=29))
    left = [(n % 3, n, *month) for n in range(60)]
    right = [(n % 3, n, DAY - dt.timedelta(days=n), DAY + dt.timedelta(days=n)) for n in range(90)]
    l, r = sides(spark, left, right)
    assert intervals.with_bins(l, r, *ARGS, crowded=10) is None
    plans = [df._jdf.queryExecution().optimizedPlan().toString().count("Join") for df in (
        intervals.binned_interval_join(l, r, *ARGS, crowded=10), joins.interval_join(l, r, *ARGS))]
    assert plans == [1, 1]


def test_numbers_and_timestamps(spark):
    left = spark.createDataFrame([(1, n, 10 * n, 10 * n + 12) for n in range(80)], "k int, i int, s int, e int")
    right = spark.createDataFrame([(1, n, 7 * n, 7 * n + 3) for n in range(110)], "k2 int, j int, s2 int, e2 int")
    got = intervals.binned_interval_join(left, right, *ARGS, crowded=10)
    want = sorted((a, b) for a in range(80) for b in range(110) if 10 * a <= 7 * b + 3 and 10 * a + 12 >= 7 * b)
    assert sorted((r.i, r.j) for r in got.collect()) == want
