import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stipend.operators import hot_keys, joins

DAY = dt.date(2024, 1, 1)


def skewed(rng, n):
    """Rows of which a third have key 7, many of them copies, and some none."""
    keys = [7, rng.randrange(60), rng.randrange(60)]
    return [(rng.choice([7, rng.randrange(60), rng.choice([*keys, None])]),
             DAY + dt.timedelta(days=rng.randrange(0, 300, 7)), rng.randrange(3)) for _ in range(n)]


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(1)
    right = skewed(rng, 3000)
    left = []
    for n in range(200):
        start = DAY + dt.timedelta(days=rng.randrange(-30, 320))
        end = start + dt.timedelta(days=rng.randrange(-3, 40))
        left.append((n // 2, rng.choice([7, 7, 8, 99, None]), start, rng.choice([end, end, None])))
    return (spark.createDataFrame(left, "i int, k int, s date, e date"),
            spark.createDataFrame(right, "k2 bigint, p date, v int").repartition(5))


def test_frequent_keys_are_found(spark, sides):
    counts = {r.h: r["count"] for r in sides[1].dropna().groupBy(F.xxhash64("k2").alias("h")).count().collect()}
    found = dict(hot_keys.frequent_keys(sides[1], ["k2"], 100))
    assert found == {h: n for h, n in counts.items() if n > 100} and 0 < len(found) < len(counts)
    assert hot_keys.frequent_keys(sides[1].limit(0), ["k2"], 1) == []


@pytest.mark.parametrize("rows", [10**6, 100, 1])
@pytest.mark.parametrize("most", [10**6, 0])
def test_points_equal_a_plain_join(spark, sides, monkeypatch, rows, most):
    monkeypatch.setattr(hot_keys, "MAX_POINTS", most)
    left, right = sides
    keys, inside = {"k2": F.col("k")}, ("p", F.col("s"), F.col("e"))
    plain = left.join(right, hot_keys.condition(keys, inside), "left")
    got = hot_keys.salted_left_join(left, right, keys, inside, rows)
    assert got.columns == plain.columns
    want = Counter(map(tuple, plain.collect()))
    assert Counter(map(tuple, got.collect())) == want
    assert any(r[1] == 7 and r[4] is None for r in want) and any(r[1] == 7 and r[4] == 7 for r in want)


@pytest.mark.parametrize("rows", [100, 1])
def test_months_equal_a_plain_join(sides, monkeypatch, rows):
    monkeypatch.setattr(hot_keys, "HOT_ROWS", rows)
    left, right = sides
    month = [joins.month_join(left, right, "k", "k2", "s", "p", 1, hot) for hot in (False, True)]
    assert Counter(map(tuple, month[0].collect())) == Counter(map(tuple, month[1].collect()))


def test_empty_sides(sides):
    left, right = sides
    keys = {"k2": F.col("k")}
    assert hot_keys.salted_left_join(left.limit(0), right, keys, rows=10).isEmpty()
    alone = hot_keys.salted_left_join(left, right.limit(0), keys, rows=10).collect()
    assert len(alone) == 200 and all(r.k2 is None for r in alone)


def test_left_side_is_computed_once_and_hot_rows_are_spread(spark, sides, tmp_path):
    left, right = sides
    left.write.parquet(str(tmp_path / "left"))
    left = spark.read.parquet(str(tmp_path / "left"))
    keys, inside = {"k2": F.col("k")}, ("p", F.col("s"), F.col("e"))
    for rows in (10**6, 100):
        plan = hot_keys.salted_left_join(left, right, keys, inside, rows)._jdf.queryExecution()
        assert plan.executedPlan().toString().count("/left") == 1
    # Copies of one row, a third of all, do not share a salt.
    copies = spark.createDataFrame([(7, DAY, 1)] * 900, right.schema)
    hot = copies.withColumn("at", F.pmod(F.monotonically_increasing_id(), F.lit(8)))
    sizes = [r["count"] for r in hot.groupBy("at").count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * min(sizes)
