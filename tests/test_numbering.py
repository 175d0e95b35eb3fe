import random

import pytest
from pyspark.sql import functions as F

from stipend.operators import numbering


def rows_of(n, seed=7, copies=0.3):
    """Rows with nulls, equal keys, and one row that makes up `copies` of all."""
    rng = random.Random(seed)
    hot = (1, "hot", 0.5)
    return [
        hot if rng.random() < copies
        else (rng.choice([None, 1, 2, 3, 4]), rng.choice(["a", "b", None, "c"]), rng.random())
        for _ in range(n)
    ]


def key(row):
    """Sort key of a row, nulls last."""
    return [(v is None, str(v) if isinstance(v, str) else (v or 0)) for v in row]


@pytest.fixture(scope="module")
def frame(spark):
    rows = rows_of(3000)
    return rows, spark.createDataFrame(rows, "k int, t string, v double").repartition(7)


def test_row_numbers_follow_the_total_order(frame):
    rows, df = frame
    numbered = sorted(numbering.number_rows(df, ["k"]).collect(), key=lambda r: r.row_no)
    assert [r.row_no for r in numbered] == list(range(1, len(rows) + 1))
    assert [key(r[:3]) for r in numbered] == sorted(key(r) for r in rows)


def test_copies_are_spread_over_ranges(spark):
    """A row that makes up most of the table is split: no range may hold all its copies."""
    rows = [(1, "x")] * 5000 + [(2, "y")] * 50
    df = spark.createDataFrame(rows, "k int, t string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = numbering.number_rows(df, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(numbered.inputFiles()[0].rpartition("/")[0])
    sizes = stored.groupBy(F.shiftright("_place", 33)).count().collect()
    assert sum(r["count"] for r in sizes) == 5050
    assert max(r["count"] for r in sizes) < 2000
    assert sorted(r.row_no for r in numbered.collect()) == list(range(1, 5051))


@pytest.mark.parametrize("count, sizes", [
    (0, []), (1, [1]), (100, [100]), (101, [100, 1]), (200, [100, 100]),
])
def test_batch_sizes(spark, count, sizes):
    df = spark.range(count).withColumnRenamed("id", "k")
    batched = numbering.assign_batches(df, ["k"], 100, unique=True)
    manifest = numbering.batch_manifest(batched, ["k"], 100).orderBy("batch_no").collect()
    assert [r.rows for r in manifest] == sizes
    assert [r.first_k for r in manifest] == [100 * i for i in range(len(sizes))]
    assert [r.last_k for r in manifest] == [100 * i + n - 1 for i, n in enumerate(sizes)]


def test_manifest_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "k int, z string")
    batched = numbering.assign_batches(df, ["k"], 10)
    (row,) = numbering.batch_manifest(batched, ["k"], 10, ("z",)).collect()
    assert (row.rows, row.first_k, row.last_k, row.z_nulls) == (3, 1, 3, 2)


def test_batches_need_no_window(frame):
    _, df = frame
    batched = numbering.assign_batches(df, ["k"], 100)
    plan = batched._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("offset", [0, 500])
def test_page_comes_in_order(frame, offset):
    rows, df = frame
    got = numbering.page(df, ["k"], offset, 40).collect()
    assert [r.row_no for r in got] == list(range(offset + 1, offset + 41))
    assert [key(r[:-1]) for r in got] == sorted(key(r) for r in rows)[offset : offset + 40]


def test_page_past_the_end(frame):
    rows, df = frame
    assert numbering.page(df, ["k"], len(rows) + 5, 10).count() == 0
    assert numbering.page(df, ["k"], len(rows) - 3, 10).count() == 3


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, `x.y` string")
    assert [tuple(r) for r in numbering.number_rows(df, ["k"]).orderBy("row_no").collect()] == [
        (1, "a", 1), (2, "b", 2)]


def test_pages_join_up_over_the_ranges(spark):
    """Every page, however the rows fall into ranges, of which some are empty."""
    df = spark.createDataFrame([(i // 40,) for i in range(120)], "k int").repartition(3)
    for size in (1, 7, 50, 500):
        got = [r for at in range(0, 130, size) for r in numbering.page(df, ["k"], at, size).collect()]
        assert [(r.k, r.row_no) for r in got] == [(i // 40, i + 1) for i in range(120)]
        if size == 1:
            assert numbering.page(df, ["k"], 0, 0).isEmpty()


def test_a_page_leaves_only_itself(frame, shared):
    _, df = frame
    got = numbering.page(df, ["k"], 10, 20)
    assert [p.name.partition("-")[0] for p in shared.iterdir()] == ["page"]
    assert got.count() == 20


def test_manifest_reads_twice_and_joins_nothing(frame):
    _, df = frame
    manifest = numbering.batch_manifest(numbering.assign_batches(df, ["k"], 100), ["k"], 100, ("t",))
    plan = manifest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "Join" not in plan
