"""Pages from a kept index."""

import random

import pytest
from pyspark.sql import functions as F

from stipend.operators.pages import PageIndex, build_page_index


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    made = [(rng.randrange(40) if rng.random() < 0.6 else 7, rng.choice("abc"), n % 5) for n in range(900)]
    return [*made, *[(7, "a", 0)] * 300]


@pytest.fixture(scope="module")
def index(spark, rows, tmp_path_factory):
    df = spark.createDataFrame(rows, "k int, t string, v int").repartition(6)
    return build_page_index(df, ["k", "t"], str(tmp_path_factory.mktemp("index") / "i"))


def taken(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(("offset", "size"), [(0, 5), (3, 400), (1190, 50), (0, 5000), (1199, 1), (1200, 3), (600, 0)])
def test_pages_equal_slices(index, rows, offset, size):
    ordered = [(*r, n) for n, r in enumerate(sorted(rows), 1)]
    assert taken(index.page(offset, size)) == ordered[offset : offset + size]
    assert index.page(offset, size).columns == ["k", "t", "v", "row_no"]


def test_an_index_is_opened_again(spark, index, rows):
    again = PageIndex(spark, index.folder)
    assert again.rows == len(rows)
    assert taken(again.page(500, 20)) == taken(index.page(500, 20))
    with pytest.raises(Exception, match="already exists"):
        build_page_index(spark.createDataFrame(rows, "k int, t string, v int"), ["k"], index.folder)


def test_pages_after_a_key(index, rows):
    ordered = [(*r, n) for n, r in enumerate(sorted(rows), 1)]
    for key in ((7, "a"), (0, "a"), (-1, "z"), (7, "bb"), (39, "c"), (99, "x"), (20, "")):
        want = [r for r in ordered if r[:2] > key][:6]
        assert taken(index.page_after(key, 6, ["k", "t"])) == want, key


def scanned(df):
    """Files and rows that the scan of a page read, and whether it shuffled or wrote all rows."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves, text = plan.collectLeaves(), plan.toString()
    leaf = leaves.head()
    if "AdaptiveSparkPlan" in leaf.getClass().getName():
        leaf = leaf.executedPlan().collectLeaves().head()
    while "QueryStage" in leaf.getClass().getName():
        leaf = leaf.plan().collectLeaves().head()
    metrics = leaf.metrics()
    return metrics.apply("numFiles").value(), metrics.apply("numOutputRows").value(), text


def test_a_page_reads_its_ranges_only(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(400_000).select(F.col("id").alias("k"), F.lit("x").alias("t"))
    index = build_page_index(df, ["k"], str(tmp_path / "i"), unique=True)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(index.ranges) == 8
    page = index.page(123_456, 100)
    files, rows, plan = scanned(page)
    assert files == 1 and rows <= 100_000
    assert "rangepartitioning(k" not in plan
    assert [r.k for r in page.collect()] == list(range(123_456, 123_556))


def test_an_empty_table_has_no_pages(spark, tmp_path):
    df = spark.createDataFrame([], "k int, t string")
    index = build_page_index(df, ["k"], str(tmp_path / "i"))
    assert index.rows == 0 and index.page(0, 10).count() == 0
