"""What the registered queries do as their tables grow."""

import datetime as dt
import os

from pyspark.sql import functions as F

from checks import catalog
from stipend.operators import intervals

ORDERS = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, "
          "o_orderpriority string")
DAY = dt.date(1995, 3, 1)


class Made:
    def __init__(self, spark, **tables):
        self.spark = spark
        self.__dict__.update(tables)


def orders(spark, rows):
    made = [(n, n % 150, "O", 1.5 * n, DAY + dt.timedelta(days=n % 30), "5-LOW") for n in range(rows)]
    return spark.createDataFrame([*made, made[0], (None, None, None, None, None, None)], ORDERS).repartition(3)


def test_items_of_one_interval_are_joined_once(spark, monkeypatch):
    joined = []
    whole = intervals.binned_interval_join

    def counted(*args, **kw):
        joined.append(whole(*args, **kw))
        return joined[-1]

    monkeypatch.setattr(intervals, "binned_interval_join", counted)
    rows = [(n, 1 + n % 3, n % 20, DAY + dt.timedelta(days=n % 60)) for n in range(4000)] + [(None, 1, 7, DAY), (1, 1, None, DAY)]
    items = spark.createDataFrame(rows, "l_orderkey bigint, l_linenumber int, l_suppkey bigint, l_shipdate date")
    made = orders(spark, 400)
    got = catalog._long_intervals(Made(spark, orders=made, lineitem=items)).collect()
    want = {}
    for o in made.collect():
        if o.o_orderkey is None:
            continue
        closed = o.o_orderdate + dt.timedelta(days=o.o_orderkey % 40)
        for key, number, supplier, sent in rows:
            if supplier is not None and supplier % 100 == o.o_custkey % 100 and (
                    o.o_orderdate <= sent + dt.timedelta(days=number) and closed >= sent):
                at = (o.o_custkey % 100, o.o_orderkey, o.o_orderdate, closed)
                n, total, first = want.get(at, (0, None, sent))
                want[at] = (n + 1, total if key is None else (total or 0) + key, min(first, sent))
    assert sorted(map(tuple, got)) == sorted((*at, *sums) for at, sums in want.items())
    # 180 intervals of a group's 200 items are one row each.
    assert joined[0].count() < sum(n for n, _, _ in want.values()) / 2


def test_a_snapshot_is_published_in_files_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(catalog, "SNAPSHOT_ROWS", 100)
    region = spark.createDataFrame([(0, "AFRICA")], "r_regionkey int, r_name string")
    made = orders(spark, 1050)
    read = catalog._published_snapshot(Made(spark, orders=made, region=region))
    files = read.groupBy(F.input_file_name().alias("file")).count().collect()
    assert len(files) == 11 and max(r["count"] for r in files) == 100
    assert all(os.path.basename(r.file).startswith("orders-0000") for r in files)
    assert read.exceptAll(made).isEmpty() and made.exceptAll(read).isEmpty()
