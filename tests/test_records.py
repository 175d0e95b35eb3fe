"""Delimited text whose records cross line breaks, read by many tasks."""

import csv
import io
import random

import pytest

from stipend.sources import records, tables


@pytest.fixture
def split_bytes(spark):
    """Sets how many bytes of a file a task reads."""
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield cut
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


def written(tmp_path, body, name="t.csv"):
    file = tmp_path / name
    file.write_bytes(body.encode())
    return str(file)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("size", [4, 1 << 20])
def test_quoted_line_breaks_are_read_whole(spark, tmp_path, split_bytes, size):
    split_bytes(size)
    path = written(tmp_path, 'a,b\n1,"x\n5,y"\n3,4\n')
    assert rows_of(tables.load_text_csv(spark, path)) == [("1", "x\n5,y"), ("3", "4")]
    path = written(tmp_path, 'a\n"x\ny"\nz\n', "one.csv")
    assert rows_of(tables.load_csv(spark, path, "a string", header=False)) == [("a",), ("x\ny",), ("z",)]


def made(rng, rows, end):
    cells = ["", "1", "a b", 'q"q', '"', '""', "x;y", "l\nm", "\n", "\n\n;", 'a"\n"b', "é\n", " pad ", "5\" x", "c\r\nd"]
    body = io.StringIO()
    writer = csv.writer(body, delimiter=";", lineterminator=end)
    writer.writerow(["first", 'second\n"name"', "third"])
    table = [[rng.choice(cells) for _ in range(3)] for _ in range(rows)]
    writer.writerows(table)
    return body.getvalue(), table


@pytest.mark.parametrize(("size", "end"), [(24, "\r\n"), (60, "\n")])
def test_any_split_gives_the_same_rows(spark, tmp_path, split_bytes, size, end):
    body, table = made(random.Random(size), 20, end)
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(2):
        written(folder, body, f"{n}.csv")
    split_bytes(size)
    got = tables.load_text_csv(spark, str(folder), ";")
    assert got.columns == ["first", 'second\n"name"', "third"]
    want = sorted([tuple(c or None for c in row) for row in table] * 2, key=str)
    assert rows_of(got) == want


def test_quotes_inside_bare_cells_open_nothing(spark, tmp_path, split_bytes):
    split_bytes(4)
    path = written(tmp_path, 'a,b\n1,5" x\n5,y"\n3,"p\nq"\n6,7" z\n')
    assert rows_of(tables.load_text_csv(spark, path)) == [("1", '5" x'), ("3", "p\nq"), ("5", 'y"'), ("6", '7" z')]


@pytest.mark.parametrize("body", [
    'a,b\n1,"x\n5,y\n3,4\n', 'a,b\n1,"x\ny"\n2\n', 'a,b\n1,"x\ny"\n2,3\r4,5\n'])
def test_broken_files_are_errors(spark, tmp_path, split_bytes, body):
    split_bytes(9)
    path = written(tmp_path, body)
    with pytest.raises(Exception, match="not closed|MALFORMED|carriage return"):
        tables.load_text_csv(spark, path).collect()


def test_typed_cells_and_errors_in_them(spark, tmp_path, split_bytes):
    split_bytes(6)
    path = written(tmp_path, 'n,t\n7,"x\ny"\nword,z\n')
    with pytest.raises(Exception, match="MALFORMED"):
        tables.load_csv(spark, path, "n int, t string").collect()
    schema = spark.createDataFrame([], "`odd name` string, t string").schema
    got = tables.load_csv(spark, path, schema)
    assert got.columns == ["odd name", "t"] and rows_of(got) == [("7", "x\ny"), ("word", "z")]


def test_files_without_such_cells_are_read_line_by_line(spark, tmp_path):
    df = tables.load_text_csv(spark, written(tmp_path, 'a,b\n1,"x, y"\n"2 ""q""",\n\n'))
    assert rows_of(df) == [("1", "x, y"), ('2 "q"', None)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" in plan and "Exchange" not in plan


def test_long_cells_need_no_deep_stack(spark, tmp_path, split_bytes):
    split_bytes(1 << 18)
    cell = ('z""' * 50_000 + "\n") * 4
    path = written(tmp_path, f'a,b\n1,"{cell}"\n2,{"," .join(["w"])}\n')
    assert sorted(len(r.b) for r in tables.load_text_csv(spark, path).collect()) == [1, len(cell) - 200_000]


def test_one_long_record_over_many_splits(spark, tmp_path, split_bytes):
    split_bytes(256)
    cell = "\n".join(f"line {n}, of it" for n in range(300))
    path = written(tmp_path, f'a,b\n0,start\n1,"{cell}"\n2,end\n')
    assert records.read_lines(spark, path).rdd.getNumPartitions() > 10
    assert rows_of(tables.load_text_csv(spark, path)) == [("0", "start"), ("1", cell), ("2", "end")]
