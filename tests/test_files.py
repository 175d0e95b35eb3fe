"""Sources, sinks and the jobs that read and write files."""

import datetime as dt
import hashlib
import os
import re
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stipend import fixed_values as fixed
from stipend.__main__ import main
from stipend.functions.amounts import money_text
from stipend.operators.numbering import assign_batches
from stipend.plans import incentive, publish, recoding, snapshots
from stipend.sinks import delimited, folders, tables as table_sinks
from stipend.sources import snapshots as snapshot_source, tables


def files(folder):
    return sorted(f for f in os.listdir(folder) if not f.startswith("."))


def content(folder):
    """Text of a folder of parts, in order."""
    parts = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    return b"".join(open(os.path.join(folder, p), "rb").read() for p in parts)


def record(i, category="115K", **values):
    row = dict.fromkeys(fixed.RECORD_COLUMNS)
    row |= {
        "PERNR": f"{i:05d}", "LGART": category, "BEGDA": "2024-05-01", "ANZHL": f"{i}.015",
        "BETRG": "0.125", "DATUM": "2024-05-31", "ZUTIMER": "10:00:00", "ZSTAT": "N", "ZINFOTIPO": "15.9",
        "ZDESCST": f'say "{i}"; or, so', "ZUORD": "  padded ", "ZFPROC": "",
    }
    return row | values


def records(spark, rows):
    schema = ", ".join(f"{c} string" for c in fixed.RECORD_COLUMNS)
    return spark.createDataFrame([tuple(r[c] for c in fixed.RECORD_COLUMNS) for r in rows], schema)


def expected_text(rows, sep, formatted):
    """The bytes pandas writes for the same rows."""
    frame = pd.DataFrame(rows, columns=fixed.RECORD_COLUMNS, dtype=object)
    if formatted:
        for c in ("ANZHL", "BETRG"):
            frame[c] = frame[c].astype(float).round(2)
        frame["ZINFOTIPO"] = frame["ZINFOTIPO"].astype(float).astype(int)
    return frame.to_csv(index=False, sep=sep, float_format="%.2f", lineterminator="\n").encode()


@pytest.mark.parametrize("name", publish.PROFILES)
def test_publish_writes_the_same_bytes_as_pandas(spark, tmp_path, name):
    profile = publish.PROFILES[name]
    category = profile.category or "115K"
    rows = [record(i, category) for i in range(7)]
    rows[3]["BETRG"], rows[4]["ANZHL"] = None, "-0.004"
    other = [record(8, category, ZUTIMER="09:00:00"), record(9, "ZZZZ", DATUM="2024-05-01"),
             record(10, category, ZSTAT="P", DATUM="2024-06-01")]
    manifest = publish.publish_latest_batch(spark, records(spark, rows + other), profile, str(tmp_path))
    file = f"{profile.prefix}-1.{profile.ext}"
    folder = tmp_path / profile.prefix
    assert files(tmp_path) == [profile.prefix] and files(folder) == [file]
    assert (folder / file).read_bytes() == expected_text(rows, profile.sep, profile.formatted)
    (line,) = manifest.collect()
    assert (line.file, line.rows, line.first_PERNR, line.last_PERNR, line.ZINFOTIPO_nulls) == (
        file, 7, "00000", "00006", 0)


def test_a_null_integer_is_reported_and_written_empty(spark, tmp_path):
    df = records(spark, [record(1), record(2, ZINFOTIPO=None)])
    (line,) = publish.publish_latest_batch(spark, df, publish.PROFILES["categoria"], str(tmp_path)).collect()
    assert line.ZINFOTIPO_nulls == 1
    lines = (tmp_path / "ReplicaICMVS-Categoria" / "ReplicaICMVS-Categoria-1.txt").read_text().splitlines()
    assert [x.rsplit(";", 1)[1] for x in lines] == ["ZINFOTIPO", "15", ""]


def test_nothing_to_publish_writes_no_file(spark, tmp_path):
    df = records(spark, [record(1, ZSTAT="P")])
    manifest = publish.publish_latest_batch(spark, df, publish.PROFILES["categoria"], str(tmp_path))
    assert manifest.count() == 0 and files(tmp_path) == []


@pytest.mark.parametrize("count, sizes", [(0, []), (1, [1]), (10, [10]), (11, [10, 1]), (20, [10, 10])])
def test_export_sizes_and_order(spark, tmp_path, count, sizes):
    folder = tmp_path / "x"
    folder.mkdir()
    (folder / "x-9.txt").write_text("old")
    (tmp_path / "y-9.txt").write_text("kept")
    df = spark.range(count).select(F.col("id").alias("k"), F.lit("v").alias("v")).repartition(3)
    batched = assign_batches(df, ["k"], 10)
    assert delimited.export_batches(batched, str(tmp_path), "x") == len(sizes)
    assert files(tmp_path) == ["x", "y-9.txt"][not sizes :]
    seen = []
    for i, size in enumerate(sizes):
        header, *lines = (folder / f"x-{i + 1}.txt").read_text().splitlines()
        assert header == "k;v" and len(lines) == size
        seen += [int(line.split(";")[0]) for line in lines]
    assert seen == list(range(count))
    if sizes:
        assert files(folder) == [f"x-{i + 1}.txt" for i in range(len(sizes))]


def test_delimited_text_equals_pandas(spark, tmp_path):
    rows = [("a;b", 'q"q', "  pad ", None, "#x"), ("", "é", "line\nbreak", "x,y", "'"), ("-", "\\", "a\\", "1", "#")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string").coalesce(1)
    delimited.write_delimited(df, str(tmp_path / "t"), ";")
    expected = pd.DataFrame(rows, columns=list("abcde")).to_csv(index=False, sep=";", lineterminator="\n")
    assert content(tmp_path / "t").decode() == expected


def test_typed_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text('x,y,z\n1,"a ""b"", c",2024-01-31\n,,\n')
    df = tables.load_csv(spark, str(tmp_path / "t.csv"), "n int, t string, d date")
    assert [tuple(r) for r in df.collect()] == [(1, 'a "b", c', dt.date(2024, 1, 31)), (None, None, None)]
    (tmp_path / "bad.csv").write_text("n\nword\n")
    with pytest.raises(Exception):
        tables.load_csv(spark, str(tmp_path / "bad.csv"), "n int").collect()


def test_text_csv_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes("﻿plaza,n\n10GTO Leon,007\n".encode())
    df = tables.load_text_csv(spark, str(tmp_path / "t.csv"))
    assert df.columns == ["plaza", "n"] and df.collect()[0].n == "007"


def test_recode_file(spark, tmp_path):
    source = tmp_path / "Venta.csv"
    source.write_bytes('﻿plaza,division,v\n10GTO Leon,Oxxo Humaya,1\n"x, y",,2\n'.encode())
    out = recoding.recode_file(spark, str(source))
    assert out == str(tmp_path / "Venta_LIMPIO.csv")
    assert content(out).decode() == 'plaza,division,v\n10GTO Leon Norte,OXXO CULIACAN SUR,1\n"x, y",,2\n'
    out = recoding.recode_file(spark, str(source), str(tmp_path / "o"), null_text="nan")
    assert content(out).decode().splitlines()[2] == '"x, y",nan,2'


def test_replica_projects_the_record_columns(spark, tmp_path):
    df = records(spark, [record(1)]).withColumn("EffStart_", F.lit(1))
    df.write.parquet(str(tmp_path / "p"))
    got = tables.replica(spark, str(tmp_path / "p"))
    assert got.columns == fixed.RECORD_COLUMNS and got.count() == 1
    plan = got.select("LGART")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<LGART:string>" in plan
    df.createOrReplaceTempView("some_records")
    assert tables.replica(spark, "some_records", fmt="table").columns == fixed.RECORD_COLUMNS


def test_refresh_replaces_tables(spark, tmp_path):
    for n in (5, 3):
        table_sinks.refresh_tables({"one": spark.range(n), "two": spark.range(1)}, str(tmp_path))
        table_sinks.refresh_tables({"refreshed_table": spark.range(n)})
    assert spark.read.parquet(str(tmp_path / "one")).count() == 3
    assert spark.table("refreshed_table").count() == 3


def dated(path, text, seconds):
    path.write_bytes(text)
    os.utime(path, (seconds, seconds))


def test_newest_snapshot(spark, tmp_path):
    dated(tmp_path / "AA-1.txt", b"1", 1_000)
    dated(tmp_path / "xAA-2.txt", b"2", 3_000)
    dated(tmp_path / "AA-3.csv", b"3", 9_000)
    dated(tmp_path / "BB-1.txt", b"4", 2_000)
    dated(tmp_path / "BB-2.txt", b"5", 2_000)
    (tmp_path / "sub").mkdir()
    dated(tmp_path / "sub" / "AA-9.txt", b"6", 9_000)
    got = {r.family: r.path.rpartition("/")[2] for r in
           snapshot_source.newest_snapshot(spark, str(tmp_path), ["AA", "BB", "CC"]).collect()}
    assert got == {"AA": "xAA-2.txt", "BB": "BB-2.txt"}


def test_publish_newest(spark, tmp_path):
    text = "a|b\r\nñ|2\r\nlast".encode("latin-1")
    dated(tmp_path / "XXICMSALDOS2-old.txt", b"old", 1_000)
    dated(tmp_path / "XXICMSALDOS2-new.txt", text, 2_000)
    out = tmp_path / "out"
    for _ in range(2):
        got = snapshots.publish_newest(spark, str(tmp_path), str(out))
        assert list(got) == ["XXICMSALDOS2"]
    assert files(out) == ["OK.txt", "XXICMSALDOS2.csv"]
    assert (out / "XXICMSALDOS2.csv").read_bytes() == text
    assert (tmp_path / "XXICMSALDOS2-old.txt").exists()


def test_run_payout_from_files(spark, tmp_path, shared):
    values = {
        "zMTVINFLACION.csv": "0.0450,2024-01-01,2024-12-31,2024-01-01,2024-12-31",
        "VTA_TDA_MULTI.csv": "S2,2024-04-30,150.00,7,1\nS2,2023-04-30,100.00,7,1",
        "ENFOQUE_TDA.csv": "S2,I,2024-03-01,2024-03-31\nS1,E,2024-03-01,2024-03-31",
        "TABULADORES_DESEMPEÑO.csv": "1,2,7,300,60,30\n1,1,7,1,90,2",
        "CfgAbsences.csv": "A,any,1",
        "VALIDACION_VARIABLE.csv": "1,P,T,S1,P,T,S2,2024-04-01,2024-04-30,W,1,,2024-05-01",
        "HistoryPayee.csv": "77,,,,2024-04-16,2024-12-31,,,,,,9,,,,,,S1,L1,,2024-01-01,2024-12-31,1",
        "HistoryAbsences.csv": "77,2024-04-20,1",
    }
    source = tmp_path / "in"
    source.mkdir()
    for file, columns in fixed.PAYOUT_FILES.values():
        header = ",".join(name for name, _, _ in columns)
        (source / file).write_text(f"{header}\n{values[file]}\n")
    detail = incentive.run_payout(
        spark, str(source), str(tmp_path / "out"), F.lit("2024-04-15").cast("date"), str(tmp_path / "stage"))
    assert [p.name.partition("-")[0] for p in shared.iterdir()] == ["payout"]
    assert content(tmp_path / "stage").decode().startswith("store_a,store_b,begda,")
    (row,) = detail.collect()
    assert (row.pay, row.final_pay, row.sales) == (165.0, 154.0, Decimal("150.00"))
    header, line = content(tmp_path / "out" / fixed.PAYOUT_FILE).decode().splitlines()
    assert header == ",".join(published for _, published in fixed.PAYOUT_COLUMNS)
    assert re.match(r"S1,S2,2024-04-01,2024-04-30,W,150.00,100.00,0.5,1,7,1,2,", line)


def test_money_text_equals_pandas_on_many_values(spark):
    rng = np.random.default_rng(5)
    numbers = np.concatenate([rng.normal(0, 1000, 2000), rng.integers(-5000, 5000, 2000) / 8,
                              rng.integers(-99999, 99999, 2000) / 1000])
    text = [repr(float(x)) for x in numbers]
    df = spark.createDataFrame(list(enumerate(text)), "i int, v string")
    got = [r[1] for r in df.select("i", money_text(F.col("v"))).orderBy("i").collect()]
    assert got == [f"{x:.2f}" for x in pd.Series(text).astype(float).round(2)]


def test_jobs_from_the_command_line(spark, tmp_path, capsys):
    records(spark, [record(i) for i in range(3)]).write.parquet(str(tmp_path / "records"))
    main(["publish", "--profile", "categoria", "--records", str(tmp_path / "records"), "--out", str(tmp_path / "o")])
    assert files(tmp_path / "o" / "ReplicaICMVS-Categoria") == ["ReplicaICMVS-Categoria-1.txt"]
    assert "ReplicaICMVS-Categoria-1.txt" in capsys.readouterr().out
    (tmp_path / "a.csv").write_text("p\n10GTO Leon\n")
    main(["recode", "--file", str(tmp_path / "a.csv")])
    assert content(tmp_path / "a_LIMPIO.csv") == b"p\n10GTO Leon Norte\n"
    dated(tmp_path / "XXICMCOMISIONES-1.txt", b"x", 1_000)
    main(["snapshots", "--folder", str(tmp_path), "--out", str(tmp_path / "s")])
    assert files(tmp_path / "s") == ["OK.txt", "XXICMCOMISIONES.csv"]


def test_text_rows_that_do_not_fit_are_errors(spark, tmp_path):
    for name, body in (("long", "a,b\n1,2,3\n"), ("short", "a,b\n1\n"), ("open", 'a,b\n"x\ny,2\n')):
        file = tmp_path / f"{name}.csv"
        file.write_text(body)
        with pytest.raises(Exception, match="MALFORMED|not closed"):
            tables.load_text_csv(spark, str(file)).select("a").collect()
        with pytest.raises(Exception, match="MALFORMED|not closed"):
            tables.load_csv(spark, str(file), "a string, b string").select("a").collect()
    (tmp_path / "broken.csv").write_text('a,b\n"x\ny",2\n')
    for multiline in (False, True):
        rows = tables.load_text_csv(spark, str(tmp_path / "broken.csv"), multiline=multiline).collect()
        assert [tuple(r) for r in rows] == [("x\ny", "2")]


def test_empty_and_hidden_files_can_be_newest(spark, tmp_path):
    for n, (name, body) in enumerate((("DD-old.txt", "x"), ("DD-new.txt", ""), ("EE-1.txt", "x"), ("_EE.txt", "y"))):
        (tmp_path / name).write_text(body)
        os.utime(tmp_path / name, (1_700_000_000 + n, 1_700_000_000 + n))
    got = snapshot_source.newest_snapshot(spark, str(tmp_path), ["DD", "EE", "FF"]).collect()
    assert {r.family: r.path.rsplit("/", 1)[1] for r in got} == {"DD": "DD-new.txt", "EE": "_EE.txt"}
    out = tmp_path / "out"
    snapshots.publish_newest(spark, str(tmp_path), str(out), ["DD", "EE"])
    assert (out / "DD.csv").read_bytes() == b"" and (out / "EE.csv").read_bytes() == b"y"


def test_published_names_are_no_patterns_and_byte_order_marks_stay(spark, tmp_path):
    bodies = {"BB[1].txt": b"1\n", "CC{a,b}*.txt": b"2\n", "FF.txt": b"\xef\xbb\xbfa|b\n\xff|2\n", "_GG?.txt": b"3\n"}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    (tmp_path / "BB1.csv").write_bytes(b"other")
    out = tmp_path / "out"
    snapshots.publish_newest(spark, str(tmp_path), str(out), ["BB", "CC", "FF", "GG"])
    for family, body in zip(("BB", "CC", "FF", "GG"), bodies.values()):
        assert (out / f"{family}.csv").read_bytes() == body


def test_a_family_that_fails_does_not_stop_the_others(spark, tmp_path):
    for name in ("AA.txt", "BB.txt", "CC.txt"):
        (tmp_path / name).write_text(name)
    out = tmp_path / "out"
    (out / "BB.csv" / "in the way").mkdir(parents=True)
    with pytest.raises(ExceptionGroup) as caught:
        snapshots.publish_newest(spark, str(tmp_path), str(out), ["AA", "BB", "CC"])
    (error,) = caught.value.exceptions
    assert str(error).startswith("BB from file:") and "BB.txt" in str(error)
    assert files(out) == ["AA.csv", "BB.csv", "CC.csv", "OK.txt"] and (out / "CC.csv").read_text() == "CC.txt"


def test_copies_have_equal_checksums(spark, tmp_path, monkeypatch):
    body = bytes(range(256)) * 40_000 + b"\r\n\xef\xbb\xbf last line without an end"
    dated(tmp_path / "AA.txt", body, 1_000)
    out = tmp_path / "out"
    for _ in range(2):
        snapshots.publish_newest(spark, str(tmp_path), str(out), ["AA"])
    assert hashlib.sha256((out / "AA.csv").read_bytes()).digest() == hashlib.sha256(body).digest()
    assert files(out) == ["AA.csv", "OK.txt"]


def counts(spark, folder, names):
    return [spark.read.parquet(str(folder / name)).count() for name in names]


def test_a_failing_table_leaves_all_the_old_ones(spark, tmp_path):
    names = [f"t{n}" for n in range(5)]
    table_sinks.refresh_tables({name: spark.range(3) for name in names}, str(tmp_path))
    table_sinks.refresh_tables({"kept_table": spark.range(3)})
    broken = spark.range(9).withColumn("id", F.raise_error("no such row").cast("bigint"))
    new = {name: spark.range(7) for name in names[:4]} | {"t4": broken}
    with pytest.raises(Exception, match="no such row"):
        table_sinks.refresh_tables(new, str(tmp_path))
    assert counts(spark, tmp_path, names) == [3] * 5 and files(tmp_path) == names
    with pytest.raises(Exception, match="no such row"):
        table_sinks.refresh_tables({"kept_table": spark.range(7), "other_table": broken})
    assert spark.table("kept_table").count() == 3
    # A table may come from the one it replaces.
    table_sinks.refresh_tables({"t0": spark.read.parquet(str(tmp_path / "t0")).limit(2)}, str(tmp_path))
    assert counts(spark, tmp_path, names) == [2, 3, 3, 3, 3]


@pytest.mark.parametrize("step", range(0, 12, 2))
def test_a_refresh_cut_off_anywhere_is_finished(spark, tmp_path, monkeypatch, step):
    names = ["a", "b"]
    table_sinks.refresh_tables({name: spark.range(3) for name in names}, str(tmp_path))
    steps = []
    for name in ("rename", "delete", "exists", "hadoop"):
        def cut(*args, plain=getattr(folders, name)):
            steps.append(args)
            if len(steps) == step + 1:
                raise Killed
            return plain(*args)

        monkeypatch.setattr(folders, name, cut)
    try:
        table_sinks.refresh_tables({name: spark.range(7) for name in names}, str(tmp_path))
    except Killed:
        pass
    monkeypatch.undo()
    table_sinks.recover_refresh(spark, str(tmp_path))
    assert files(tmp_path) == names and counts(spark, tmp_path, names) in ([3, 3], [7, 7])


class Killed(BaseException):
    """The driver goes without any chance to tidy up."""


@pytest.mark.parametrize("killed", [True, False])
@pytest.mark.parametrize("step", range(6))
def test_an_export_cut_off_anywhere_leaves_one_whole_set(spark, tmp_path, monkeypatch, step, killed):
    one = delimited.FileSet(str(tmp_path), "x")

    def export(rows):
        return delimited.export_batches(assign_batches(spark.range(rows), ["id"], 10), str(tmp_path), "x")

    def whole_set():
        folder = tmp_path / "x" if (tmp_path / "x").exists() else tmp_path / "_x-replaced"
        assert str(folder) in (one.path, folders.replaced(one.path))
        return {f: (folder / f).read_bytes() for f in files(folder)}

    export(50)
    new = whole_set()
    export(30)
    old, steps = whole_set(), []
    for name in ("rename", "delete", "recover", "replace"):
        def cut(*args, plain=getattr(folders, name)):
            steps.append(args)
            if len(steps) == step + 1:
                raise Killed() if killed else OSError("no such disk")
            return plain(*args)

        monkeypatch.setattr(folders, name, cut)
    try:
        export(50)
        assert len(steps) <= step
    except (Killed, OSError):
        pass
    monkeypatch.undo()
    assert whole_set() in (old, new)
    folders.recover(spark, one.path)
    assert (tmp_path / "x").exists() and not (tmp_path / "_x-replaced").exists()
    assert export(20) == 2 and files(tmp_path / "x") == ["x-1.txt", "x-2.txt"]


def test_driver_calls_do_not_grow_with_the_files(spark, tmp_path, monkeypatch):
    calls = []
    for name in ("rename", "delete", "exists", "hadoop"):
        monkeypatch.setattr(folders, name, lambda *args, plain=getattr(folders, name): calls.append(args) or plain(*args))
    counted = []
    for rows in (10, 20, 400):
        calls.clear()
        assert delimited.export_batches(assign_batches(spark.range(rows), ["id"], 10), str(tmp_path), "x") == rows // 10
        counted.append(len(calls))
    assert len(files(tmp_path / "x")) == 40 and counted[2] == counted[1]


def test_a_failing_task_leaves_the_earlier_files(spark, tmp_path):
    rows = assign_batches(spark.range(30), ["id"], 10)
    delimited.export_batches(rows, str(tmp_path), "x")
    broken = rows.withColumn("v", F.when(F.col("id") == 25, F.raise_error("no such cell")).otherwise("x"))
    with pytest.raises(Exception, match="no such cell"):
        delimited.export_batches(broken, str(tmp_path), "x")
    assert files(tmp_path) == ["x"] and (tmp_path / "x" / "x-1.txt").read_text().splitlines()[:2] == ["id", "0"]


def test_exports_are_one_shuffle_by_batch(spark, tmp_path, monkeypatch):
    plans = []
    kind = type(spark.range(1))
    plain = kind.mapInArrow

    def seen(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, *args)

    monkeypatch.setattr(kind, "mapInArrow", seen)
    delimited.export_batches(assign_batches(spark.range(300), ["id"], 10), str(tmp_path), "x")
    assert plans[0].count("Exchange") == 1 and "hashpartitioning" not in plans[0]


def test_publishing_leaves_only_the_manifest(spark, tmp_path, shared):
    rows = records(spark, [record(i) for i in range(30)])
    publish.publish_latest_batch(spark, rows, publish.PROFILES["categoria"], str(tmp_path / "o"))
    publish.publish_profiles(spark, rows, [publish.PROFILES["categoria"]], str(tmp_path / "p"))
    with pytest.raises(Exception, match="not readable"):
        publish.publish_latest_batch(
            spark, rows.where("raise_error('not readable') is null"),
            publish.PROFILES["categoria"], str(tmp_path / "q"))
    assert sorted(p.name.partition("-")[0] for p in shared.iterdir()) == ["manifest", "manifests"]


def test_profiles_published_together_equal_single_runs(spark, tmp_path):
    days = ["2024-05-30", "2024-05-31"]
    categories = ["115K", "118A", "110F", "118B", "1766", None]
    rows = [record(i, categories[i % 6], DATUM=days[i % 7 == 0], ZUTIMER=f"{10 + i % 3}:00:00",
                   ZSTAT="P" if i % 5 == 0 else "N") for i in range(200)]
    records = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in fixed.RECORD_COLUMNS))
    profiles = publish.PROFILES.values()
    together = publish.publish_profiles(spark, records, profiles, str(tmp_path / "all"))
    singles = set()
    for profile in profiles:
        alone = tmp_path / "one" / profile.name
        manifest = publish.publish_latest_batch(spark, records, profile, str(alone))
        singles |= {(profile.name, *row) for row in manifest.collect()}
        written = [
            {f: (folder / f).read_bytes() for f in files(folder)} if folder.exists() else {}
            for folder in (alone / profile.prefix, tmp_path / "all" / profile.name / profile.prefix)]
        assert written[0] == written[1]
    assert {tuple(row) for row in together.collect()} == singles and len(singles) > 3


def test_all_profiles_are_numbered_by_one_range_shuffle(spark, tmp_path, monkeypatch):
    from stipend.operators import numbering

    sorts = []
    plain = numbering.range_sorted
    monkeypatch.setattr(numbering, "range_sorted", lambda *args: sorts.append(args) or plain(*args))
    rows = records(spark, [record(i, c) for i in range(9) for c in ("115K", "118A", "110F")])
    publish.publish_profiles(spark, rows, publish.PROFILES.values(), str(tmp_path))
    assert len(sorts) == 1
