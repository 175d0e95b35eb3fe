"""Full refresh of tables, and publication of snapshots under a fixed name."""

import uuid
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stipend import fixed_values as fixed
from stipend.shared import released, stage
from stipend.sinks import folders

_PIECE = 1 << 22
_READY = "_READY"


def refresh_tables(tables: Mapping[str, DataFrame], folder: str | None = None) -> None:
    """Replace the contents of each table, in the catalog or as parquet below `folder`.

    All new contents are written before any table is touched, so one that fails leaves every table
    as it was; a table may be computed from those it replaces. Below a folder, the new contents are
    then marked as whole and take their places, by two renames per table. A driver that is killed
    before the mark leaves all the old tables, after it the new ones: `recover_refresh` and the next
    refresh finish the renames. Catalog tables are overwritten from the written contents.
    """
    if not tables:
        return
    spark = next(iter(tables.values())).sparkSession
    if folder is None:
        with released():
            written = {name: stage(rows, "refresh") for name, rows in tables.items()}
            for name, rows in written.items():
                rows.write.mode("overwrite").saveAsTable(name)
        return
    folder = folder.rstrip("/")
    recover_refresh(spark, folder)
    new = f"{folder}/_refresh-{uuid.uuid4().hex}"
    try:
        for name, rows in tables.items():
            rows.write.parquet(f"{new}/{name}")
    except Exception:
        folders.delete(spark, new)
        raise
    fs, mark = folders.hadoop(spark, f"{new}/{_READY}")
    fs.create(mark).close()
    _take_places(spark, folder, new)


def recover_refresh(spark: SparkSession, folder: str) -> None:
    """Finish a refresh below `folder` that was cut off: forward if its contents are whole, else back."""
    folder = folder.rstrip("/")
    fs, at = folders.hadoop(spark, folder)
    if not fs.exists(at):
        return
    for found in fs.listStatus(at):
        if found.getPath().getName().startswith("_refresh-"):
            path = found.getPath().toString()
            if folders.exists(spark, f"{path}/{_READY}"):
                _take_places(spark, folder, path)
            else:
                folders.delete(spark, path)


def _take_places(spark: SparkSession, folder: str, new: str) -> None:
    fs, at = folders.hadoop(spark, new)
    names = [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]
    for name in names:
        target = f"{folder}/{name}"
        if folders.exists(spark, folders.replaced(target)) and not folders.exists(spark, target):
            # Cut off between the renames of this table.
            folders.rename(spark, f"{new}/{name}", target)
            folders.delete(spark, folders.replaced(target))
        else:
            folders.delete(spark, folders.replaced(target))
            folders.replace(spark, target, f"{new}/{name}")
    for stale in fs.listStatus(folders.hadoop(spark, folder)[1]):
        # Old contents whose new ones have already moved.
        name = stale.getPath().getName()
        table = name.removeprefix("_").removesuffix("-replaced")
        if name == f"_{table}-replaced" and folders.exists(spark, f"{folder}/{table}"):
            fs.delete(stale.getPath(), True)
    folders.delete(spark, new)


def publish_copies(spark: SparkSession, paths: Mapping[str, str], out: str) -> dict[str, str]:
    """Publish each file of `paths` (family to path) as the one file `<out>/<family>.csv`, byte by
    byte, and mark the folder; return the errors of families that failed, as text.

    Each file is copied by one task, as a stream in pieces of bounded size, all at the same time. A
    copy appears under its name when it is whole, and takes the place of an earlier one. Paths are
    names and no patterns, and any file can be copied, hidden and empty ones too.
    """
    target = folders.qualified(spark, out.rstrip("/"))

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            errors = []
            for family, path in zip(batch["family"].to_pylist(), batch["path"].to_pylist()):
                try:
                    _copy(path, target, f"{family}.csv")
                    errors.append(None)
                except Exception as error:
                    errors.append(f"{type(error).__name__}: {error}")
            yield pa.RecordBatch.from_arrays([batch["family"], pa.array(errors, pa.string())], ["family", "error"])

    errors = {}
    if paths:
        rows = [(n, family, folders.qualified(spark, path)) for n, (family, path) in enumerate(paths.items())]
        listed = spark.createDataFrame(rows, "n int, family string, path string")
        copied = listed.repartitionById(len(rows), "n").mapInArrow(copy, "family string, error string")
        errors = {r.family: r.error for r in copied.collect() if r.error is not None}
    fs, marker = folders.hadoop(spark, f"{out.rstrip('/')}/{fixed.SNAPSHOT_MARKER}")
    if len(errors) < len(paths) and not fs.exists(marker):
        fs.create(marker).close()
    return errors


def _copy(path: str, folder: str, name: str) -> None:
    fs, inside = folders.arrow_file_system(path)
    with fs.open_input_stream(inside, compression=None) as source:
        out = folders.NewFile(folder, name)
        while piece := source.read(_PIECE):
            out.write(piece)
        out.close()
