"""Delimited text with a header: quotes only where needed, doubled inside, null as empty."""

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stipend.operators.numbering import one_of
from stipend.sinks import folders

_FORMAT = {
    "header": True,
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    """Write `df` as a folder of delimited files, replacing what is there."""
    df.write.mode("overwrite").options(sep=sep, maxRecordsPerFile=0, **_FORMAT).csv(path)


def export_table(df: DataFrame, path: str) -> None:
    """Write a whole table as comma-separated text."""
    write_delimited(df, path, ",")


@dataclass(frozen=True)
class FileSet:
    """The files `<folder>/<prefix>/<prefix>-<batch_no>.<ext>`, which are replaced together."""

    folder: str
    prefix: str
    ext: str = "txt"
    sep: str = ";"

    @property
    def path(self) -> str:
        return f"{self.folder.rstrip('/')}/{self.prefix}"



def csv_line(columns: Sequence[Column], sep: str) -> Column:
    """A row as the text that `write_delimited` writes."""
    return F.to_csv(F.struct(*columns), {k: str(v).lower() for k, v in _FORMAT.items()} | {"sep": sep})


def export_batches(
    batched: DataFrame, folder: str, prefix: str, ext: str = "txt", sep: str = ";"
) -> int:
    """Write every batch as `<folder>/<prefix>/<prefix>-<batch_no>.<ext>`; return how many there are.

    `batched` comes from `assign_batches`; its two numbering columns are not written. The folder
    `<folder>/<prefix>` is replaced as a whole: see `export_file_sets`.
    """
    columns = [c for c in batched.columns if c not in ("batch_no", "row_no")]
    batches = batched.schema["batch_no"].metadata["batches"]
    lines = batched.select(
        F.lit(0).alias("set_no"), "batch_no", "row_no",
        csv_line([F.col(f"`{c}`") for c in columns], sep).alias("line"))
    export_file_sets(lines, [FileSet(folder, prefix, ext, sep)], [batches], columns)
    return batches


def export_file_sets(
    lines: DataFrame, sets: Sequence[FileSet], batches: Sequence[int], columns: Sequence[str]
) -> None:
    """Write `lines` (`set_no`, `batch_no`, `row_no`, `line`) as the files of several sets, the n-th of
    `batches[n]` files, each with the header `columns`.

    One shuffle sends each batch whole to one task, and neighbouring batches to the same, by their
    numbers and not by a hash, so that tasks are even. Tasks name their files themselves, in a new
    folder: a file is written beside its name and then moved there, so an attempt that is lost or
    runs twice leaves one whole file. Only if all are there, the new folder takes the place of the
    old one, by two renames per set however many files it has. A driver that is killed at any point
    leaves one whole set: the old one in place or, between the renames, in `FileSet.replaced`, from
    where `recover` and the next export bring it back. A set without batches ends without a folder.
    """
    spark = lines.sparkSession
    for one in sets:
        folders.recover(spark, one.path)
    version = uuid.uuid4().hex
    new = [f"{one.folder.rstrip('/')}/_{one.prefix}-new-{version}" for one in sets]
    total = sum(batches)
    try:
        if total:
            tasks = min(total, int(spark.conf.get("spark.sql.shuffle.partitions")))
            index = one_of([0, *accumulate(batches)], F.col("set_no")) + F.col("batch_no") - 1
            written = (
                lines.repartitionById(tasks, F.floor(index * tasks / total).cast("int"))
                .sortWithinPartitions("set_no", "batch_no", "row_no")
                .select("set_no", "batch_no", "line")
                .mapInArrow(_writer(spark, sets, new, columns), "files bigint")
            ).agg(F.sum("files")).first()[0]
            if written != total:
                raise RuntimeError(f"{written} files were written instead of {total}")
        for one, path, files in zip(sets, new, batches):
            folders.replace(spark, one.path, path if files else None)
    except Exception:
        for path in new:
            folders.delete(spark, path)
        raise


def _writer(
    spark: SparkSession, sets: Sequence[FileSet], paths: Sequence[str], columns: Sequence[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Writes sorted lines, one file after the other, in an executor; counts the files."""
    headers = {
        sep: spark.range(1).select(csv_line([F.lit(c).alias(f"_{n}") for n, c in enumerate(columns)], sep)).first()[0]
        for sep in {one.sep for one in sets}
    }
    targets = [
        (folders.qualified(spark, path), one.prefix, one.ext, headers[one.sep]) for one, path in zip(sets, paths)
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, current, out = 0, None, None
        for batch in batches:
            set_nos, numbers = batch["set_no"].to_pylist(), batch["batch_no"].to_pylist()
            texts = batch["line"].to_pylist()
            first = 0
            while first < len(texts):
                key, end = (set_nos[first], numbers[first]), first + 1
                while end < len(texts) and (set_nos[end], numbers[end]) == key:
                    end += 1
                if key != current:
                    if out:
                        out.close()
                    folder, prefix, ext, header = targets[key[0]]
                    out, current = folders.NewFile(folder, f"{prefix}-{key[1]}.{ext}"), key
                    out.write(f"{header}\n".encode())
                    files += 1
                out.write("".join(f"{text}\n" for text in texts[first:end]).encode())
                first = end
        if out:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], ["files"])

    return run
