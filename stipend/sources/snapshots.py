"""Newest file of each dataset family in a folder."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def newest_snapshot(spark: SparkSession, folder: str, families: Sequence[str]) -> DataFrame:
    """One row (`family`, `path`, `modified`) per family that has a file.

    A file belongs to a family if its name contains the family and ends in `.txt`. The newest file
    wins, whatever its size and also if its name begins with `_` or `.`; among equally new ones the
    greatest path. Only the listing of the one folder is read, no contents.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    files = [
        (f.getPath().getName(), f.getModificationTime(), f.getPath().toString())
        for f in listed if f.isFile() and f.getPath().getName().endswith(".txt")
    ]
    newest = [
        (family, *max((modified, path) for name, modified, path in files if family in name))
        for family in families if any(family in name for name, _, _ in files)
    ]
    rows = spark.createDataFrame(newest, "family string, millis bigint, path string")
    return rows.select("family", "path", F.timestamp_millis("millis").alias("modified"))
