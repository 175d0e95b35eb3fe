"""Written stages, and other working folders, in the folder the cluster shares."""

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


# Whether Spark removes the shuffle files of a query when it ends.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Folders of the job that is running, which go when it is done.
_scope: ContextVar[list | None] = ContextVar("stipend_scope", default=None)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor reaches: `spark.checkpoint.dir`, as the cluster names it.

    Only a local session without that setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stipend-"))
    return spark.sparkContext.getCheckpointDir()


def own_folder(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed at the end of the enclosing `released` block or,
    without one, of the application."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    entry = (folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder)
    scope = _scope.get()
    if scope is None:
        atexit.register(_remove, *entry)
    else:
        scope.append(entry)
    return path


@contextmanager
def released() -> Iterator[None]:
    """Remove what is staged inside the block when it ends, also by an error.

    DataFrames built inside must be written before that: a result for the caller goes to a folder
    named before the block, by `write_stage`. Blocks can be nested.
    """
    folders: list = []
    token = _scope.set(folders)
    try:
        yield
    finally:
        _scope.reset(token)
        for entry in folders:
            _remove(*entry)


def stage(df: DataFrame, label: str, file_rows: int = 0) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    Values that depend on the partitioning are frozen, lost executors cost nothing upstream, and
    the planner sees the true size of the table: it broadcasts the table only if that is below
    `spark.sql.autoBroadcastJoinThreshold`.
    """
    return write_stage(df, own_folder(df.sparkSession, label), file_rows=file_rows)


def write_stage(df: DataFrame, path: str, compression: str | None = None, file_rows: int = 0) -> DataFrame:
    """`stage` to a path that `own_folder` gave. Nothing reads the shuffles behind a written stage, so
    their files go with the write instead of piling up until the driver collects garbage. Files hold
    at most `file_rows` rows, if that is given."""
    spark = df.sparkSession
    before = spark.conf.get(_DROP_SHUFFLES)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        writer = df.write.option("maxRecordsPerFile", file_rows) if file_rows else df.write
        writer.parquet(path, compression=compression)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def _remove(file_system, folder) -> None:
    try:
        file_system.delete(folder, True)
    except Exception:  # the JVM may be gone before Python is
        pass
