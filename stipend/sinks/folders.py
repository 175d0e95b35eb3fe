"""Folders that are replaced as a whole, and files that appear whole."""

import uuid
from urllib.parse import quote, urlsplit

from pyarrow import fs as arrow_fs
from pyspark.sql import SparkSession


def replaced(path: str) -> str:
    """Where the contents of `path` are while new ones take their place: beside it, out of sight."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}-replaced"


def replace(spark: SparkSession, path: str, new: str | None) -> None:
    """Put the folder `new` in the place of `path`, or nothing; two renames, whatever is in them."""
    if exists(spark, path):
        rename(spark, path, replaced(path))
    if new:
        rename(spark, new, path)
    delete(spark, replaced(path))


def recover(spark: SparkSession, path: str) -> None:
    """Bring back a folder whose replacement was cut off between the two renames."""
    if exists(spark, replaced(path)):
        if exists(spark, path):
            delete(spark, replaced(path))
        else:
            rename(spark, replaced(path), path)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Move one file; the folder of the target is made."""
    fs, at = hadoop(spark, target)
    fs.mkdirs(at.getParent())
    rename(spark, source, target)


class NewFile:
    """A file, written in an executor, that appears under its name when it is closed."""

    def __init__(self, folder: str, name: str):
        self.fs, root = arrow_file_system(folder)
        self.fs.create_dir(root)
        self.path, self.aside = f"{root}/{name}", f"{root}/.{name}-{uuid.uuid4().hex}"
        self.stream = self.fs.open_output_stream(self.aside)

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def close(self) -> None:
        self.stream.close()
        try:
            self.fs.move(self.aside, self.path)
        except FileExistsError:
            # Only some file systems replace a file by a move.
            self.fs.delete_file(self.path)
            self.fs.move(self.aside, self.path)


def arrow_file_system(path: str):
    """File system and path of a qualified Hadoop path, as executors open it."""
    scheme, host, inside, query, fragment = urlsplit(path)
    inside += ("?" + query if query else "") + ("#" + fragment if fragment else "")
    if scheme in ("", "file"):
        return arrow_fs.LocalFileSystem(), inside
    return arrow_fs.FileSystem.from_uri(f"{scheme}://{host}{quote(inside)}")


def hadoop(spark: SparkSession, path: str):
    """Hadoop file system and path object of a path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def qualified(spark: SparkSession, path: str) -> str:
    fs, at = hadoop(spark, path)
    return fs.makeQualified(at).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = hadoop(spark, path)
    return fs.exists(at)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, at = hadoop(spark, source)
    if not fs.rename(at, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, at = hadoop(spark, path)
    fs.delete(at, True)
