"""Recoded copy of a text table."""

from pyspark.sql import SparkSession

from stipend import fixed_values as fixed
from stipend.operators.recode import recode
from stipend.sinks.delimited import export_table
from stipend.sources.tables import load_text_csv


def recoded_name(path: str) -> str:
    return path.removesuffix(".csv") + fixed.RECODED_SUFFIX


def recode_file(
    spark: SparkSession, path: str, out: str | None = None, pairs=None,
    null_text: str | None = None, multiline: bool = False,
) -> str:
    """Copy a comma-separated file with its place and division names brought up to date.

    `multiline` reads line breaks inside quoted cells; such a file is read by one task.
    """
    pairs = fixed.PLACE_NAMES + fixed.DIVISION_NAMES if pairs is None else pairs
    out = out or recoded_name(path)
    export_table(recode(load_text_csv(spark, path, multiline=multiline), pairs, null_text), out)
    return out
