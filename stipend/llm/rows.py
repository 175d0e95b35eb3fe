"""Whole rows carried as one column, so that no column of theirs meets an operator's own."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed(df: DataFrame, *more: Column) -> DataFrame:
    """`row`, every column of `df` in one structure, and the columns `more`."""
    return df.select(F.struct(F.col("*")).alias("row"), *more)


def columns_of(df: DataFrame, *replaced: str) -> list[Column]:
    """The columns of `df` out of `row`, but for those that are `replaced`, in any case of letters."""
    return [F.col("row").getField(c).alias(c) for c in df.columns if c.lower() not in replaced]
