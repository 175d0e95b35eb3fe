"""Broadcasts behind a check of their size."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_up_to(staged: DataFrame, rows: int) -> DataFrame:
    """A written table with a broadcast hint if it has at most `rows` rows, else as it is, for a
    join by shuffle. Parquet answers the count from its footers."""
    return F.broadcast(staged) if staged.count() <= rows else staged
