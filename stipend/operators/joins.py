"""Joins on a month, an interval, or a point in an interval, always with an equality key.

Column names of the two sides must differ, apart from the key names given as one string.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stipend.functions.dates import month_start, overlaps, shift_months
from stipend.operators.hot_keys import condition, salted_left_join


def month_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_date: str,
    right_date: str,
    months_back: int = 0,
    hot_right: bool = False,
) -> DataFrame:
    """Left join on a key and a month: that of `left_date`, `months_back` months earlier.

    Both parts are equalities of computed columns, so rows are hashed on key and month together.
    `hot_right` is for right sides where one key may hold a large part of all rows: see `hot_keys`.
    """
    kept = [c for c in right.columns if c != right_date]
    right = right.select(*kept, month_start(F.col(right_date)).alias("_month_r"))
    wanted = month_start(shift_months(F.col(left_date), -months_back))
    keys = {right_key: F.col(left_key), "_month_r": wanted}
    joined = salted_left_join(left, right, keys) if hot_right else left.join(
        right, condition(keys), "left")
    return joined.drop(right_key, "_month_r")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_interval: tuple[str, str],
    right_interval: tuple[str, str],
    also: Column | None = None,
) -> DataFrame:
    """Inner join on a key and overlapping intervals, and on the condition `also` if given."""
    left_start, left_end = map(F.col, left_interval)
    on = (F.col(left_key) == F.col(right_key)) & overlaps(
        left_start, left_end, *map(F.col, right_interval)
    )
    return left.join(right, on if also is None else on & also)


def point_in_interval(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    interval: tuple[str, str],
    point: str,
) -> DataFrame:
    """Left join of the right rows with the same key and a `point` inside the left interval.

    One key may have any number of points: frequent ones are spread over tasks (see `hot_keys`).
    """
    inside = (point, *map(F.col, interval))
    return salted_left_join(left, right, {right_key: F.col(left_key)}, inside).drop(right_key)


def keep_keys(df: DataFrame, key: str, keys: DataFrame, keys_col: str) -> DataFrame:
    """Rows of `df` whose key occurs in `keys`; null keys occur in nothing."""
    return df.join(keys.select(F.col(keys_col).alias("_kept")), F.col(key) == F.col("_kept"),
                   "left_semi")


def store_union(pairs: DataFrame) -> DataFrame:
    """Distinct stores named on either side of the pairs, ascending, as the column `store`."""
    return _named_stores(pairs).distinct().orderBy("store")


def history_for(pairs: DataFrame, history: DataFrame) -> DataFrame:
    """Employment history, or any other rows with a `store`, of the stores named on either side of
    the pairs.

    The semi-join needs no distinct keys, and the keys never leave the cluster.
    """
    return keep_keys(history, "store", _named_stores(pairs), "store")


def _named_stores(pairs: DataFrame) -> DataFrame:
    both = F.explode(F.array("store_a", "store_b")).alias("store")
    return pairs.select(both).filter(F.col("store").isNotNull())


def active_only(absences: DataFrame, types: DataFrame) -> DataFrame:
    """Absences of a type whose status is 1."""
    return keep_keys(absences, "type", types.filter(F.col("status") == 1), "type")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their `rows`: joining on them multiplies rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")
