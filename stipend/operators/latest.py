"""Newest batch of records that were not processed yet."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stipend import fixed_values as fixed
from stipend.shared import stage


def latest_batch(
    df: DataFrame,
    category: str | None = None,
    strict: bool = True,
    *,
    status_col: str = "ZSTAT",
    category_col: str = "LGART",
    date_col: str = "DATUM",
    time_col: str = "ZUTIMER",
    open_status: str = fixed.OPEN_STATUS,
) -> DataFrame:
    """Open records of the newest date and, on that date, of the newest time.

    `category=None` takes all categories as one. The newest date is that of an open record. With
    `strict` the newest time is too; without it the time of any record of that date counts, so a
    newer run that is already processed leaves nothing. All ties are kept; records without a date
    or time are never chosen.

    Both maxima are scalar subqueries: they read only the columns they need, run once, and reach
    the scan as plain comparisons, so files and row groups of other dates are skipped.
    """
    scope = df if category is None else df.filter(F.col(category_col) == category)
    open_rows = scope.filter(F.col(status_col) == open_status)
    newest_date = open_rows.agg(F.max(date_col)).scalar()
    on_date = (open_rows if strict else scope).filter(F.col(date_col) == newest_date)
    newest_time = on_date.agg(F.max(time_col)).scalar()
    return open_rows.filter((F.col(date_col) == newest_date) & (F.col(time_col) == newest_time))


def latest_batch_by(
    df: DataFrame,
    category_col: str = "LGART",
    strict: bool = True,
    *,
    status_col: str = "ZSTAT",
    date_col: str = "DATUM",
    time_col: str = "ZUTIMER",
    open_status: str = fixed.OPEN_STATUS,
) -> DataFrame:
    """`latest_batch` of every category at once, in two scans.

    The first finds the newest time of every category and date, of open records and of all, combined
    in each task before the shuffle, so a category that holds most rows costs no more than another.
    Clock times as text are compared as numbers there, which hash where a maximum of texts would sort
    all rows; see `_newest_times`. From these few rows come the newest runs, one per category, which
    are written to the shared folder: the planner then knows their size and broadcasts them if they
    are small. The second scan takes the records, from the oldest of these dates on.
    """
    is_open = F.col(status_col) == open_status
    open_rows = df.filter(is_open)
    times = _newest_times(df, category_col, date_col, time_col, is_open)
    dates = times.filter("_open").groupBy(category_col).agg(F.max(date_col).alias(date_col))
    newest = F.max("_open_time" if strict else "_any_time").alias(time_col)
    runs = stage(
        times.join(dates, [category_col, date_col]).groupBy(category_col, date_col).agg(newest), "runs")
    recent = F.col(date_col) >= runs.agg(F.min(date_col)).scalar()
    return open_rows.filter(recent).join(
        runs, [category_col, date_col, time_col]
    ).select(*df.columns)


def _newest_times(
    df: DataFrame, category_col: str, date_col: str, time_col: str, is_open: Column
) -> DataFrame:
    """The newest time of each category and date, written to the shared folder: `_any_time` of all
    records and `_open_time` of open ones, and whether there are any (`_open`).

    Text of the form `hh:mm:ss` is packed into a number of the same order. Any other text is kept
    as it is, as a further grouping key; so the result is exact whatever the texts are.
    """
    time = F.col(time_col)
    opened = F.coalesce(is_open, F.lit(False))
    if not isinstance(df.schema[time_col].dataType, StringType):
        times = df.groupBy(category_col, date_col).agg(
            F.max(opened).alias("_open"), F.max(time).alias("_any_time"),
            F.max(F.when(opened, time)).alias("_open_time"))
        return stage(times, "times")
    is_clock = time.rlike(r"^[0-9]{2}:[0-9]{2}:[0-9]{2}\z")
    packed = F.when(is_clock, F.translate(time, ":", "").cast("int"))
    packed_times = df.groupBy(category_col, date_col, F.when(~is_clock, time).alias("_text")).agg(
        F.max(opened).alias("_open"), F.max(packed).alias("_any"), F.max(F.when(opened, packed)).alias("_opened"))

    def unpacked(c: str) -> Column:
        return F.regexp_replace(F.lpad(F.col(c).cast("string"), 6, "0"), "^(..)(..)(..)", "$1:$2:$3")

    return stage(packed_times.select(
        category_col, date_col, "_open", F.coalesce("_text", unpacked("_any")).alias("_any_time"),
        F.when(F.col("_open"), F.coalesce("_text", unpacked("_opened"))).alias("_open_time")), "times")


def newest_per_family(df: DataFrame, family_col: str, run_col: str) -> DataFrame:
    """All rows of the newest run of each family; rows without a run are never chosen."""
    runs = _newest(df, [family_col], run_col)
    oldest = runs.agg(F.min(run_col)).scalar()
    return df.filter(F.col(run_col) >= oldest).join(
        runs, [family_col, run_col]
    ).select(*df.columns)


def _newest(df: DataFrame, keys: list[str], run_col: str) -> DataFrame:
    """The greatest run per key, as a table in the shared folder.

    A maximum of texts is found by sorting; the distinct runs, found by hashing, are few.
    """
    runs = df.select(*keys, run_col).distinct()
    return stage(runs.groupBy(*keys).agg(F.max(run_col).alias(run_col)), "runs")


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows, as one row with the column `row_count`."""
    return df.agg(F.count("*").alias("row_count"))
