"""Interval joins of keys with many intervals, in bins chosen from the data."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stipend.functions.dates import overlaps
from stipend.operators.joins import interval_join
from stipend.shared import stage

#: Pairs of intervals of one key before its intervals are laid out in bins.
CROWDED = 100_000

#: Bins of a key at least, for bins to be worth their copies, and at most, to bound these.
MIN_BINS, MAX_BINS = 8, 1024


def binned_interval_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str,
    left_interval: tuple[str, str], right_interval: tuple[str, str], also: Column | None = None,
    crowded: int = CROWDED,
) -> DataFrame:
    """`interval_join` for keys that hold many intervals over a long time.

    An equality on the key alone compares all its intervals. Here one pass over both sides sums up
    each key: how many intervals, over which days, how long on average. Keys of more than `crowded`
    pairs get bins as wide as an average interval; an interval is copied to the bins it touches, and
    pairs meet in the first bin that they have in common, and so once. Intervals are cut to the days
    where the other side has any, so that open ends cost nothing. Keys whose intervals are about as
    long as their whole time, or that have few pairs, stay in one bin, and the table of the others
    is written, so that the planner broadcasts it if it is small. Dates or numbers of days;
    intervals that end before they begin match as in `interval_join`, null ends match nothing.
    """
    binned = with_bins(left, right, left_key, right_key, left_interval, right_interval, crowded)
    if binned is None:
        return interval_join(left, right, left_key, right_key, left_interval, right_interval, also)
    on = (F.col(left_key) == F.col(right_key)) & (F.col("_bin_l") == F.col("_bin_r")) & (
        F.col("_bin_l") == F.greatest("_first_l", "_first_r"))
    on &= overlaps(*map(F.col, left_interval), *map(F.col, right_interval))
    joined = binned[0].join(binned[1], on if also is None else on & also)
    return joined.select(*[f"`{c}`" for c in [*left.columns, *right.columns]])


def equal_intervals(
    df: DataFrame, key: str, interval: tuple[str, str], sums: Mapping[str, Column]
) -> DataFrame:
    """One row per key and interval of `df`, with the aggregates `sums` of the rows that share them.

    Equal intervals of a key overlap the same others. Where a join is only summed up, joining these
    rows instead and adding up their sums gives the same, and its pairs do not grow with the product
    of both sides, as a day begins and ends a bounded number of intervals however many rows there are.
    """
    return df.groupBy(f"`{key}`", *[f"`{c}`" for c in interval]).agg(*[c.alias(name) for name, c in sums.items()])


def with_bins(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str,
    left_interval: tuple[str, str], right_interval: tuple[str, str], crowded: int = CROWDED,
) -> tuple[DataFrame, DataFrame] | None:
    """Both sides, an interval once per bin (`_bin_l`, `_bin_r`) with the first of its bins (`_first_l`,
    `_first_r`); None if no key is crowded."""
    sides = [
        _ends(df, key, interval) for df, key, interval in (
            (left, left_key, left_interval), (right, right_key, right_interval))]
    bins = stage(_bins(*sides, crowded), "bins")
    if bins.isEmpty():
        return None
    return (_laid_out(left, left_key, left_interval, bins, "l"), _laid_out(right, right_key, right_interval, bins, "r"))


def _day(c: Column, kind: str) -> Column:
    return (F.unix_date(c.cast("date")) if kind in ("date", "timestamp", "timestamp_ntz") else c).cast("bigint")


def _edges(df: DataFrame, interval: tuple[str, str]) -> tuple[Column, Column]:
    """First and last day of an interval, also of one that is the wrong way round."""
    ends = [_day(F.col(f"`{c}`"), df.schema[c].dataType.typeName()) for c in interval]
    both = ends[0].isNotNull() & ends[1].isNotNull()
    return F.when(both, F.least(*ends)), F.when(both, F.greatest(*ends))


def _ends(df: DataFrame, key: str, interval: tuple[str, str]) -> DataFrame:
    low, high = _edges(df, interval)
    return df.select(F.col(f"`{key}`").alias("_key"), low.alias("low"), high.alias("high")).where(
        F.col("_key").isNotNull() & F.col("low").isNotNull())


def _bins(left: DataFrame, right: DataFrame, crowded: int) -> DataFrame:
    """`_key`, `_origin`, `_last` and `_width` of the bins of crowded keys."""
    both = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)))
    per = both.groupBy("_key").agg(*[
        agg(F.when(F.col("side") == n, F.col(c))).alias(f"{name}_{n}")
        for n in (0, 1) for name, agg, c in (
            ("n", F.count, "low"), ("low", F.min, "low"), ("high", F.max, "high"))])
    spans = per.select(
        "_key", "n_0", "n_1", F.greatest("low_0", "low_1").alias("_origin"), F.least("high_0", "high_1").alias("_last"),
    ).where((F.col("n_0") * F.col("n_1") > crowded) & (F.col("_origin") <= F.col("_last")))
    # The mean length inside the days that both sides have.
    cut = F.least("high", "_last") - F.greatest("low", "_origin") + 1
    lengths = both.join(spans.select("_key", "_origin", "_last"), "_key").where(cut > 0)
    means = lengths.groupBy("_key").agg(F.ceil(F.avg(cut)).alias("mean"))
    span = F.col("_last") - F.col("_origin") + 1
    width = F.greatest(F.col("mean"), F.ceil(span / MAX_BINS))
    return spans.join(means, "_key").withColumn("_width", width).where(
        span >= MIN_BINS * F.col("_width")).select("_key", "_origin", "_last", "_width")


def _laid_out(df: DataFrame, key: str, interval: tuple[str, str], bins: DataFrame, side: str) -> DataFrame:
    low, high = _edges(df, interval)
    rows = df.join(bins, F.col(f"`{key}`") == F.col("_key"), "left")
    first, last = (
        F.floor((edge - F.col("_origin")) / F.col("_width"))
        for edge in (F.greatest(low, F.col("_origin")), F.least(high, F.col("_last"))))
    # Without bins all is in bin 0; outside the days of the other side there is none.
    own = F.when(F.col("_width").isNull(), F.array(F.lit(0).cast("bigint"))).when(
        (low <= F.col("_last")) & (high >= F.col("_origin")), F.sequence(first, last))
    laid = rows.withColumn("_all", own).withColumn(f"_first_{side}", F.get("_all", F.lit(0)))
    return laid.withColumn(f"_bin_{side}", F.explode("_all")).drop("_key", "_origin", "_last", "_width", "_all")
