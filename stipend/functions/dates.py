"""Dates, months and intervals. Every interval is closed at both ends."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(c: Column) -> Column:
    """Date of a date, timestamp or ISO text; text that holds no date gives null."""
    return c.try_cast("date")


def iso_date(c: Column) -> Column:
    """`yyyy-MM-dd` text of a date or timestamp."""
    return c.cast("date").cast("string")


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def shift_months(c: Column, months: int) -> Column:
    """Same day `months` later (or earlier, if negative), held back to the end of that month."""
    return F.add_months(c, months)


def days_in_month(c: Column) -> Column:
    return F.dayofmonth(F.last_day(c)).cast("bigint")


def days_inclusive(start: Column, end: Column) -> Column:
    """Days of an interval, counting both its first and its last one."""
    return (F.abs(F.datediff(end, start)) + 1).cast("bigint")


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return (a_start <= b_end) & (a_end >= b_start)


def clip_start(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def clip_end(a: Column, b: Column) -> Column:
    return F.least(a, b)


def proration(start: Column, end: Column, month_of: Column) -> Column:
    """Share of the month of `month_of` that the days from `start` to `end` make up."""
    return days_inclusive(start, end).cast("double") / days_in_month(month_of).cast("double")
