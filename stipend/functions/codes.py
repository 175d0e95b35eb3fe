"""Codes and bands that stand for a value."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from stipend import fixed_values as fixed


def focus_code(letter: Column) -> Column:
    code = F.lit(0)
    for known, value in fixed.FOCUS_CODES.items():
        code = F.when(letter == known, value).otherwise(code)
    return code


def area_default(area: Column, tag: Column) -> Column:
    """Area of an employee, or the one their role tag stands for when there is none."""
    fallback = F.create_map(*[F.lit(x) for pair in fixed.DEFAULT_AREA.items() for x in pair])
    return F.coalesce(area, fallback[tag])


def band_limits(rate: Column) -> list[tuple[Column, Column, int]]:
    """(low, high, band) of the seven growth bands over one inflation rate."""
    def amount(text, times=1):
        return F.lit(Decimal(text) * times)

    def limit(c):
        return c.cast("decimal(14,4)")

    rate = limit(rate)
    limits = [(limit(F.lit(0)), limit(rate - amount(fixed.BAND_UNIT)), 1)]
    for step in range(fixed.STEPPED_BANDS):
        low = rate + amount(fixed.BAND_STEP, step)
        limits.append((limit(low), limit(low + amount(fixed.BAND_WIDTH)), step + 2))
    top = rate + amount(fixed.BAND_STEP, fixed.STEPPED_BANDS)
    limits.append((limit(top), limit(amount(fixed.BAND_CEILING)), fixed.STEPPED_BANDS + 2))
    return limits


def growth_band(value: Column, rate: Column) -> Column:
    """Band of a growth: 1 when it is not positive, null when it lies between two bands.

    The limits are evaluated as a chain of conditions on the row itself, so no band table has to
    be joined.
    """
    band = F.when(value.isNull() | (value <= 0), 1)
    for low, high, number in band_limits(rate):
        band = band.when(value.between(low.cast("double"), high.cast("double")), number)
    return band
