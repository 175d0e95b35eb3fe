"""Numbers: defaults, growth, and the number formats of the published files."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    return c.cast(f"decimal({precision},{scale})")


def default(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def growth(current: Column, prior: Column, zero_as_missing: bool = True) -> Column:
    """Relative growth. A missing prior or current value gives -1, and so does a prior value of zero.

    With `zero_as_missing=False` a zero divides as a floating-point number does: the growth is
    infinite, or NaN if the current value is zero too, and lies in no band unless it is negative.
    """
    current, prior = current.cast("double"), prior.cast("double")
    ratio = F.try_divide(current, prior)
    if not zero_as_missing:
        infinite = (
            F.when(current > 0, float("inf")).when(current < 0, float("-inf"))
            .when(current == 0, float("nan"))
        )
        ratio = F.when(prior == 0, infinite).otherwise(ratio)
    return F.coalesce(ratio, F.lit(0.0)) - 1.0


def two_decimals(c: Column) -> Column:
    """Number or numeric text rounded to two decimals, exact halves to the even neighbour."""
    return F.rint(c.cast("double") * 100) / 100


def money_text(c: Column) -> Column:
    """Two-decimal text of a number; null and NaN give null, infinities `inf` and `-inf`."""
    number = two_decimals(c)
    return (
        F.when(number.isNull() | F.isnan(number), F.lit(None).cast("string"))
        .when(number == float("inf"), "inf")
        .when(number == float("-inf"), "-inf")
        .otherwise(F.format_string("%.2f", number))
    )


def int_trunc(c: Column) -> Column:
    """Whole part of a number or numeric text; null and NaN give null."""
    number = c.cast("double")
    return F.when(~F.isnan(number), number).cast("bigint")
