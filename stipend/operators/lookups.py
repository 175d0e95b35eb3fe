"""Lookups in small rule tables: inflation, growth bands and tariff."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stipend.functions.amounts import default
from stipend.functions.codes import band_limits, growth_band


def value_as_of(
    intervals: DataFrame, as_of: Column, value: str, start: str = "begda", end: str = "endda"
) -> Column:
    """The value whose interval holds the date `as_of`, as a scalar.

    No such interval gives null; more than one is an error, raised by Spark.
    """
    valid = as_of.between(F.col(start).cast("date"), F.col(end).cast("date"))
    return intervals.filter(valid).select(value).scalar()


def previous_month() -> Column:
    """The default date of a payout: today, one month back."""
    return F.add_months(F.current_date(), -1)


def band_table(rates: DataFrame, rate: str = "rate") -> DataFrame:
    """The seven bands (`low`, `high`, `band`) of every row of `rates`, next to its columns."""
    bands = [
        F.struct(low.alias("low"), high.alias("high"), F.lit(band).alias("band"))
        for low, high, band in band_limits(F.col(rate))
    ]
    return rates.select("*", F.inline(F.array(*bands)))


def band_lookup(df: DataFrame, value: str, rate: Column, name: str = "band") -> DataFrame:
    """Add the growth band of `value` over `rate`; see `growth_band`."""
    banded = df.withColumn("_rate", rate)
    return banded.withColumn(name, growth_band(F.col(value), F.col("_rate"))).drop("_rate")


def tariff_lookup(df: DataFrame, tariff: DataFrame) -> DataFrame:
    """Add the pay rates of `df`'s case and band, for the focus of store B and of store A.

    Rates that are not in the tariff are 0.
    """
    of_b = tariff.select(
        F.col("case_id").alias("_case"), F.col("focus").alias("_focus"),
        F.col("band").alias("_band"), F.col("pay_manager").alias("pay_manager_b"),
        F.col("pay_leader").alias("pay_leader_sales_b"),
        F.col("pay_leader_focus").alias("pay_leader_focus_b"),
    )
    of_a = tariff.select(
        F.col("case_id").alias("_case"), F.col("focus").alias("_focus"),
        F.col("band").alias("_band"), F.col("pay_manager").alias("pay_manager_a"),
    )
    for rates, focus in ((of_b, "focus_b"), (of_a, "focus_a")):
        df = df.join(
            rates,
            (df["case_id"] == rates["_case"])
            & (df[focus] == rates["_focus"])
            & (df["band"] == rates["_band"]),
            "left",
        ).drop("_case", "_focus", "_band")
    rates = ["pay_manager_b", "pay_leader_sales_b", "pay_leader_focus_b", "pay_manager_a"]
    return df.withColumns({r: default(F.col(r), 0).cast("decimal(14,2)") for r in rates})
