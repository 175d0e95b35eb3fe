"""Variable-incentive payout: store pairs, sales growth and tariff to prorated pay per employee.

The plan has two sides that meet only at the end.

* The store side (`tariff_stage`) is wide but short: one row per pair, with growth, band and rates.
* The employee side (`employee_periods`, `with_absences`) is narrow but long: who worked in which
  store in which part of a period, and how many days of it they were absent. It knows nothing of
  pay, so rows that differ only in pay are never multiplied before they are aggregated.

The three kinds of employee - leaders and managers of store A, managers of store B - are one pass:
a pair counts for both its stores, and the employee's role decides which of them pays.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stipend import fixed_values as fixed
from stipend.functions.amounts import default, growth
from stipend.functions.codes import area_default, focus_code
from stipend.functions.dates import (
    clip_end, clip_start, days_in_month, days_inclusive, month_start, overlaps, proration,
    shift_months,
)
from stipend.operators.joins import history_for, interval_join, month_join
from stipend.operators.lookups import band_lookup, previous_month, tariff_lookup, value_as_of
from stipend.shared import own_folder, released, stage, write_stage
from stipend.sinks.delimited import export_table
from stipend.sources.tables import load_payout_inputs

# Columns of the store side.
STAGE_COLUMNS = [name for name, _ in fixed.PAYOUT_COLUMNS[:16]]

# First and last date of something, both included.
Span = tuple[Column, Column]

_PERIOD = ["store", "begda", "endda"]
_EMPLOYEE = ["payee", "role", "date_start", "date_end", "area"]


def pair_growth(pairs: DataFrame, sales: DataFrame, zero_as_missing: bool = True) -> DataFrame:
    """Pairs with the sales of store B in their month and a year before, and the growth.

    `sales` are those with status 1. Several sales rows of a store and month give several rows; see
    `duplicate_keys`. `zero_as_missing` is that of `growth`.
    """
    def named(name):
        return sales.select(
            F.col("store").alias("_store"), F.col("sale_date").alias("_date"),
            F.col("amount").alias(name),
        )

    joined = month_join(pairs, named("sales"), "store_b", "_store", "begda", "_date")
    joined = month_join(joined, named("prior_sales"), "store_b", "_store", "begda", "_date", 12)
    return joined.withColumn("growth", growth(
        F.col("sales"), F.col("prior_sales"), zero_as_missing))


def pair_focus(pairs: DataFrame, focus: DataFrame) -> DataFrame:
    """Pairs with the focus codes of both stores in the month before."""
    for side in ("b", "a"):
        letters = focus.select(
            F.col("store").alias("_store"), F.col("begda").alias("_date"),
            F.col("focus").alias("_letter"),
        )
        pairs = month_join(pairs, letters, f"store_{side}", "_store", "begda", "_date", 1)
        pairs = pairs.withColumn(f"focus_{side}", focus_code(F.col("_letter"))).drop("_letter")
    return pairs


def tariff_stage(
    pairs: DataFrame, sales: DataFrame, focus: DataFrame, tariff: DataFrame, rate: Column,
    months: Span | None = None, zero_as_missing: bool = True,
) -> DataFrame:
    """The store side: valid pairs with growth, focus codes, band and pay rates.

    Equal rows count once in the payout, so copies are dropped from every input first: a store
    and month with many equal sales or focus rows adds one row to a join, not many. With `months`,
    the first and last BEGDA of the pairs, only sales and focus of the months in question are read.
    """
    pairs = pairs.filter((F.col("ids") == 1) & rate.isNotNull())
    sales = sales.filter(F.col("status") == 1)
    if months:
        first, last = months
        sales = sales.filter(F.col("sale_date").cast("date").between(
            month_start(shift_months(first, -12)), F.last_day(last)
        ))
        focus = focus.filter(F.col("begda").cast("date").between(
            month_start(shift_months(first, -1)), F.last_day(last)
        ))
    sales = sales.select(
        "store", month_start(F.col("sale_date")).alias("sale_date"), "amount"
    ).distinct()
    focus = focus.select("store", month_start(F.col("begda")).alias("begda"), "focus").distinct()

    staged = pair_focus(pair_growth(pairs, sales, zero_as_missing), focus)
    staged = band_lookup(staged, "growth", rate)
    staged = staged.withColumns({c: default(F.col(c), 0) for c in ("sales", "prior_sales")})
    return tariff_lookup(staged, tariff.distinct()).select(*STAGE_COLUMNS).distinct()


def by_side(staged: DataFrame) -> DataFrame:
    """Each pair twice: as store A and as store B, in the columns `store` and `side`."""
    sides = F.array(*[
        F.struct(F.lit(side).alias("side"), F.col(f"store_{side.lower()}").alias("store"))
        for side in ("A", "B")
    ])
    return staged.select("*", F.inline(sides))


def employee_periods(
    sides: DataFrame, history: DataFrame, span: Span | None = None
) -> DataFrame:
    """Who worked in a store during a period: store, period, employee, role tag and interval clipped
    to the period, one row per different history row.

    Leaders (L) and managers (EA) count for store A, managers (EB) for store B. Copies in the
    history are dropped before the join; rows whose raw intervals differ are kept even if they are
    equal once clipped. With `span`, the first and last day of all periods, only history that
    overlaps it is read. Nothing after the join relies on its partitioning by store, so Spark may
    split a store with very many employees over several tasks.
    """
    periods = sides.select(*_PERIOD, "side").distinct()
    if span:
        history = history.filter(overlaps(F.col("date_start"), F.col("date_end"), *span))
    employed = (
        history.filter(F.col("status") == 1)
        .filter(F.col("role").startswith("L") | F.col("role").startswith("E"))
        .select(
            F.col("store").alias("_store"), "payee", F.substring("role", 1, 1).alias("_kind"),
            F.col("date_start").alias("_from"), F.col("date_end").alias("_to"),
            F.col("area").alias("_area"),
        )
        .distinct()
    )
    side_pays = (F.col("side") == "A") | (F.col("_kind") == "E")
    joined = interval_join(
        periods, employed, "store", "_store", ("begda", "endda"), ("_from", "_to"), side_pays
    )
    tag = F.when(F.col("_kind") == "L", "L").otherwise(F.concat(F.lit("E"), F.col("side")))
    return joined.select(
        *_PERIOD, "payee", tag.alias("role"),
        clip_start(F.col("begda"), F.col("_from")).alias("date_start"),
        clip_end(F.col("endda"), F.col("_to")).alias("date_end"),
        area_default(F.col("_area"), tag).alias("area"),
    )


def with_absences(periods: DataFrame, absences: DataFrame) -> DataFrame:
    """Equal rows as one, with `absence_days`: the days of the absences that start in the clipped
    interval, counted once for each of the equal rows.

    Absences are summed per employee and date first, and joined on employee and month: however
    many absences an employee has, a month holds at most one row per day.
    """
    days = (
        absences.groupBy(
            F.col("payee").alias("_payee"), F.col("start_date").cast("date").alias("_day")
        )
        .agg(F.sum(default(F.col("days"), 0).cast("double")).alias("_days"))
        .withColumn("_day_month", month_start(F.col("_day")))
    )
    # An interval that ends before it starts holds no day, but is kept like any other.
    first, last = month_start(F.col("date_start")), month_start(F.col("date_end"))
    months = F.when(last <= first, F.array(first)).otherwise(
        F.sequence(first, F.greatest(first, last), F.expr("interval 1 month"))
    )
    on = (
        (F.col("payee") == F.col("_payee"))
        & (F.col("_month") == F.col("_day_month"))
        & F.col("_day").between(F.col("date_start"), F.col("date_end"))
    )
    return (
        periods.withColumn("_month", F.explode(months))
        .join(days, on, "left")
        .groupBy(*_PERIOD, *_EMPLOYEE)
        .agg(default(F.sum("_days"), 0.0).alias("absence_days"))
    )


def payout_columns(df: DataFrame) -> DataFrame:
    """Days, share of the month, pay, deduction and final pay, which may be negative."""
    def paid(share):
        def at(rate):
            return share * F.col(rate).cast("double")

        return (
            F.when(F.col("role") == "L", at("pay_leader_sales_b") + at("pay_leader_focus_b"))
            .when(F.col("role") == "EA", at("pay_manager_a"))
            .otherwise(at("pay_manager_b"))
        )

    start, end, begda = F.col("date_start"), F.col("date_end"), F.col("begda")
    share, month_days = proration(start, end, begda), days_in_month(begda)
    paid_columns = df.withColumns({
        "days": days_inclusive(start, end),
        "month_days": month_days.cast("decimal(16,2)"),
        "share": share,
        "pay": paid(share),
        "absence_pay": paid(F.col("absence_days") / month_days.cast("double")),
    })
    return paid_columns.withColumn("final_pay", F.col("pay") - F.col("absence_pay"))


def staged_pairs(
    pairs: DataFrame, sales: DataFrame, focus: DataFrame, tariff: DataFrame,
    inflation: DataFrame, as_of: Column | None = None, zero_as_missing: bool = True,
) -> DataFrame:
    """The store side, written to the shared folder: the employee side and the final join both
    read it, and Spark broadcasts it if its size there allows it.

    The inflation valid on `as_of` (default: one month ago) sets the growth bands; without one
    there is no row. `zero_as_missing` says what prior sales of zero mean: see `growth`.
    """
    rate = value_as_of(inflation, previous_month() if as_of is None else as_of, "rate")
    valid = pairs.filter(F.col("ids") == 1)
    months = _extent(valid, "begda", "begda")
    sales, focus = history_for(valid, sales), history_for(valid, focus)
    staged = tariff_stage(pairs, sales, focus, tariff, rate, months, zero_as_missing)
    return stage(staged, "tariff-stage")


def payout_detail(staged: DataFrame, history: DataFrame, absences: DataFrame) -> DataFrame:
    """The payout detail of a store side, 28 columns, one row per pair, employee, role tag and
    clipped interval."""
    span = _extent(staged, "begda", "endda")
    history = history_for(staged, history)
    absences = absences.filter(F.col("start_date").cast("date").between(*span))
    sides = by_side(staged)
    employees = with_absences(employee_periods(sides, history, span), absences)
    employees = employees.withColumn("side", F.when(F.col("role") == "EB", "B").otherwise("A"))
    detail = payout_columns(sides.join(employees, [*_PERIOD, "side"]))
    return detail.select(*[name for name, _ in fixed.PAYOUT_COLUMNS])


def _extent(df: DataFrame, start: str, end: str) -> Span:
    """Least start and greatest end, as constants that reach the scans of other tables."""
    return tuple(F.lit(day).cast("date") for day in df.agg(F.min(start), F.max(end)).first())


def incentive_payout(
    pairs: DataFrame,
    sales: DataFrame,
    focus: DataFrame,
    tariff: DataFrame,
    history: DataFrame,
    absences: DataFrame,
    inflation: DataFrame,
    as_of: Column | None = None,
    zero_as_missing: bool = True,
) -> DataFrame:
    """Both sides of the payout in one call; see `staged_pairs` and `payout_detail`."""
    staged = staged_pairs(pairs, sales, focus, tariff, inflation, as_of, zero_as_missing)
    return payout_detail(staged, history, absences)


def payout_summary(detail: DataFrame) -> DataFrame:
    """Number of payout rows, as one row with the column `records`."""
    return detail.agg(F.count("*").alias("records"))


def run_payout(
    spark: SparkSession, folder: str, out: str, as_of: Column | None = None,
    stage_out: str | None = None, zero_as_missing: bool = True,
) -> DataFrame:
    """Load the interchange files of `folder`, write the payout detail to `out` and, if asked for,
    the store side to `stage_out` for review. Returns the detail as written.

    The files are parsed once, into tables of the shared folder: their statistics let the date
    limits skip row groups, which text cannot. Only the detail stays in the shared folder.
    """
    kept = own_folder(spark, "payout-detail")
    with released():
        tables = load_payout_inputs(spark, folder)
        tables.pop("absence_types")
        inputs = {name: stage(rows, name) for name, rows in tables.items()}
        history, absences = inputs.pop("history"), inputs.pop("absences")
        staged = staged_pairs(**inputs, as_of=as_of, zero_as_missing=zero_as_missing)
        if stage_out:
            export_table(staged, stage_out)
        detail = write_stage(payout_detail(staged, history, absences), kept)
    published = detail.select(*[F.col(n).alias(p) for n, p in fixed.PAYOUT_COLUMNS])
    export_table(published, f"{out.rstrip('/')}/{fixed.PAYOUT_FILE}")
    return detail
