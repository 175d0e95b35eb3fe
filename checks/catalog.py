"""The registered queries: every operator and job over the whole synthetic tables.

Dates are returned as ISO text and money as double, so that results compare across engines.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.derived import Tables
from stipend import fixed_values as fixed
from stipend.functions.amounts import int_trunc, money_text, to_decimal
from stipend.functions.codes import area_default
from stipend.functions.dates import (
    as_date, clip_end, clip_start, days_in_month, days_inclusive, iso_date, month_start, proration,
    shift_months,
)
from stipend.operators import hot_keys, intervals, joins, latest, lookups, numbering, pages
from stipend.operators.recode import recode
from stipend.plans import incentive, publish, recoding, snapshots
from stipend.shared import own_folder
from stipend.sinks.delimited import export_batches, export_table
from stipend.sinks.folders import move_file
from stipend.sinks.tables import refresh_tables
from stipend.sources.tables import load_csv, load_text_csv

ITEM = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
ITEM_KEY = ITEM[:4]
SEGMENTS = [
    ("MACHINERY", "MACHINES"), ("BUILDING", "HOUSES"), ("FURNITURE", "Furniture and fittings"),
]
#: One wage type of the shipped profiles for each order priority.
WAGE_TYPES = ["115K", "118A", "110F", "118B", "116W"]
#: Orders of one file of a snapshot: the task that writes it, or copies it, reads no more.
SNAPSHOT_ROWS = 500_000
ROUNDED = {"growth": 6, "share": 6, "pay": 4, "absence_pay": 4, "final_pay": 4}


def comparable(df: DataFrame) -> DataFrame:
    """Dates as ISO text, decimals as double, computed doubles rounded (and never -0.0)."""
    out = []
    for field in df.schema:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            c = iso_date(c)
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        if field.name in ROUNDED:
            c = F.round(c, ROUNDED[field.name]) + 0.0
        out.append(c.alias(field.name))
    return df.select(*out)


def _worked(t: Tables) -> DataFrame:
    """Store pairs with the people of store A whose employment overlaps the period."""
    history = t.history().filter("status = 1").withColumnRenamed("store", "_store")
    joined = joins.interval_join(
        t.pairs().select("store_a", "store_b", "begda", "endda"), history.drop("status"),
        "store_a", "_store", ("begda", "endda"), ("date_start", "date_end"),
    )
    return joined.drop("_store")


def _clipped(t: Tables) -> DataFrame:
    return _worked(t).withColumns({
        "clip_start": clip_start(F.col("begda"), F.col("date_start")),
        "clip_end": clip_end(F.col("endda"), F.col("date_end")),
    })


def _pair_sales(t: Tables, name: str, months_back: int) -> DataFrame:
    sales = t.store_sales().select(
        F.col("store").alias("_store"), F.col("sale_date").alias("_date"),
        F.col("amount").alias(name),
    )
    pairs = t.pairs().select("store_a", "store_b", "begda", "ids")
    return joins.month_join(pairs, sales, "store_b", "_store", "begda", "_date", months_back)


def _rate(t: Tables):
    return lookups.value_as_of(t.fixed_inflation(), F.lit("1999-05-01").cast("date"), "rate")


def _tariff_stage(t: Tables) -> DataFrame:
    return incentive.tariff_stage(
        t.pairs(), t.store_sales(), t.store_focus(), t.tariff(), _rate(t)
    )


def _payout(t: Tables) -> DataFrame:
    return incentive.incentive_payout(
        t.pairs(), t.store_sales(), t.store_focus(), t.tariff(), t.history(), t.absences(),
        t.fixed_inflation(), F.lit("1999-05-01").cast("date"),
    )


def _leaders(t: Tables) -> DataFrame:
    return _payout(t).filter("role = 'L'").drop("final_pay")


def _value_as_of(t: Tables) -> DataFrame:
    newest = t.orders.agg(F.max(F.col("o_orderdate").cast("date")))
    as_of = shift_months(newest.scalar(), -1)
    rate = lookups.value_as_of(t.inflation(), as_of, "rate")
    return t.spark.range(1).select(as_of.alias("as_of"), rate.alias("rate"))


def _number_text(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    text = F.concat(
        F.floor(key / 1000).cast("string"), F.lit("."),
        F.lpad((key % 1000).cast("string"), 3, "0"),
    )
    return t.orders.select("o_orderkey", text.alias("number_text"))


def _month_shift(t: Tables) -> DataFrame:
    day = F.last_day(F.col("o_orderdate").cast("date"))
    return t.orders.select(
        "o_orderkey",
        shift_months(day, -1).alias("month_back"),
        shift_months(day, -12).alias("year_back"),
        month_start(day).alias("month_start"),
        days_in_month(day).alias("month_days"),
    )


def _cast_date(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 10 == 0, "n/a").otherwise(iso_date(F.col("o_orderdate")))
    return t.orders.select(
        "o_orderkey", as_date(text).alias("as_date"),
        to_decimal(F.col("o_totalprice"), 14, 4).alias("as_decimal"),
        F.col("o_custkey").cast("string").alias("as_text"),
    )


def _prorated(t: Tables) -> DataFrame:
    start, end, begda = F.col("clip_start"), F.col("clip_end"), F.col("begda")
    return _clipped(t).withColumns({
        "days": days_inclusive(start, end),
        "month_days": days_in_month(begda),
        "share": proration(start, end, begda),
    })


def _absence_join(t: Tables) -> DataFrame:
    absences = t.absences().withColumn("days", F.col("days").cast("bigint"))
    joined = joins.point_in_interval(
        _clipped(t), absences.withColumnRenamed("payee", "_payee"), "payee", "_payee",
        ("clip_start", "clip_end"), "start_date",
    )
    return joined.drop("clip_start", "clip_end")


def _null_defaults(t: Tables) -> DataFrame:
    area = F.col("area")
    return t.history().select(
        "payee", "store", "role", "status", iso_date(F.col("date_start")).alias("date_start_text"),
        area_default(area, F.lit("L")).alias("area_store_a"),
        area_default(area, F.lit("EB")).alias("area_store_b"),
    )


def _newest_snapshot(t: Tables) -> DataFrame:
    runs = t.events.select(
        "event_id", "event_type", "user_id", "value", "props",
        F.date_format("ts", "yyyy-MM-dd HH").alias("run"),
    )
    return latest.newest_per_family(runs, "event_type", "run")


def _read_back(t: Tables, folder: str, sep: str) -> DataFrame:
    """Rows of delimited files, as text, with the name of their file."""
    return load_text_csv(t.spark, folder, sep).withColumn("file", F.col("_metadata.file_name"))


def _exported_files(t: Tables) -> DataFrame:
    out = own_folder(t.spark, "exported")
    export_batches(numbering.assign_batches(t.items(), ITEM_KEY, 8000), out, "items")
    return _read_back(t, f"{out}/items", ";")


def _published_files(t: Tables) -> DataFrame:
    out = own_folder(t.spark, "published")
    profile = publish.PROFILES["it15"]
    publish.publish_latest_batch(t.spark, t.pay_records(), profile, out)
    return _read_back(t, f"{out}/{profile.prefix}", profile.sep)


def _recoded_file(t: Tables) -> DataFrame:
    source = f"{own_folder(t.spark, 'recoded')}/customer.csv"
    export_table(t.customer, source)
    return load_text_csv(t.spark, recoding.recode_file(t.spark, source, pairs=SEGMENTS))


def _wage_records(t: Tables) -> DataFrame:
    """Records whose priorities stand for wage types of the shipped profiles."""
    wage_type = F.get(F.array(*map(F.lit, WAGE_TYPES)), F.substring("LGART", 1, 1).cast("int") - 1)
    return t.pay_records().withColumn("LGART", wage_type)


def _published_profiles(t: Tables) -> DataFrame:
    """The manifests of the shipped profiles, unchanged."""
    out = own_folder(t.spark, "profiles")
    manifests = publish.publish_profiles(t.spark, _wage_records(t), publish.PROFILES.values(), out)
    return manifests.select("profile", "batch_no", "rows", "first_PERNR", "last_PERNR", "file")


def _published_profile_rows(t: Tables) -> DataFrame:
    """The rows of the files that the shipped profiles publish, read back."""
    out = own_folder(t.spark, "profiles")
    manifests = publish.publish_profiles(t.spark, _wage_records(t), publish.PROFILES.values(), out)
    rows = []
    for name in sorted(r.profile for r in manifests.select("profile").distinct().collect()):
        profile = publish.PROFILES[name]
        read = _read_back(t, f"{out}/{name}/{profile.prefix}", profile.sep)
        rows.append(read.withColumn("profile", F.lit(name)))
    return reduce(DataFrame.unionByName, rows)


def _recoded_names(t: Tables) -> DataFrame:
    """All customers with the names that the shipped dictionary replaces, and notes over two lines."""
    source = f"{own_folder(t.spark, 'named')}/customer.csv"
    old = [pair[0] for pair in fixed.PLACE_NAMES + fixed.DIVISION_NAMES]
    name = F.get(F.array(*map(F.lit, old)), (F.col("c_custkey") % (len(old) + 1)).cast("int"))
    note = F.concat(F.lit('said "'), "c_mktsegment", F.lit('",\n'), F.col("c_custkey").cast("string"), F.lit("\n"))
    export_table(t.customer.select("c_custkey", name.alias("name"), note.alias("note")), source)
    return load_text_csv(t.spark, recoding.recode_file(t.spark, source))


def _typed_csv_breaks(t: Tables) -> DataFrame:
    out = own_folder(t.spark, "broken")
    note = F.concat("o_orderpriority", F.lit("\n5,"), "o_orderstatus", F.lit('"\n'))
    rows = t.orders.select("o_orderkey", note.alias("note"), "o_totalprice")
    export_table(rows, out)
    return load_csv(t.spark, out, rows.schema)


def _long_intervals(t: Tables) -> DataFrame:
    """Orders and line items under way at the same time, of one in a hundred groups of both.

    Only sums over an order's items are asked for, so items of one group and interval are joined as
    one row with their own sums: an order meets as many rows as there are intervals, not items.
    """
    day = F.col("o_orderdate").cast("date")
    orders = t.orders.select(
        (F.col("o_custkey") % 100).alias("group"), "o_orderkey", day.alias("ordered"),
        F.date_add(day, (F.col("o_orderkey") % 40).cast("int")).alias("closed"))
    sent = F.col("l_shipdate").cast("date")
    items = t.lineitem.select(
        (F.col("l_suppkey") % 100).alias("_group"), F.col("l_orderkey"), "l_linenumber", sent.alias("sent"),
        F.date_add(sent, F.col("l_linenumber")).alias("arrived"))
    summed = intervals.equal_intervals(items, "_group", ("sent", "arrived"), {
        "_items": F.count("*"), "_order_sum": F.sum("l_orderkey")})
    joined = intervals.binned_interval_join(
        orders, summed, "group", "_group", ("ordered", "closed"), ("sent", "arrived"))
    return joined.groupBy("group", "o_orderkey", "ordered", "closed").agg(
        F.coalesce(F.sum("_items"), F.lit(0)).alias("items"), F.sum("_order_sum").alias("order_sum"),
        F.min("sent").alias("first_sent"))


def _hot_key_join(t: Tables) -> DataFrame:
    """Line items, a third of them under one key, sent in a period of each nation's key."""
    first = F.date_add(F.lit("1994-01-01").cast("date"), 100 * F.col("n_nationkey"))
    nations = t.nation.withColumns({
        "k": F.when(F.col("n_nationkey") % 2 == 0, 0).otherwise(F.col("n_nationkey")),
        "first_day": first, "last_day": F.date_add(first, F.col("n_regionkey") * 30)})
    items = t.lineitem.select(
        F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_suppkey")).alias("_key"),
        F.col("l_shipdate").cast("date").alias("sent"), "l_orderkey", "l_quantity")
    joined = hot_keys.salted_left_join(
        nations, items, {"_key": F.col("k")}, ("sent", F.col("first_day"), F.col("last_day")), rows=1000)
    return joined.groupBy("n_nationkey", "n_name", "first_day", "last_day").agg(
        F.count("l_orderkey").alias("items"), F.sum("l_orderkey").alias("order_sum"),
        F.round(F.sum("l_quantity"), 2).alias("quantity"))


def _kept_pages(t: Tables) -> DataFrame:
    """Two far pages of all line items from one index."""
    items = t.lineitem.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    index = pages.build_page_index(items, ITEM_KEY, own_folder(t.spark, "pages"))
    return index.page(3000, 2500).unionByName(index.page(index.rows - 700, 1000))


def _typed_csv(t: Tables) -> DataFrame:
    out = own_folder(t.spark, "typed")
    export_table(t.orders, out)
    return load_csv(t.spark, out, t.orders.schema).withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def _refreshed_tables(t: Tables) -> DataFrame:
    out = own_folder(t.spark, "refreshed")
    refresh_tables({"customer": t.region}, out)
    refresh_tables({"customer": t.customer}, out)
    return t.spark.read.parquet(f"{out}/customer")


def _published_snapshot(t: Tables) -> DataFrame:
    """All orders, published as the newest files of families that also have an older one each."""
    made, source, out = (own_folder(t.spark, name) for name in ("made", "families", "snapshots"))
    orders = numbering.assign_batches(t.orders, ["o_orderkey"], SNAPSHOT_ROWS)
    files = orders.schema["batch_no"].metadata["batches"]
    older = t.region.crossJoin(t.spark.range(1, files + 1).withColumnRenamed("id", "batch_no"))
    older = older.withColumn("row_no", F.lit(1)).withMetadata("batch_no", {"batches": files})
    families = [f"orders-{n:06d}" for n in range(1, files + 1)]
    for part, rows in (("first", older), ("second", orders)):
        export_batches(rows, made, part)
        for n, family in enumerate(families, 1):
            move_file(t.spark, f"{made}/{part}/{part}-{n}.txt", f"{source}/{family}-{part}.txt")
    snapshots.publish_newest(t.spark, source, out, [*families, "absent"])
    read = load_csv(t.spark, f"{out}/orders-*.csv", t.orders.schema, ";")
    return read.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


_BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {
    "project_17": lambda t: t.pay_records(),
    "filter_status": lambda t: t.pay_records().filter(F.col("ZSTAT") == "N"),
    "paged_read": lambda t: numbering.assign_batches(
        t.items(), ITEM_KEY, 10_000
    ).withColumnRenamed("batch_no", "page_no"),
    "page_at_offset": lambda t: numbering.page(t.items(), ITEM_KEY, 3000, 2500),
    "latest_batch_strict": lambda t: latest.latest_batch(t.pay_records(), "5-LOW"),
    "latest_batch_loose": lambda t: latest.latest_batch(
        t.pay_records_fine(), "1-URGENT", strict=False
    ),
    "latest_batch_all": lambda t: latest.latest_batch(t.pay_records()).orderBy(
        F.col("PERNR").asc_nulls_last()
    ),
    "latest_batch_by_category": lambda t: latest.latest_batch_by(t.pay_records()),
    "latest_batch_by_category_loose": lambda t: latest.latest_batch_by(
        t.pay_records_fine(), strict=False
    ),
    "batch_count": lambda t: latest.row_count(t.items()),
    "batch_manifest": lambda t: numbering.batch_manifest(
        numbering.assign_batches(t.items(), ITEM_KEY, 8000), ITEM[:2], 8000
    ),
    "export_batches": lambda t: numbering.assign_batches(t.items(), ITEM_KEY, 8000),
    "sales_same_month": lambda t: _pair_sales(t, "sales", 0),
    "sales_prior_year": lambda t: _pair_sales(t, "prior_sales", 12),
    "sales_growth": lambda t: incentive.pair_growth(t.pairs(), t.store_sales()).select(
        "store_a", "store_b", "begda", "sales", "prior_sales", "growth"
    ),
    "focus_prior_month": lambda t: joins.month_join(
        t.pairs().select("store_a", "store_b", "begda"),
        t.store_focus().select(
            F.col("store").alias("_store"), F.col("begda").alias("_date"), "focus"
        ),
        "store_b", "_store", "begda", "_date", 1,
    ),
    "focus_code": lambda t: incentive.pair_focus(t.pairs(), t.store_focus()).select(
        "store_a", "store_b", "begda", "focus_a", "focus_b"
    ),
    "month_shift": _month_shift,
    "band_table": lambda t: lookups.band_table(t.inflation()).select(
        "begda", "rate", "band", "low", "high"
    ),
    "band_lookup": lambda t: lookups.band_lookup(
        incentive.pair_growth(t.pairs(), t.store_sales()), "growth", _rate(t)
    ).select("store_a", "store_b", "begda", "growth", "band"),
    "value_as_of": _value_as_of,
    "tariff_lookup": _tariff_stage,
    "null_defaults": _null_defaults,
    "store_union": lambda t: joins.store_union(t.pairs()),
    "history_semi_join": lambda t: joins.history_for(t.pairs(), t.history()),
    "role_prefix_filter": lambda t: t.history().filter(
        F.col("role").startswith("L") | F.col("role").startswith("E")
    ),
    "history_dedup": lambda t: _worked(t).filter(F.col("role").startswith("L"))
    .drop("role").distinct(),
    "interval_overlap_join": _worked,
    "proration": _prorated,
    "absence_join": _absence_join,
    "absence_rollup": _leaders,
    "active_absences": lambda t: joins.active_only(
        t.absences().withColumn("days", F.col("days").cast("bigint")), t.absence_types()
    ),
    "payout_detail": _payout,
    "payout_summary": lambda t: incentive.payout_summary(_payout(t)),
    "duplicate_keys": lambda t: joins.duplicate_keys(
        t.history(), ["store", "date_start", "payee"]
    ),
    "money_format": lambda t: _number_text(t).withColumn(
        "money_text", money_text(F.col("number_text"))
    ),
    "int_truncate": lambda t: _number_text(t).select(
        "o_orderkey", int_trunc(F.col("number_text")).alias("whole"),
        int_trunc(F.concat(F.lit("-"), "number_text")).alias("negative_whole"),
    ),
    "cast_date": _cast_date,
    "date_text": lambda t: t.orders.select(
        "o_orderkey", iso_date(F.col("o_orderdate")).alias("order_date")
    ),
    "exported_files": _exported_files,
    "published_files": _published_files,
    "recoded_file": _recoded_file,
    "value_recode": lambda t: recode(
        t.customer, SEGMENTS
    ),
    "value_recode_parts": lambda t: recode(
        t.part,
        [("Brand#1", "Brand#One"), ("PROMO", "ECONOMY"), ("ECONOMY", "BASIC")],
    ),
    "newest_snapshot": _newest_snapshot,
    "published_profiles": _published_profiles,
    "published_profile_rows": _published_profile_rows,
    "recoded_names": _recoded_names,
    "typed_csv_breaks": _typed_csv_breaks,
    "hot_key_join": _hot_key_join,
    "kept_pages": _kept_pages,
    "long_intervals": _long_intervals,
    "typed_csv": _typed_csv,
    "refreshed_tables": _refreshed_tables,
    "published_snapshot": _published_snapshot,
}


def _registered(build: Callable[[Tables], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(Tables(spark, sf_dir)))

    return run


QUERIES = {name: _registered(build) for name, build in _BUILDERS.items()}
