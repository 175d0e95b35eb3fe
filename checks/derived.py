"""Job inputs derived by formula from the synthetic tables; `checks.oracle` has them as SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stipend.functions.dates import month_start


class Tables:
    """The synthetic tables of one folder, and the job inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table

    def _records(self, unit: str, hours: int) -> DataFrame:
        key = F.col("o_orderkey")
        day = F.col("o_orderdate").cast("date")
        return self.orders.select(
            F.col("o_custkey").cast("string").alias("PERNR"),
            F.col("o_orderpriority").alias("LGART"),
            day.alias("BEGDA"),
            (key % 31).cast("string").alias("ANZHL"),
            F.lit("H").alias("PTZEINH"),
            F.format_string("%.2f", "o_totalprice").alias("BETRG"),
            F.lit("MXN").alias("WAERS"),
            day.alias("ESTDT"),
            key.cast("string").alias("ZUORD"),
            F.trunc(day, unit).alias("DATUM"),
            F.concat(F.lpad((key % hours).cast("string"), 2, "0"), F.lit(":00:00")).alias("ZUTIMER"),
            F.when(F.col("o_orderstatus") == "O", "N").otherwise(F.col("o_orderstatus"))
            .alias("ZSTAT"),
            F.lit("").alias("ZFPROC"),
            F.lit("").alias("ZUTIME"),
            F.lit("").alias("ZUPROC"),
            F.lit("").alias("ZDESCST"),
            F.lit("15").alias("ZINFOTIPO"),
        )

    def pay_records(self) -> DataFrame:
        return self._records("year", 24)

    def pay_records_fine(self) -> DataFrame:
        return self._records("month", 12)

    def pairs(self) -> DataFrame:
        stores = self.supplier.agg(F.count("*")).scalar()
        key = F.col("s_suppkey")
        begda = F.make_date(F.lit(1999), F.col("month"), F.lit(1))
        return self.supplier.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12)))).select(
            key.alias("store_a"),
            ((key + 1) % stores).alias("store_b"),
            begda.alias("begda"),
            F.last_day(begda).alias("endda"),
            F.concat(F.lit("W"), (key % 3).cast("string")).alias("wage_type"),
            (F.col("s_nationkey") % 3 + 1).alias("case_id"),
            F.when(key % 10 == 9, 0).otherwise(1).alias("ids"),
        )

    def store_sales(self) -> DataFrame:
        shipped = F.col("l_shipdate").cast("date")
        return (
            self.lineitem.groupBy(F.col("l_suppkey").alias("store"), month_start(shipped).alias("m"))
            .agg(
                F.max(shipped).alias("sale_date"),
                F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).alias("amount"),
            )
            .select(
                "store", "sale_date", F.col("amount").cast("decimal(14,2)").alias("amount"),
                F.lit(1).alias("status"),
            )
        )

    def store_focus(self) -> DataFrame:
        key = F.col("s_suppkey")
        begda = F.add_months(F.lit("1998-12-01").cast("date"), F.col("step"))
        letter = F.substring(F.lit("EICDX"), ((key + F.month(begda)) % 5 + 1).cast("int"), F.lit(1))
        return (
            self.supplier.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(11))))
            .select(
                key.alias("store"),
                begda.alias("begda"),
                F.when(key % 11 != 3, letter).alias("focus"),
            )
        )

    def tariff(self) -> DataFrame:
        cases = self.spark.range(1, 4).select(F.col("id").cast("int").alias("case_id"))
        rates = cases.withColumn("focus", F.explode(F.sequence(F.lit(0), F.lit(4)))).withColumn(
            "band", F.explode(F.sequence(F.lit(1), F.lit(7)))
        )
        case, focus, band = F.col("case_id"), F.col("focus"), F.col("band")
        return rates.filter(~((case == 3) & (focus == 0))).select(
            case, focus, band,
            (band * 100 + focus * 10 + case).cast("decimal(14,2)").alias("pay_leader"),
            (band * 80 + focus * 5 + case).cast("decimal(14,2)").alias("pay_manager"),
            (band * 20 + focus * 2 + case).cast("decimal(14,2)").alias("pay_leader_focus"),
        )

    def fixed_inflation(self) -> DataFrame:
        """One rate over the whole test period."""
        return self.spark.sql(
            "SELECT CAST(0.0450 AS DECIMAL(14,4)) AS rate, DATE'1995-01-01' AS begda, "
            "DATE'2005-12-31' AS endda"
        )

    def inflation(self) -> DataFrame:
        """One rate per month, made from the number of items shipped in it."""
        begda = month_start(F.col("l_shipdate").cast("date"))
        return self.lineitem.groupBy(begda.alias("begda")).agg(F.count("*").alias("n")).select(
            ((F.col("n") % 900).cast("decimal(14,4)") / F.lit(10000)).cast("decimal(14,4)")
            .alias("rate"),
            "begda",
            F.last_day("begda").alias("endda"),
        )

    def history(self) -> DataFrame:
        stores = self.supplier.agg(F.count("*")).scalar()
        key = F.col("c_custkey")
        role = F.coalesce(
            F.create_map(*[F.lit(x) for x in (
                "MACHINERY", "L1", "BUILDING", "L2", "AUTOMOBILE", "E1", "FURNITURE", "E2",
            )])[F.col("c_mktsegment")],
            F.lit("X"),
        )
        # Every fifth employee has a second, wider row, every sixth an exact copy of the first.
        widths = F.array_compact(
            F.array(F.lit(0), F.when(key % 5 == 0, 30), F.when(key % 6 == 0, 0))
        )
        start = F.date_add(F.lit("1998-06-01").cast("date"), (key * 37 % 500).cast("int"))
        end = F.date_add(start, (key * 13 % 300).cast("int"))
        return self.customer.withColumn("width", F.explode(widths)).select(
            key.alias("payee"),
            (key % stores).alias("store"),
            role.alias("role"),
            F.when(key % 7 == 0, 0).otherwise(1).alias("status"),
            F.date_sub(start, F.col("width")).alias("date_start"),
            F.date_add(end, F.col("width")).alias("date_end"),
            F.when(key % 4 != 0, F.col("c_nationkey").cast("string")).alias("area"),
        )

    def absences(self) -> DataFrame:
        return self.orders.select(
            F.col("o_custkey").alias("payee"),
            F.col("o_orderdate").cast("date").alias("start_date"),
            (F.col("o_orderkey") % 3 + 1).cast("int").alias("days"),
            F.col("o_orderpriority").alias("type"),
        )

    def absence_types(self) -> DataFrame:
        return self.orders.select(F.col("o_orderpriority").alias("type")).distinct().withColumn(
            "status", F.when(F.col("type").startswith("5"), 0).otherwise(1)
        )

    def items(self) -> DataFrame:
        """The rows the export queries number."""
        return self.lineitem.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").alias("l_shipdate"),
        )
