"""Pages of an ordered table from an index that is built once and kept."""

import json
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stipend.operators.numbering import range_sorted


class PageIndex:
    """Pages of the rows that `build_page_index` put in order, in this application or a later one.

    One row per range, its size and first keys, is all that the driver holds. A page, wherever it
    begins, reads the folders of the ranges it touches and of these the row groups around it;
    it sorts no more than itself.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        table = spark.read.parquet(f"{self.folder}/ranges")
        # An empty table has no file to tell its columns.
        self.schema = StructType.fromJson(json.loads(table.schema["range"].metadata["rows"]))
        ranges = table.orderBy("range").collect()
        self.ranges = [r["range"] for r in ranges]
        self.before = list(accumulate((r["rows"] for r in ranges), initial=0))
        self.first_keys = [tuple(r["first"]) for r in ranges]

    @property
    def rows(self) -> int:
        return self.before[-1]

    def page(self, offset: int, size: int) -> DataFrame:
        """Rows offset+1 … offset+size in order, with their `row_no`."""
        end = min(offset + size, self.rows)
        rows = self.spark.read.schema(self.schema).parquet(f"{self.folder}/rows")
        if offset >= end:
            return rows.where("false").withColumn("row_no", F.col("place")).drop("range", "place")
        first, last = (bisect_right(self.before, n) - 1 for n in (offset, end - 1))
        touched = rows.where(F.col("range").between(self.ranges[first], self.ranges[last]))
        # Few ranges lie between: one condition each, which the scan compares with its statistics.
        conditions, row_no = F.lit(False), F.lit(None).cast("bigint")
        for n in range(first, last + 1):
            here = F.col("range") == self.ranges[n]
            low, high = max(offset, self.before[n]), min(end, self.before[n + 1])
            conditions |= here & F.col("place").between(low - self.before[n], high - 1 - self.before[n])
            row_no = F.when(here, F.col("place") + 1 + self.before[n]).otherwise(row_no)
        return touched.where(conditions).withColumn("row_no", row_no).drop("range", "place").orderBy("row_no")

    def page_after(self, keys: tuple, size: int, key_columns: list[str]) -> DataFrame:
        """The `size` rows that follow the last row of these key values, with their `row_no`; keys
        without nulls. The ranges' first keys say which range to look into."""
        at = max(bisect_right(self.first_keys, tuple(keys)) - 1, 0)
        rows = self.spark.read.schema(self.schema).parquet(f"{self.folder}/rows").where(F.col("range") == self.ranges[at])
        later, same = F.lit(False), F.lit(True)
        for column, value in zip(key_columns, keys):
            c = F.col(f"`{column}`")
            later |= same & (c > F.lit(value))
            same &= c == F.lit(value)
        up_to = rows.where(~F.coalesce(later, F.lit(True))).agg(F.max("place")).first()[0]
        return self.page(self.before[at] + (0 if up_to is None else up_to + 1), size)


def build_page_index(df: DataFrame, keys: list[str], folder: str, unique: bool = False) -> PageIndex:
    """Put the rows of `df` in the order of `keys`, ties in that of the other columns, once, below
    `folder`: one folder of rows per key range, and a table of the ranges. See `number_rows`.

    `df` has no columns named `range` or `place`. A folder that holds an index already is an error.
    """
    spark, folder = df.sparkSession, folder.rstrip("/")
    ranged = range_sorted(df, keys, unique)
    position = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = ranged.withColumns({"place": position, "range": F.spark_partition_id()})
    placed.write.partitionBy("range").parquet(f"{folder}/rows")
    first = F.min_by(F.struct(*[f"`{k}`" for k in keys]), "place")
    written = spark.read.schema(placed.schema).parquet(f"{folder}/rows")
    sizes = written.groupBy("range").agg(F.count("*").alias("rows"), first.alias("first"))
    sizes.withMetadata("range", {"rows": placed.schema.json()}).coalesce(1).write.parquet(f"{folder}/ranges")
    return PageIndex(spark, folder)
