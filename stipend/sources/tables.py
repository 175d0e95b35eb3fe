"""Record tables and interchange files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stipend import fixed_values as fixed
from stipend.sources.records import crosses_lines, parse_records, whole_records


def replica(spark: SparkSession, source: str, fmt: str = "parquet", **options) -> DataFrame:
    """The 17 record columns of a path, of a catalog table (`fmt="table"`), or of any source
    Spark reads, such as `fmt="jdbc"` with its partitioning options.

    Pages are not needed to read a whole table: Spark reads it in partitions.
    """
    if fmt == "table":
        rows = spark.table(source)
    elif fmt == "jdbc":
        rows = spark.read.format(fmt).options(dbtable=source, **options).load()
    else:
        rows = spark.read.format(fmt).options(**options).load(source)
    return rows.select(*fixed.RECORD_COLUMNS)


def load_csv(
    spark: SparkSession, path: str, schema: StructType | str, sep: str = ",",
    header: bool = True, multiline: bool = False,
) -> DataFrame:
    """Delimited text as typed columns, by position; a row that does not fit is an error, also in
    columns that are not selected: all are parsed.

    Quoted cells may hold line breaks. One pass looks for such cells; without any, Spark's reader
    takes the files line by line, else the records are put together by `whole_records`. Both read a
    file by many tasks. `multiline` leaves all to Spark's reader, which then takes each file whole in
    one task; it is needed only where records end in a carriage return alone.
    """
    if multiline or not crosses_lines(spark, path, sep):
        return (
            spark.read.schema(schema)
            .options(header=header, sep=sep, escape='"', mode="FAILFAST", multiLine=multiline,
                     enforceSchema=True, columnPruning=False)
            .csv(path)
        )
    if isinstance(schema, StructType):
        schema = schema.toDDL()
    records = whole_records(spark, path, sep)
    return parse_records(records.where(~F.col("is_first")) if header else records, schema, sep)


def load_text_csv(spark: SparkSession, path: str, sep: str = ",", multiline: bool = False):
    """Delimited UTF-8 text with a header, with or without byte order mark, all cells as text.

    A row with more or fewer cells than the header is an error, and so is a quoted cell that is not
    closed. Line breaks inside quoted cells, and `multiline`, are as in `load_csv`.
    """
    crossing = not multiline and crosses_lines(spark, path, sep)
    rows = spark.read.options(
        header=True, sep=sep, escape='"', inferSchema=False, multiLine=multiline or crossing,
        mode="FAILFAST", columnPruning=False,
    ).csv(path)
    if not crossing:
        return rows
    # Spark's reader took the names from the first record alone.
    records = whole_records(spark, path, sep).where(~F.col("is_first"))
    cells = ", ".join(f"_{n} string" for n in range(len(rows.columns)))
    return parse_records(records, cells, sep).toDF(*[c.removesuffix("\r") for c in rows.columns])


def load_payout_inputs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The interchange files of the payout job, with the column names used here."""
    inputs = {}
    for name, (file, columns) in fixed.PAYOUT_FILES.items():
        schema = ", ".join(f"`{i}_{c}` {kind}" for i, (c, _, kind) in enumerate(columns))
        rows = load_csv(spark, f"{folder.rstrip('/')}/{file}", schema)
        inputs[name] = rows.select(
            *[F.col(f"`{i}_{c}`").alias(used) for i, (c, used, _) in enumerate(columns) if used]
        )
    return inputs
