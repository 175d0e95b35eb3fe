"""Records of delimited text that cross line breaks, found in parallel.

Whether a line break ends a record depends on all the text before it. But a line can only do one of
four things with a quoted cell: leave it as it is, open or close it, end inside, or end outside.
These steps can be joined in any grouping, so each split of a file is summed up by itself, the sums
of the splits are joined in order, and every line then knows how it begins.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stipend.shared import stage

_UNCLOSED = "a quoted cell is not closed at the end of "
_BREAK = "a carriage return outside quotes within a line of "


def _ends_inside(line: Column, sep: str) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted cell if it begins outside one, and if it begins inside.

    Only a quote at the beginning of a cell opens it, and doubled quotes are none. All loops of the
    patterns are possessive: they neither backtrack nor recurse, however long the line.
    """
    plain = F.replace(line, F.lit('""'), F.lit(""))
    s = re.escape(sep)
    cells = f'(?:"[^"]*+"{s}|[^"{s}][^{s}]*+{s}|{s})*+'
    outside = plain.rlike(f'^{cells}"[^"]*+$')
    inside = plain.rlike(f'^[^"]*+(?:"{s}{cells}"[^"]*+)?$')
    quoted = line.contains('"')
    return quoted & outside, ~quoted | inside


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files without their line feed, as `value`, with `file`, `split` (where it begins
    in the file) and `at`, which rises within the split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"))


def crosses_lines(spark: SparkSession, path: str, sep: str) -> bool:
    """Whether some quoted cell holds a line break: some line that begins outside quotes ends inside.

    As all do begin outside up to the first that does so, one look at each line suffices; the look
    ends when one is found.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    return not lines.where(_ends_inside(_without_return(F.col("value")), sep)[0]).isEmpty()


def _without_return(line: Column) -> Column:
    return F.when(line.endswith("\r"), F.substr(line, F.lit(1), F.length(line) - 1)).otherwise(line)


def _state_after(lines: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add `known` and `odd` to steps `opens`, `stays` in order: after a step the text is inside
    quotes if `odd` is 1; unless `known`, if that differs from how the first step of the group begins.

    A step that ends alike from both states fixes the state; the flips since then change it.
    """
    ordered = Window.partitionBy(*keys).orderBy(order)
    flips = F.sum(F.when(F.col("opens") & ~F.col("stays"), 1).otherwise(0)).over(ordered)
    steps = lines.withColumn("_flips", flips)
    fixed = F.when(F.col("opens") == F.col("stays"), F.struct("opens", "_flips"))
    last = F.last(fixed, ignorenulls=True).over(ordered)
    return steps.withColumn("_fixed", last).withColumns({
        "known": F.col("_fixed").isNotNull(),
        "odd": F.pmod(
            F.coalesce(F.col("_fixed.opens").cast("int"), F.lit(0))
            + F.col("_flips") - F.coalesce("_fixed._flips", F.lit(0)), F.lit(2)).cast("int"),
    }).drop("_flips", "_fixed")


def whole_records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Records of delimited text files as `file`, `record` and `is_first` (of its file).

    Line breaks inside quotes stay as they are; blank lines between records are left out. A quote
    that is still open at the end of a file is an error. Lines are written once, so that splits
    and places cannot change between the passes; they are dealt by split, so no task holds more than
    one. Per file, one row per split is put in order by one task. Only the lines of records that do
    cross lines are grouped.
    """
    lines = read_lines(spark, path)
    opens, stays = _ends_inside(_without_return(F.col("value")), sep)
    lines = stage(lines.withColumns({"opens": opens, "stays": stays}), "lines")
    placed = stage(_state_after(lines, ["file", "split"], "at"), "placed")

    sums = placed.groupBy("file", "split").agg(F.max_by(F.struct("known", "odd"), "at").alias("sum"))
    # A whole split is a step too: it ends alike from both states if its end is known.
    step_opens = F.col("sum.odd") == 1
    steps = sums.select(
        "file", "split", step_opens.alias("opens"),
        F.when(F.col("sum.known"), step_opens).otherwise(~step_opens).alias("stays"))
    of_file = Window.partitionBy("file").orderBy("split")
    ended = _state_after(steps, ["file"], "split")
    started = stage(ended.select(
        "file", "split", F.lag("odd", 1, 0).over(of_file).alias("start"),
        F.when(F.lead("split").over(of_file).isNull() & (F.col("odd") == 1),
               F.raise_error(F.concat(F.lit(_UNCLOSED), "file"))).alias("unclosed")), "started")

    in_split = Window.partitionBy("file", "split").orderBy("at")
    after = F.when(F.col("known"), F.col("odd")).otherwise(F.pmod(F.col("odd") + F.col("start"), F.lit(2)))
    states = placed.join(started.where("unclosed is null").drop("unclosed"), ["file", "split"]).withColumn(
        "after", after).withColumn("before", F.coalesce(F.lag("after").over(in_split), "start"))
    # The record of a line begins at the last line so far that begins outside quotes.
    states = states.select("value", "file", "split", "at", "before", "after", F.max(
        F.when(F.col("before") == 0, F.col("at"))).over(in_split).alias("began"))
    states = stage(states, "states")

    begins = states.groupBy("file", "split").agg(F.max("began").alias("began"), F.min("at").alias("first_at"))
    earlier = of_file.rowsBetween(Window.unboundedPreceding, -1)
    begins = stage(begins.select(
        "file", "split", F.last(F.when(F.col("began").isNotNull(), F.struct("split", "began")),
                                ignorenulls=True).over(earlier).alias("carried"),
        F.min(F.struct("split", "first_at")).over(of_file).alias("first")), "begins")
    begun = states.join(begins, ["file", "split"]).select(
        "value", "file", "split", "at", "before", "after", "first",
        F.when(F.col("began").isNotNull(), F.struct("split", "began")).otherwise(F.col("carried")).alias("record_at"))
    is_first = F.col("record_at") == F.struct(F.col("first.split"), F.col("first.first_at").alias("began"))
    alone = (F.col("before") == 0) & (F.col("after") == 0)
    single = begun.where(alone).select("file", _without_return(F.col("value")).alias("record"), is_first.alias("is_first"))
    parts = F.array_sort(F.collect_list(F.struct("split", "at", "value")))
    crossing = begun.where(~alone).groupBy("file", "record_at", "first").agg(parts.alias("parts")).select(
        "file", _without_return(F.array_join("parts.value", "\n")).alias("record"), is_first.alias("is_first"))
    records = single.where("trim(record) <> ''").unionByName(crossing)
    bare = F.regexp_replace("record", '"[^"]*+"', "")
    return records.withColumn("record", F.when(
        F.col("record").contains("\r") & bare.contains("\r"),
        F.raise_error(F.concat(F.lit(_BREAK), "file"))).otherwise(F.col("record")))


def parse_records(records: DataFrame, schema: str, sep: str) -> DataFrame:
    """Cells of records as the columns of `schema`; a record that does not fit is an error."""
    options = {"sep": sep, "escape": '"', "mode": "FAILFAST", "multiLine": "true", "columnPruning": "false"}
    return records.select(F.from_csv("record", schema, options).alias("cells")).select("cells.*")
