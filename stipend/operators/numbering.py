"""Row numbers over a total order, and the bounded batches and pages cut from them."""

from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stipend.shared import own_folder, released, stage, write_stage

# monotonically_increasing_id: partition number above these bits, position in the partition below.
_POSITION_BITS = 33


def _order(df: DataFrame, keys: list[str]):
    """`keys`, then every other column, so that only exact copies stay tied. Nulls come last."""
    rest = [c for c in df.columns if c not in keys]
    return [F.col(f"`{c}`").asc_nulls_last() for c in [*keys, *rest]]


def number_rows(df: DataFrame, keys: list[str], unique: bool = False) -> DataFrame:
    """Add `row_no`, 1 … n in the order of `keys`, ties in the order of the other columns.

    The rows are split into key ranges, sorted within each range and written to the shared folder
    with their range and position. The ranges' sizes, one number per range, give the number of
    rows before each of them; no task sees more than one range, and no window over all rows is
    needed. The written positions cannot move when an executor is lost.

    Ranges are also split inside a group of exact copies: copies are interchangeable, and the
    input partition they come from is last in the range key. So no more copies stay together than
    one input partition holds. `unique=True` says that `keys` tell all rows apart.

    The metadata of `row_no` carry the number of `rows`.
    """
    placed, before = _placed(df, keys, unique)
    numbered = placed.withColumn("row_no", _row_no(before)).drop("_place")
    return numbered.withMetadata("row_no", {"rows": before[-1]})


def range_sorted(df: DataFrame, keys: list[str], unique: bool = False) -> DataFrame:
    """The rows in key ranges, one per partition, sorted within each."""
    order = _order(df, keys)
    if unique:
        by_range = order[: len(keys)]
    else:
        df = df.withColumn("_from", F.spark_partition_id())
        by_range = [*order, F.col("_from").asc()]
    return df.repartitionByRange(*by_range).sortWithinPartitions(*by_range).drop("_from")


def _placed(df: DataFrame, keys: list[str], unique: bool) -> tuple[DataFrame, list[int]]:
    """The written rows with `_place`, which rises with the row number, and the number of rows
    before each range, then of all."""
    ranged = range_sorted(df, keys, unique).withColumn("_place", F.monotonically_increasing_id())
    placed = stage(ranged, "numbered")
    # One number per shuffle partition: bounded by the partition count, whatever the data.
    sizes = dict(placed.groupBy(F.shiftright("_place", _POSITION_BITS)).count().collect())
    counts = [sizes.get(number, 0) for number in range(max(sizes, default=0) + 1)]
    return placed, list(accumulate(counts, initial=0))


def _row_no(before: list[int]) -> Column:
    # A split text and not an array of literals, which would be an expression per range.
    of_range = one_of(before, F.shiftright("_place", _POSITION_BITS))
    return of_range + F.col("_place").bitwiseAND((1 << _POSITION_BITS) - 1) + 1


def one_of(numbers: Sequence[int], index: Column) -> Column:
    """The number at `index`, from 0."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")[index.cast("int")]


def number_groups(
    df: DataFrame, group: str, groups: int, keys: list[str], unique: bool = False
) -> DataFrame:
    """`number_rows` for each value 0 … `groups` - 1 of the column `group`, from 1 anew.

    All groups are numbered together, by one range shuffle, sort and write: in the order of group and
    keys, a row's number in its group is its number less the rows of the groups before. One count
    per group comes to the driver. The metadata of `row_no` carry the `rows` of every group.
    """
    numbered = number_rows(df, [group, *keys], unique)
    counted = dict(numbered.groupBy(group).count().collect())
    rows = [counted.get(n, 0) for n in range(groups)]
    before = one_of([0, *accumulate(rows)], F.col(group))
    return numbered.withColumn("row_no", F.col("row_no") - before).withMetadata("row_no", {"rows": rows})


def assign_batches(
    df: DataFrame, keys: list[str], size: int, unique: bool = False
) -> DataFrame:
    """Add `row_no` and `batch_no`; batch k holds rows (k-1)·size+1 … k·size. The metadata of
    `batch_no` carry the number of `batches`."""
    numbered = number_rows(df, keys, unique)
    batches = -(-numbered.schema["row_no"].metadata["rows"] // size)
    return numbered.withColumn("batch_no", F.expr(f"(row_no - 1) div {int(size)} + 1")).withMetadata(
        "batch_no", {"batches": batches})


def assign_group_batches(
    df: DataFrame, group: str, sizes: Sequence[int], keys: list[str], unique: bool = False
) -> DataFrame:
    """`assign_batches` for each value n of `group`, in batches of `sizes[n]` rows, by one numbering."""
    numbered = number_groups(df, group, len(sizes), keys, unique)
    rows = numbered.schema["row_no"].metadata["rows"]
    batches = [-(-n // size) for n, size in zip(rows, sizes)]
    batch_no = F.floor((F.col("row_no") - 1) / one_of(sizes, F.col(group))) + 1
    return numbered.withColumn("batch_no", batch_no).withMetadata("batch_no", {"batches": batches})


def batch_manifest(
    batched: DataFrame, keys: list[str], size: int | Sequence[int], null_counts: tuple[str, ...] = (),
    group: str | None = None,
) -> DataFrame:
    """Per batch of a whole result of `assign_batches`: number of rows, first and last key, and nulls
    in the columns of `null_counts`. With `group`, of `assign_group_batches` and its sizes.

    Counting needs numbers only, and the keys come from the two rows at the edges of each batch,
    so no sort of all rows is needed: two scans, whose few rows per batch are grouped again.
    """
    by = ["batch_no"] if group is None else [group, "batch_no"]
    counts = batched.groupBy(*by).agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in null_counts],
    )
    end = batched.schema["row_no"].metadata["rows"]
    if group is None:
        size, end = F.lit(size), F.lit(end)
    else:
        size, end = one_of(size, F.col(group)), one_of(end, F.col(group))
    first = (F.col("row_no") - 1) % size == 0
    last = (F.col("row_no") % size == 0) | (F.col("row_no") == end)
    edge_keys = [
        F.when(edge, F.col(k)).alias(f"{name}_{k}")
        for edge, name in ((first, "first"), (last, "last")) for k in keys
    ]
    edges = batched.filter(first | last).select(*by, *edge_keys)
    columns = ["rows", *edges.columns[len(by):], *[f"{c}_nulls" for c in null_counts]]
    # Each value comes from one row of the union; the others hold nulls there.
    return counts.unionByName(edges, allowMissingColumns=True).groupBy(*by).agg(
        *[F.max(c).alias(c) for c in columns])


def page(
    df: DataFrame, keys: list[str], offset: int, size: int, unique: bool = False
) -> DataFrame:
    """Rows offset+1 … offset+size in the order of `keys`, in that order, with their `row_no`.

    The page is one run of places, so row groups outside it are skipped by their statistics. Only
    the page stays in the shared folder, not the numbered table.
    """
    kept = own_folder(df.sparkSession, "page")
    with released():
        placed, before = _placed(df, keys, unique)
        first, end = min(offset, before[-1]), min(offset + size, before[-1])
        on_page = F.lit(False)
        if first < end:
            on_page = F.col("_place").between(_place_of(first, before), _place_of(end - 1, before))
        rows = placed.filter(on_page).withColumn("row_no", _row_no(before)).drop("_place")
        rows = write_stage(rows, kept)
    return rows.orderBy("row_no")


def _place_of(index: int, before: list[int]) -> int:
    """`_place` of the row with `index` rows before it."""
    number = bisect_right(before, index) - 1
    return (number << _POSITION_BITS) + index - before[number]
