"""Mix sources to target weights by hash thresholds."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stipend.llm.rows import columns_of, packed
from stipend.shared import stage

#: Copies of a document at most.
MAX_COPIES = 3

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (1.0, 2.0, 3.0)

#: Bits of the hash that one level of the histogram resolves, and the number of levels.
LEVEL_BITS = 10
LEVELS = 3

_HASH_BITS = LEVEL_BITS * LEVELS

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def water_fill(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """`target` of every `source`, next to `source_size`.

    Sources in code point order, null last, weigh `weights`, repeating. They share the sum of all
    sizes by weight; a target stops at MAX_COPIES times its source's size and the excess is shared
    again by weight, until none is above. The sources that stop are those with the smallest size
    per weight, so one pass over the sources in that order finds where sharing settles. `sizes` has
    a row per source: one task orders the sources, never the documents.
    """
    # At 30 bytes a source, ten million sources are 300 MB in that one task.
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("_n", F.row_number().over(named) - 1).withColumn(
        "_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                           (F.col("_n") % len(weights) + 1).cast("int"))
    )
    most = F.col("source_size") * MAX_COPIES
    poorest = Window.orderBy(most / F.col("_w"), "_n")
    before = poorest.rowsBetween(Window.unboundedPreceding, -1)
    rest = poorest.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(most).over(before), F.lit(0))
    shared = left / F.sum("_w").over(rest)  # per weight, if all poorer sources stop
    settled = weighed.select(
        "source", "source_size", "_w", most.alias("_most"), shared.alias("_share"),
        (shared * F.col("_w") <= most).alias("_below"), F.row_number().over(poorest).alias("_rank"),
    )
    # From the first source that does not stop on, all share alike.
    level = F.min(F.when(F.col("_below"), F.struct("_rank", "_share"))).over(whole)["_share"]
    return settled.withColumn("_level", level).select(
        "source", "source_size",
        F.least(F.col("_most").cast("double"),
                F.coalesce(F.col("_level") * F.col("_w"), F.col("_most").cast("double"))
                ).alias("target"),
    )


def thresholds(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Per `source`: `source_size`, `target`, `_whole` copies of each document and the `_below`
    hash under which a document gets one more.

    `rows` has `source`, `size` and `_hash`. The first level sums sizes by source and the top hash
    bits; running sums over these few buckets find the one in which the budget left after whole
    copies ends. Only the rows of that bucket are summed again by the next bits, and so on. The
    last bucket is taken in if that comes nearer to the budget. Sums are combined in each task, so
    a source that holds a third of all rows sends one row per bucket and task.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = water_fill(sizes, weights)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = stage(
        sources.withColumn("_whole", F.floor(ratio).cast("bigint"))
        .withColumn("_budget", F.col("target") - F.col("_whole") * F.col("source_size"))
        .withColumn("_below", F.lit(0).cast("bigint")),
        "sources",
    )
    fields = ["source_size", "target", "_whole", "_budget", "_below"]
    inside = rows
    for level in range(LEVELS):
        shift = _HASH_BITS - LEVEL_BITS * (level + 1)
        if level:
            inside = rows.alias("r").join(
                sources.select(F.col("source").alias("_s"), "_below"),
                F.col("r.source").eqNullSafe(F.col("_s"))
                & (F.shiftright("_hash", shift + LEVEL_BITS)
                   == F.shiftright("_below", shift + LEVEL_BITS)),
            ).select("r.*")
        buckets = inside.groupBy("source", F.shiftright("_hash", shift).alias("_bucket")).agg(
            F.sum("size").alias("_sum")
        )
        order = Window.partitionBy("source").orderBy("_bucket")
        after = F.sum("_sum").over(order.rowsBetween(Window.unboundedPreceding, 0))
        placed = buckets.withColumn("_after", after).alias("b").join(
            sources.select(F.col("source").alias("_s"), "_budget"),
            F.col("b.source").eqNullSafe(F.col("_s")),
        ).select("b.*", "_budget")
        last = level == LEVELS - 1
        # Buckets that fit are passed; the boundary bucket is the first that does not.
        middle = F.col("_after") - F.col("_sum") / 2 if last else F.col("_after")
        passed = F.col("_after") <= F.col("_budget")
        taken = (middle <= F.col("_budget")) if last else passed
        step = placed.groupBy("source").agg(
            F.coalesce(F.max(F.when(passed, F.col("_after"))), F.lit(0)).alias("_used"),
            F.min(F.when(~taken, F.col("_bucket"))).alias("_edge"),
            F.max("_bucket").alias("_top"),
        ).withColumnRenamed("source", "_s")
        edge = F.coalesce(F.col("_edge"), F.col("_top") + 1)
        joined = sources.join(step, F.col("source").eqNullSafe(F.col("_s")), "left")
        sources = stage(joined.select(
            "source", "source_size", "target", "_whole",
            (F.col("_budget") - F.coalesce("_used", F.lit(0))).alias("_budget"),
            F.coalesce(F.shiftleft(edge, shift), F.col("_below")).alias("_below"),
        ), "sources")
    return sources.select("source", *[f for f in fields if f != "_budget"])


def doc_hash(id_col: Column, text: Column) -> Column:
    """The order in which documents are taken: the same in every run, whatever the partitions."""
    return F.shiftrightunsigned(F.xxhash64(id_col, text), 64 - _HASH_BITS)


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """`doc_id`, `size`, `source_size`, `target` and `taken` of every row of `docs`.

    `size` is the number of words (null text: 0), `taken` that number times the copies the mix
    takes, 0 to MAX_COPIES. Null sources form one source. Rows that are repeated whole share one
    hash and get the same copies. Empty tables give no rows; other columns are not read.
    """
    rows = stage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        doc_hash(F.col(id_col), F.col(text_col)).alias("_hash"),
    ), "sizes")
    limits = thresholds(rows, weights).withColumnRenamed("source", "_s")
    joined = rows.join(limits, F.col("source").eqNullSafe(F.col("_s")))
    return joined.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _copies()).alias("taken")
    )


def _copies() -> Column:
    more = (F.col("_hash") < F.col("_below")).cast("bigint")
    return F.least(F.col("_whole") + more, F.lit(MAX_COPIES).cast("bigint"))


def mixed_rows(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The rows of `docs` in the mix, each as often as it is taken; texts are not shuffled for it
    unless the sources are too many to broadcast."""
    text = F.col(f"`{text_col}`")
    hashed = packed(
        docs, F.col(f"`{source_col}`").alias("source"), doc_hash(F.col(f"`{id_col}`"), text).alias("_hash"))
    rows = stage(docs.select(
        F.col(f"`{source_col}`").alias("source"), word_count(text).alias("size"),
        doc_hash(F.col(f"`{id_col}`"), text).alias("_hash"),
    ), "sizes")
    limits = thresholds(rows, weights).select(F.col("source").alias("_s"), "_whole", "_below")
    joined = hashed.join(limits, F.col("source").eqNullSafe(F.col("_s")))
    times = F.sequence(F.lit(1).cast("bigint"), _copies())
    return joined.where(_copies() > 0).withColumn("_copy", F.explode(times)).select(*columns_of(docs))
