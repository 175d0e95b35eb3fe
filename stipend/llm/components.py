"""Connected components of a distributed edge list."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stipend.shared import stage


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node that has a smaller one, as `node`, `component`.

    Nodes that are absent are the smallest of their component.
    `edges` has two columns of one orderable type, in any order and with repeats. Alternating large
    and small stars: each round is a few joins and grouped minima, combined in the task first, and
    its result is written to the shared folder, so neither lineage nor memory grows with the rounds,
    of which there are O(log² n). A node with very many neighbours is a skewed join key that
    adaptive execution splits; its neighbours are never gathered. Loops and null ends are ignored;
    no edges give no rows.
    """
    a, b = edges.columns
    stars = stage(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("node"), F.least(a, b).alias("component")).distinct(),
        "edges",
    )
    seen = _print(stars)
    while seen[0]:
        stars = stage(_small_star(_large_star(stars)), "stars")
        before, seen = seen, _print(stars)
        if seen == before:
            break
    return stars


def _print(stars: DataFrame) -> tuple:
    """Two numbers that change when the edges do."""
    mark = F.shiftright(F.xxhash64("node", "component"), 24)
    return tuple(stars.agg(F.count("*"), F.sum(mark)).first())


def _large_star(stars: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to its smallest neighbour."""
    both = stars.unionByName(
        stars.select(F.col("component").alias("node"), F.col("node").alias("component"))
    )
    least = both.groupBy("node").agg(F.min("component").alias("_least"))
    least = least.withColumn("_least", F.least("node", "_least"))
    return both.where(F.col("component") > F.col("node")).join(least, "node").select(
        F.col("component").alias("node"), F.col("_least").alias("component")
    )


def _small_star(stars: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = stars.groupBy("node").agg(F.min("component").alias("_least"))
    rest = stars.join(least, "node").where(F.col("component") != F.col("_least"))
    return rest.select(
        F.col("component").alias("node"), F.col("_least").alias("component")
    ).unionByName(least.withColumnRenamed("_least", "component")).distinct()


def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are in two classes."""
    for end in ("a", "b"):
        classes = labels.select(F.col("node").alias(end), F.col("component").alias(f"class_{end}"))
        pairs = pairs.join(classes, end, "left").withColumn(f"class_{end}", F.coalesce(f"class_{end}", end))
    return pairs.where("class_a <> class_b").select("a", "b")
