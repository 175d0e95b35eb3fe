"""Pairs of sets that may be similar, by prefix filtering on their rarest elements."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stipend.shared import stage

#: Ratio of the sizes of two bins of sets.
SIZE_STEP = 1.05


def sizes_within(n_a: Column, n_b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be as similar as that."""
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def rare_pairs(open_nodes: DataFrame, sets: DataFrame, percent: int, within: tuple[str, ...] = ()) -> DataFrame:
    """Pairs `a`, `b` of open nodes (`node`, `class`) of different classes that may have sets (`node`,
    `hashes`) of a Jaccard similarity of `percent`, by their rarest shingles.

    Put all sets in one order, rarest shingle first. Two linked sets of n and m >= n shingles have at
    least c = (n + m) * percent / (100 + percent) in common, so their first common one is among the
    first n - c + 1 of the smaller and the first m - c + 1 of the larger: a ninth of either at 80
    percent and equal sizes. What many nodes share comes last in that order, so texts that have a
    header or a licence in common do not meet unless they are as good as linked. A place in the
    larger set admits a range of smaller sizes, so it looks for these alone, in bins of SIZE_STEP.
    Classes meet first, their members then, so that a large class is not compared within itself.

    Nodes only meet if they agree in the columns `within`, which the pairs have, too. What is rare is
    counted there alone: what brought such a group together is not, so its nodes do not meet by it.
    """
    group, shingle = list(within), [*within, "h"]
    held = open_nodes.join(sets, "node").select(*group, "node", "class", F.explode("hashes").alias("h"))
    often = held.groupBy(shingle).agg(
        F.count("*").alias("times"), (F.min("class") < F.max("class")).alias("several"))
    ranked = held.join(often, shingle).groupBy(*group, "node", "class").agg(
        F.array_sort(F.collect_list(F.struct("times", "h", "several"))).alias("order"))
    as_larger = F.size("order") - F.ceil(F.size("order") * percent / 100).cast("int") + 1
    firsts = stage(
        ranked.select(*group, "node", "class", F.size("order").cast("bigint").alias("n"),
                      F.posexplode(F.slice("order", F.lit(1), as_larger)).alias("place", "s"))
        .where("s.several").select(*group, "node", "class", "n", (F.col("n") - F.col("place")).alias("left"),
                                   F.col("s.h").alias("h")), "firsts")

    def enough(n_a: str, n_b: str, left_a: str, left_b: str) -> Column:
        """Whether this can be the first common shingle of linked sets: no more can follow than is left."""
        least = F.least(left_a, left_b) * (100 + percent)
        return least >= percent * (F.col(n_a) + F.col(n_b))

    def bin_of(n: Column) -> Column:
        return F.floor(F.log(n) / math.log(SIZE_STEP)).cast("int")

    smallest = F.col("n") * percent / 100
    greatest = F.least(F.col("n"), F.col("left") * (100 + percent) / percent - F.col("n"))
    smaller = firsts.where(F.col("left") * (100 + percent) >= 2 * percent * F.col("n")).select(
        *shingle, bin_of(F.col("n")).alias("bin"), F.col("class").alias("class_a"), F.col("node").alias("a"),
        F.col("n").alias("n_a"), F.col("left").alias("left_a"))
    larger = firsts.where(smallest <= greatest).select(
        *shingle, F.explode(F.sequence(bin_of(smallest), bin_of(greatest))).alias("bin"), F.col("class").alias("class_b"),
        F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("left").alias("left_b"))
    # At best, the members of two classes are as small and have as much left as any of them.
    class_a = smaller.groupBy(*shingle, "bin", "class_a").agg(F.min("n_a").alias("some_n_a"), F.max("left_a").alias("some_left_a"))
    class_b = larger.groupBy(*shingle, "bin", "class_b").agg(F.min("n_b").alias("some_n_b"), F.max("left_b").alias("some_left_b"))
    met = class_a.join(class_b, [*shingle, "bin"]).where(
        (F.col("class_a") != F.col("class_b")) & enough("some_n_a", "some_n_b", "some_left_a", "some_left_b"))
    some = met.drop("some_n_a", "some_left_a").join(smaller, [*shingle, "bin", "class_a"]).where(
        enough("n_a", "some_n_b", "left_a", "some_left_b"))
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    return some.join(larger, [*shingle, "bin", "class_b"]).where(
        ordered & sizes_within(F.col("n_a"), F.col("n_b"), percent) & enough("n_a", "n_b", "left_a", "left_b")
    ).select(*group, "a", "b").distinct()
