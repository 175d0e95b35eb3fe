"""Left joins whose right side holds a large part of its rows under a few keys.

Spark splits a frequent key of a left join on the left side only. Here the frequent keys of the right
side, and only they, are spread over salts, and their left rows copied to each, in one join: what no
copy may decide alone, whether a left row has a match at all, is known before, from the distinct keys
and points of the frequent keys.
"""

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stipend.shared import stage

#: Right rows of one key that one task may hold; keys with more are spread over salts.
HOT_ROWS = 1_000_000

#: Keys that the frequency sketch tracks: it finds all that hold more than about 1 / 7500 of the rows.
TRACKED = 10_000

#: Distinct keys and points of frequent keys that are broadcast at most.
MAX_POINTS = 1_000_000

_N, _SALT, _POINTS, _HIT, _HASH = "__hot_n", "__hot_salt", "__hot_points", "__hot_hit", "__hot_hash"


def condition(
    keys: Mapping[str, Column], inside: tuple[str, Column, Column] | None = None
) -> Column:
    """Equal keys, and the point inside the interval if there is one."""
    equal = reduce(and_, [value == F.col(name) for name, value in keys.items()])
    return equal & F.col(inside[0]).between(*inside[1:]) if inside else equal


def frequent_keys(df: DataFrame, names: list[str], rows: int) -> list[tuple[int, int]]:
    """Hashes of the keys with more than about `rows` rows, and these counts, TRACKED at most, by one
    pass of a frequency sketch. Rows with a null in the key join nothing and are not counted."""
    sketch = F.call_function("approx_top_k", F.xxhash64(*names), F.lit(TRACKED), F.lit(TRACKED))
    found = df.dropna(subset=names).agg(sketch.alias("top")).first()["top"]
    return [(x["item"], x["count"]) for x in found or [] if x["count"] > rows]


def salted_left_join(
    left: DataFrame, right: DataFrame, keys: Mapping[str, Column],
    inside: tuple[str, Column, Column] | None = None, rows: int | None = None,
) -> DataFrame:
    """Left join on `keys`, columns of the right side and the left values they equal, and, if given, on
    `inside`: a column of the right side between two left values.

    Without frequent keys this is a plain left join. Else each frequent key gets a salt for `rows` (HOT_ROWS) of
    its rows, up to the number of shuffle partitions; its right rows are written once, so that a row
    keeps its salt whatever is computed again. A left row of such a key is copied to all salts if it
    has a match, and copies that meet none are left out; without a match it stays one row. The left
    side is computed once. The distinct points of frequent keys are broadcast up to MAX_POINTS, beyond
    which matches and unmatched rows are joined one after the other from the written left side.
    """
    names, rows = list(keys), rows or HOT_ROWS
    on = condition(keys, inside)
    found = frequent_keys(right, names, rows)
    if not found:
        return left.join(right, on, "left")

    spark = left.sparkSession
    most = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salts = spark.createDataFrame(
        [(h, min(most, -(-n // rows))) for h, n in found], f"{_HASH} bigint, {_N} int")
    hashed = F.xxhash64(*names) == F.col(_HASH)
    hot = stage(right.dropna(subset=names).join(F.broadcast(salts), hashed).drop(_HASH), "hot")
    points = stage(hot.select(*names, _N, *([inside[0]] if inside else [])).distinct(), "points")
    if points.count() > MAX_POINTS:
        left = stage(left, "left")
        matched = left.join(right, on)
        unmatched = left.join(points.drop(_N).unionByName(
            right.join(F.broadcast(salts), hashed, "left_anti").select(*points.drop(_N).columns)), on, "left_anti")
        return matched.unionByName(unmatched, allowMissingColumns=True)

    lookup = points.groupBy(*[F.col(n).alias(f"__hot_{n}") for n in names], _N).agg(
        (F.sort_array(F.collect_set(inside[0])) if inside else F.lit(None)).alias(_POINTS))
    same = reduce(and_, [value == F.col(f"__hot_{name}") for name, value in keys.items()])
    has_match = F.exists(_POINTS, lambda p: p.between(*inside[1:])) if inside else F.lit(True)
    copies = F.explode(
        F.when(F.col(_N).isNull(), F.array(F.lit(0)))
        .when(has_match, F.sequence(F.lit(0), F.col(_N) - 1))
        .otherwise(F.array(F.lit(-1))))
    spread = left.join(F.broadcast(lookup), same, "left").select(
        *left.columns, F.col(_N), copies.alias(_SALT))

    cold = right.join(F.broadcast(salts), hashed, "left_anti").withColumn("__hot_at", F.lit(0))
    placed = hot.withColumn("__hot_at", F.pmod(F.monotonically_increasing_id(), F.col(_N)).cast("int")).drop(_N)
    both = cold.unionByName(placed).withColumn(_HIT, F.lit(True))
    joined = spread.join(both, on & (F.col(_SALT) == F.col("__hot_at")), "left")
    kept = F.col(_HIT).isNotNull() | F.col(_N).isNull() | (F.col(_SALT) < 0)
    return joined.where(kept).select(*left.columns, *right.columns)
