"""Exact top-k inner products by a bit-sliced index."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stipend.shared import stage

SCALE = 1024

#: Vectors of a block: the bitmaps of an index block have so many bits.
BLOCK_ROWS = 4096

#: Queries that meet an index block together.
QUERY_ROWS = 256

#: Queries of a part, which a task holds with their best so far: as many at most, and fewer parts than
#: one per LEAST_QUERIES, as each part builds the index blocks anew.
PART_QUERIES, LEAST_QUERIES = 4096, 32

#: Index blocks of a file, so that tasks can share out the index by files.
FILE_BLOCKS = 8

#: Lowest bits of each component that the slices leave out; the boundary is resolved exactly.
DROPPED_BITS = 2

#: Largest absolute component after scaling; greater ones, of 2^52 and more before, count as this.
LIMIT = 1 << 62


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """`vec_id` and `v`, floor(SCALE · x) of each component. Vectors that are null or empty, or hold
    a null or non-finite component, are left out; a component beyond LIMIT counts as LIMIT."""
    x = F.transform(F.col("v"), lambda c: c.cast("double"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).withColumn("v", x)
    top = F.lit(float(LIMIT))
    scaled = F.transform("v", lambda c: F.floor(F.least(F.greatest(c * SCALE, -top), top)))
    return rows.where((F.size("v") > 0) & finite).withColumn("v", scaled)


def _blocks(rows: DataFrame, size: int, sliced: bool) -> DataFrame:
    """Blocks of vectors of one length, built where the rows are; `slices` if `sliced`."""
    fields = "dim int, ids binary, data binary" + ", slices binary, low binary, width int" * sliced

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def block(dim: int, ids: np.ndarray, data: np.ndarray):
            return (dim, ids.tobytes(), packed(data), *(slice_block(data) if sliced else ()))

        def batch_of(made: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in made], schema)

        names = [f.split()[0] for f in fields.split(", ")]
        kinds = {"int": pa.int32(), "binary": pa.binary()}
        schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in fields.split(", ")])
        for batch in batches:
            ids, ends = batch["vec_id"].to_numpy(), batch["v"].offsets.to_numpy()
            values, lengths = batch["v"].values.to_numpy(), np.diff(ends)
            for dim in np.unique(lengths):
                rows_ = np.nonzero(lengths == dim)[0]
                data = values[ends[rows_][:, None] + np.arange(dim)]
                held = waiting.pop(int(dim), [])
                ids_ = np.concatenate([*[h[0] for h in held], ids[rows_]])
                data = np.concatenate([*[h[1] for h in held], data])
                full = len(ids_) // size * size
                for n in range(0, full, size):
                    yield batch_of([block(int(dim), ids_[n : n + size], data[n : n + size])])
                if len(ids_) > full:
                    waiting[int(dim)] = [(ids_[full:], data[full:])]
        for dim, [(ids_, data)] in waiting.items():
            yield batch_of([block(dim, ids_, data)])

    return rows.select("vec_id", "v").mapInArrow(run, fields)


def packed(data: np.ndarray) -> bytes:
    """Components in 32 bits each, if they all fit, else in 64."""
    narrow = data.astype(np.int32)
    return (narrow if (narrow == data).all() else data.astype(np.int64)).tobytes()


def unpacked(data: bytes, rows: int, dim: int) -> np.ndarray:
    kind = np.int32 if len(data) == 4 * rows * dim else np.int64
    return np.frombuffer(data, kind).reshape(rows, dim).astype(np.int64)


def products(data: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products; where 64 bits may not hold them, by whole numbers of any size, and those that
    do not fit then count as the largest or least that does."""
    most = max(int(data.max()), -int(data.min())) if data.size else 0
    if most * sum(map(abs, query.tolist())) < 1 << 63:
        return data @ query
    exact = data.astype(object) @ query.astype(object)
    return np.array([max(-(1 << 63), min((1 << 63) - 1, x)) for x in exact], np.int64)


def slice_block(data: np.ndarray) -> tuple[bytes, bytes, int]:
    """Bitmaps of the components without their lowest bits, above the least of each dimension:
    the slices of each dimension in turn, the least values, and the number of slices."""
    coarse = data.astype(np.int64) >> DROPPED_BITS
    low = coarse.min(axis=0)
    above = coarse - low
    width = max(1, int(above.max()).bit_length())
    shifts = np.arange(width)[:, None]
    maps = [np.packbits(((x >> shifts) & 1).astype(np.uint8), axis=1, bitorder="little") for x in above.T]
    return b"".join(m.tobytes() for m in maps), low.tobytes(), width


class Index:
    """The bitmaps of one block as integers: bit n belongs to row n."""

    def __init__(self, ids: bytes, data: bytes, slices: bytes, low: bytes, width: int, dim: int):
        self.ids = np.frombuffer(ids, np.int64)
        self.data = unpacked(data, len(self.ids), dim)
        self.low = np.frombuffer(low, np.int64)
        self.rows = len(self.ids)
        self.every = (1 << self.rows) - 1
        size = (self.rows + 7) // 8
        maps = [int.from_bytes(slices[n : n + size], "little") for n in range(0, len(slices), size)]
        self.slices = [maps[n : n + width] for n in range(0, len(maps), width)]

    def coarse_sum(self, query: np.ndarray) -> list[int]:
        """Slices, lowest first, of the weighted sum of the dimensions, apart from a constant.

        Each set bit of a weight adds the slices of its dimension, shifted; negative weights add the
        complement. Three bitmaps of one value become a sum and a carry until one is left.
        """
        columns: list[list[int]] = [[]]
        for weight, slices in zip(query.tolist(), self.slices):
            if weight < 0:
                slices = [self.every ^ x for x in slices]
            weight, shift = abs(weight), 0
            while weight:
                if weight & 1:
                    while len(columns) < shift + len(slices):
                        columns.append([])
                    for n, bitmap in enumerate(slices):
                        columns[shift + n].append(bitmap)
                weight >>= 1
                shift += 1
        result, n = [], 0
        while n < len(columns):
            column = columns[n]
            if n + 1 == len(columns) and len(column) > 1:
                columns.append([])
            while len(column) > 2:
                a, b, c = column.pop(), column.pop(), column.pop()
                one = a ^ b
                column.append(one ^ c)
                columns[n + 1].append((a & b) | (one & c))
            if len(column) == 2:
                a, b = column
                column[:] = [a ^ b]
                columns[n + 1].append(a & b)
            result.append(column[0] if column else 0)
            n += 1
        return result

    def candidates(self, query: np.ndarray, k: int) -> np.ndarray:
        """Rows that may be among the k best.

        The sum's slices are followed from the most significant down, which gives the k-th largest
        coarse score; what the dropped bits can add or take at most then bounds the boundary.
        """
        slices = self.coarse_sum(query)
        if self.rows <= k:
            return np.arange(self.rows)
        better, equal, least = 0, self.every, 0
        for n in range(len(slices) - 1, -1, -1):
            found = better | (equal & slices[n])
            if found.bit_count() >= k:
                equal &= slices[n]
                least |= 1 << n
            else:
                better = found
                equal &= ~slices[n]
        # A score is (coarse << DROPPED_BITS) + rest, and rests differ by at most this much.
        slack = sum(map(abs, query.tolist())) * ((1 << DROPPED_BITS) - 1)
        bound = least - -(-slack >> DROPPED_BITS)
        return np.nonzero(self._at_least(slices, max(0, bound)))[0]

    def _at_least(self, slices: list[int], bound: int) -> np.ndarray:
        above, equal = 0, self.every
        for n in range(len(slices) - 1, -1, -1):
            if bound >> n & 1:
                equal &= slices[n]
            else:
                above |= equal & slices[n]
                equal &= ~slices[n]
        bits = (above | equal).to_bytes((self.rows + 7) // 8, "little")
        return np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")[: self.rows]

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best rows other than the query's own."""
        rows = self.candidates(query, k + int((self.ids == query_id).sum()))
        rows = rows[self.ids[rows] != query_id]
        scores = products(self.data[rows], query)
        best = np.lexsort((self.ids[rows], ~scores))[:k]
        return self.ids[rows][best], scores[best]


def merged(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray], k: int):
    """The k best of two sets of ids and scores."""
    ids, scores = (np.concatenate(side) for side in zip(one, other))
    best = np.lexsort((ids, ~scores))[:k]
    return ids[best], scores[best]


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """The k best inner products of each query with the `vectors` that have another id, as
    `query_id`, `rank`, `vec_id`, `score`; ties to the smaller id.

    Components count as floor(SCALE · x); only vectors of the query's length take part. Both sides
    may be of any size: vectors become index blocks where they lie, queries become blocks in parts,
    and every task reads one share of the index and one part of the queries from written tables, about
    as many tasks as there are shuffle partitions. So neither side is copied into a shuffle or sent
    through the driver, whatever the planner thinks of their size. A task keeps the k best rows per
    query, and the best of these are ranked per query row. Repeated vectors count each, and repeated
    query rows get a ranking each; an empty side gives no rows. Scores that 64 bits do not hold count
    as the largest or least number that fits.
    """
    spark = vectors.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = _blocks(quantised(vectors, id_col, vec_col), BLOCK_ROWS, True)
    index = stage(index.withColumn("block", F.monotonically_increasing_id()), "index", FILE_BLOCKS)
    # Written first: all tasks scan for queries, and few build full blocks of them.
    asked = stage(quantised(queries, id_col, vec_col), "queries")
    count = asked.count()
    parts = max(1, min(math.isqrt(tasks), count // LEAST_QUERIES), -(-count // PART_QUERIES))
    asked = _blocks(asked.repartition(parts), QUERY_ROWS, False)
    asked = asked.select(F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"),
                         F.monotonically_increasing_id().alias("q_block"), F.spark_partition_id().alias("part"))
    asked = stage(asked, "asked").repartitionById(parts, "part")
    # The hint asks for a product of partitions; each index block meets all queries of the part in turn.
    index = index.coalesce(-(-tasks // parts))
    pairs = index.join(asked.hint("shuffle_replicate_nl"), F.col("dim") == F.col("q_dim"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, best = None, {}
        for batch in batches:
            for n in range(batch.num_rows):
                number, dim, q_block, q_ids, q_data = (
                    batch[name][n].as_py() for name in ("block", "dim", "q_block", "q_ids", "q_data"))
                if number != last:
                    fields = (batch[name][n].as_py() for name in ("ids", "data", "slices", "low", "width"))
                    last, block = number, Index(*fields, dim)
                ids = np.frombuffer(q_ids, np.int64)
                data = unpacked(q_data, len(ids), dim)
                found = [block.search(q, x, k) for q, x in zip(ids, data)]
                if q_block in best:
                    found = [merged(x, y, k) for x, y in zip(best[q_block][1], found)]
                best[q_block] = ids, found
        for q_block, (ids, found) in best.items():
            sizes = [len(x) for x, _ in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(sum(sizes), q_block, np.int64)),
                 pa.array(np.repeat(np.arange(len(ids), dtype=np.int32), sizes)), pa.array(np.repeat(ids, sizes)),
                 *[pa.array(np.concatenate(side)) for side in zip(*found)]],
                ["q_block", "place", "query_id", "vec_id", "score"])

    best = pairs.mapInArrow(run, "q_block bigint, place int, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("q_block", "place").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
