"""SimHash near-duplicates, with candidates pruned by pigeonring chains."""

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from stipend.llm.components import components
from stipend.llm.rows import columns_of, packed
from stipend.shared import stage

BITS = 64

#: Buckets of more fingerprints than this go to the search by masks, whose buckets are bounded.
LIGHT_BUCKET = 1024

#: Free bits of a mask at most: so many fingerprints, to the power of two, can share a mask key.
FREE_BITS = 15

_HASHES_AT_ONCE = 1 << 16
_LOW_BITS = np.uint64(0x0101010101010101)
_SHIFTS = np.arange(8, dtype=np.uint64)[:, None]


def fingerprints(
    docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id` and the 64-bit SimHash `fp` of every row.

    Words are separated by ASCII white space, A-Z are lower-cased, a fingerprint bit is 1 if it is
    set in over half of the XXH64 hashes (seed 42) of the word shingles, repeats included. A text
    with fewer words is one shingle; null, empty and blank texts have fingerprint 0. Rows are
    independent: no shuffle, and memory is bounded by an Arrow batch.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter(
                (fingerprint(x.as_py(), shingle) for x in batch["text"]), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(prints.view(np.int64))], ["doc_id", "fp"]
            )

    return rows.mapInArrow(run, f"doc_id {kind}, fp bigint")


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The SimHash of a UTF-8 text, unsigned."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    spans = zip(starts, ends[min(shingle, len(words)) - 1 :])
    hashes = np.fromiter(
        (xxh64_intdigest(joined[start : end - 1], 42) for start, end in spans), np.uint64
    )
    counts = np.zeros((8, 8), np.int64)
    for first in range(0, len(hashes), _HASHES_AT_ONCE):
        # Bit k of each byte, summed for all bytes at once; 255 rows cannot overflow a byte.
        planes = (hashes[None, first : first + _HASHES_AT_ONCE] >> _SHIFTS) & _LOW_BITS
        sums = np.add.reduceat(planes, np.arange(0, planes.shape[1], 255), axis=1)
        counts += sums.view(np.uint8).reshape(8, -1, 8).sum(axis=1, dtype=np.int64)
    set_bits = (2 * counts.T.ravel() > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def near_duplicates(prints: DataFrame, max_distance: int = 3) -> DataFrame:
    """Class of every distinct `fp` of `prints`, as `fp`, `root`, `component_id`.

    Fingerprints with at most `max_distance` (0 to 4) differing bits are linked; `component_id` is
    the smallest doc_id reachable (null ids are passed over), `root` its smallest fingerprint.

    Equal fingerprints are collapsed first. The others are cut into `max_distance` + 1 segments on
    a ring. Two linked fingerprints have a segment from which on the differences summed over 1, 2,
    3, … segments stay below 1, 2, 3, …, so the first segment is equal and so is one of three parts
    of the next two: these bits are the join key. In a bucket the chain is checked on the ring
    before the full distance, and a bucket yields at most one link per member, however many pairs
    are near. Buckets beyond LIGHT_BUCKET are searched again by masks that leave out
    `max_distance` of many short segments: every linked pair agrees on some mask, and no more than
    2^FREE_BITS fingerprints can share a key, so no task is unbounded and no link is lost.
    """
    if not 0 <= max_distance <= 4:
        raise ValueError("max_distance must be between 0 and 4")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("_id")), "fingerprints")
    if max_distance == 0:
        return nodes.select("fp", F.col("fp").alias("root"), F.col("_id").alias("component_id"))
    keys = nodes.select("fp", F.explode(F.array(*_ring_keys(F.col("fp"), max_distance))).alias("key"))
    sizes = stage(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    shared = keys.join(sizes, "key")
    light = shared.where(F.col("n") <= LIGHT_BUCKET).groupBy("key").agg(
        F.collect_list("fp").alias("fps")
    )
    masks = F.array(*[F.lit(m).cast("bigint") for m in _masks(max_distance)])
    heavy = (
        shared.where(F.col("n") > LIGHT_BUCKET).select("fp").distinct()
        .select("fp", F.explode(masks).alias("mask"))
        .groupBy("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits")).agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    )
    links = light.select(F.col("key"), "fps").mapInArrow(
        _linker(max_distance, True), "a bigint, b bigint"
    ).unionByName(heavy.select(F.lit(0).cast("bigint").alias("key"), "fps").mapInArrow(
        _linker(max_distance, False), "a bigint, b bigint"
    ))
    classes = components(links).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    rooted = nodes.join(classes, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("_id").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id")


def simhash_groups(
    docs: DataFrame, shingle: int = 3, max_distance: int = 3,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """`doc_id`, `fingerprint` (16 hex digits) and `component_id` of every row of `docs`.

    Repeated rows each give a row; all texts without words form one class; an empty table gives
    no rows; other columns of `docs` are not read.
    """
    prints = stage(fingerprints(docs, shingle, id_col, text_col), "prints")
    classes = near_duplicates(prints, max_distance)
    return prints.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, shingle: int = 3, max_distance: int = 3,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` that are first in their class: smallest id, nulls last, then row order.

    `docs` must give its rows in the same order whenever it is read, as files do.
    """
    numbered = packed(docs, F.monotonically_increasing_id().alias("number"))
    doc_id = F.col("row").getField(id_col)
    place = numbered.select(
        F.struct(doc_id.isNull().alias("none"), doc_id.alias("id"), F.col("number")).alias("place"),
        F.col("row").getField(text_col).alias("text"),
    )
    prints = stage(fingerprints(place, shingle, "place", "text").select(
        F.col("doc_id").alias("place"), "fp"), "prints")
    classes = near_duplicates(prints.select(F.col("place.id").alias("doc_id"), "fp"), max_distance)
    best = prints.groupBy("fp").agg(F.min("place").alias("place")).join(classes, "fp")
    first = best.groupBy("root").agg(F.min("place").alias("place"))
    kept = stage(first.select(F.col("place.number").alias("number")), "kept")
    return numbered.join(kept, "number", "left_semi").select(*columns_of(docs))


def _widths(segments: int) -> list[int]:
    return [BITS // segments + (n < BITS % segments) for n in range(segments)]


def _chains(max_distance: int) -> list[tuple[int, int, int]]:
    """Per start on the ring: its first bit, and the width of the first and of the next two segments."""
    widths = _widths(max_distance + 1)
    ring = widths * 2
    starts = [0, *accumulate(widths)]
    near = min(2, max_distance)
    return [(starts[n], widths[n], sum(ring[n + 1 : n + 1 + near])) for n in range(len(widths))]


def _ring_keys(fp: Column, max_distance: int) -> list[Column]:
    """Keys of equal bits: a segment and one part of the next two, numbered by start and part."""
    keys = []
    for shift, first, following in _chains(max_distance):
        turned = F.shiftrightunsigned(fp, shift).bitwiseOR(F.shiftleft(fp, BITS - shift)) if shift else fp
        head = turned.bitwiseAND(F.lit((1 << first) - 1))
        parts = min(2, max_distance) + 1
        edges = [following * n // parts for n in range(parts + 1)]
        for low, high in zip(edges, edges[1:]):
            part = F.shiftrightunsigned(turned, first + low).bitwiseAND(F.lit((1 << (high - low)) - 1))
            bits = F.shiftleft(part.cast("bigint"), first).bitwiseOR(head)
            keys.append(F.shiftleft(F.lit(len(keys)).cast("bigint"), 56).bitwiseXOR(bits.cast("bigint")))
    return keys


def _masks(max_distance: int) -> list[int]:
    """Signed 64-bit masks, each without `max_distance` of the short segments."""
    widths = _widths(-(-BITS * max_distance // FREE_BITS))
    starts = [0, *accumulate(widths)]
    segments = [((1 << w) - 1) << s for w, s in zip(widths, starts)]
    full = (1 << BITS) - 1
    masks = [full ^ sum(left) for left in combinations(segments, max_distance)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _linker(max_distance: int, by_chain: bool):
    """mapInArrow function from buckets (`key`, `fps`) to links, one per member at most."""
    chains = _chains(max_distance)
    parts = min(2, max_distance) + 1

    def turn(mask: int, shift: int) -> np.uint64:
        return np.uint64(((mask << shift) | (mask >> (BITS - shift))) & ((1 << BITS) - 1))

    # Differences allowed in one, two and three segments from each start, as masks in place.
    budgets = []
    for n, (shift, first, following) in enumerate(chains):
        second = chains[(n + 1) % len(chains)][1]
        widths = [(first, 0), (first + second, 1)] + [(first + following, 2)] * (max_distance > 1)
        budgets.append([(turn((1 << width) - 1, shift), most) for width, most in widths])

    def near(x: np.ndarray, start: int | None) -> np.ndarray:
        fits = np.ones(x.shape, bool)
        for mask, most in budgets[start] if start is not None else ():
            fits &= np.bitwise_count(x & mask) <= most
        rows = np.nonzero(fits)
        fits[rows] = np.bitwise_count(x[rows]) <= max_distance
        return fits

    def roots(fps: np.ndarray, start: int | None) -> np.ndarray:
        label = np.arange(len(fps))
        step = max(1, (1 << 20) // len(fps))
        while True:
            before = label.copy()
            for first in range(0, len(fps), step):
                linked = near(fps[first : first + step, None] ^ fps[None, :], start)
                least = np.where(linked, label[None, :], len(fps)).min(axis=1)
                label[first : first + step] = np.minimum(label[first : first + step], least)
            while (label[label] != label).any():
                label = label[label]
            if (label == before).all():
                return label

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = batch["fps"].offsets.to_numpy()
            every = batch["fps"].values.to_numpy().view(np.uint64)
            keys = batch["key"].to_numpy().view(np.uint64) >> np.uint64(56)
            left, right = [], []
            for n, (first, end) in enumerate(zip(ends, ends[1:])):
                fps = every[first:end]
                label = roots(fps, int(keys[n]) // parts if by_chain else None)
                linked = np.nonzero(label != np.arange(len(fps)))[0]
                left.append(fps[linked])
                right.append(fps[label[linked]])
            if left:
                ends = [np.concatenate(side).view(np.int64) for side in (left, right)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in ends], ["a", "b"])

    return run
