"""Near-duplicate documents by one-permutation MinHash with optimal densification."""

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from stipend.llm.components import across, components
from stipend.llm.prefixes import rare_pairs, sizes_within
from stipend.llm.sizes import broadcast_up_to
from stipend.shared import own_folder, stage

#: Bands, and minima in a band: 0.99999 of the pairs at a similarity of 0.8 share one.
BANDS = 30
ROWS = 5
BINS = BANDS * ROWS

#: Pairs that agree in fewer minima are not compared: 6 standard deviations below 0.8 of BINS.
MIN_AGREEING = 90

#: Rows of narrow tables (numbers of documents) that may be broadcast: some tens of MB.
BROADCAST_ROWS = 1_000_000


def _probes() -> np.ndarray:
    """Bins that an empty one looks into, in its own random order; all in turn at the end."""
    rng = random.Random(13)
    drawn = [[rng.randrange(BINS) for _ in range(2 * BINS)] for _ in range(BINS)]
    return np.array([row + [(n + k) % BINS for k in range(BINS)] for n, row in enumerate(drawn)])


_PROBES = _probes()
_FEW = 16


def shingles(text: bytes, words: int) -> set[bytes]:
    """The distinct word shingles of a UTF-8 text, A-Z in lower case; of fewer words all as one."""
    found = text.lower().split()
    if len(found) < words:
        return {b" ".join(found)} if found else set()
    return set(map(b" ".join, zip(*[found[n:] for n in range(words)])))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least low half of the sorted `hashes` in each of BINS ranges of their high half.

    An empty range takes the minimum of the first one with any that its own random order comes to
    (optimal densification): that is the same in two sets as often as their similarity says.
    """
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    starts = np.nonzero(np.diff(bins, prepend=np.uint64(BINS)))[0]
    held = bins[starts].astype(np.int64)
    minima = np.zeros(BINS, np.uint32)
    minima[held] = np.minimum.reduceat((hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32), starts)
    filled = np.zeros(BINS, bool)
    filled[held] = True
    empty = np.nonzero(~filled)[0]
    for probes in (_PROBES[:, :_FEW], _PROBES):
        hit = filled[probes[empty]]
        first = hit.argmax(axis=1)
        done = hit[np.arange(len(empty)), first]
        minima[empty[done]] = minima[probes[empty[done], first[done]]]
        empty = empty[~done]
    return minima


def _prints(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: `id`, the size `n` of its shingle set, two halves `k1`, `k2` of the set's digest, the
    signature `minima` and the sorted `hashes`; without words the last four are null."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                yield pa.RecordBatch.from_arrays(
                    [part["id"], *_columns([text.as_py() or b"" for text in part["text"]], words)],
                    ["id", "n", "k1", "k2", "minima", "hashes"])

    return rows.mapInArrow(
        run, f"id {kind}, n bigint, k1 bigint, k2 bigint, minima array<int>, hashes array<bigint>")


def _written(prints: DataFrame) -> DataFrame:
    """`stage` for long lists of hashes: without a dictionary, which finds no repeats in them, and in
    small row groups, which are held in memory until they are whole."""
    path = own_folder(prints.sparkSession, "prints")
    prints.write.options(**{"parquet.enable.dictionary": "false", "parquet.block.size": 1 << 25}).parquet(path)
    return prints.sparkSession.read.schema(prints.schema).parquet(path)


def _columns(texts: list[bytes], words: int) -> list[pa.Array]:
    sizes, digests, minima, hashes = [], [], [], []
    for text in texts:
        found = shingles(text, words)
        sizes.append(len(found))
        if not found:
            digests.append((None, None))
            minima.append(None)
            hashes.append(None)
            continue
        every = np.fromiter((xxh64_intdigest(s, 42) for s in found), np.uint64, len(found))
        every = np.unique(every)
        digests.append(np.frombuffer(xxh3_128_digest(every.tobytes()), np.int64).tolist())
        minima.append(signature(every).view(np.int32))
        hashes.append(every.view(np.int64))
    return [
        pa.array(sizes, pa.int64()), *[pa.array([d[n] for d in digests], pa.int64()) for n in range(2)],
        pa.array(minima, pa.list_(pa.int32())), pa.array(hashes, pa.list_(pa.int64())),
    ]


def near_duplicate_groups(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """`id_col`, `n_shingles`, `component_id` and `kept` of every row of `docs`.

    Two documents are linked if their sets of `words`-word shingles have a Jaccard similarity of
    `percent` or more; `component_id` is the smallest id reachable, `kept` says that it is the row's
    own. Texts without words (null, empty, blank) are linked with nothing; texts of fewer words are
    one shingle. Repeated rows are linked like other copies and each give a row. Null ids are passed
    over: a group of such rows alone has a null component, and they are not kept unless they have no
    words. An empty table gives no rows; other columns are not read. MinHash loses 1 in 100,000 of
    the links at `percent` 80 and fewer of the closer ones; signatures are made for 80 or more.

    Equal sets are one node. In a bucket of equal band only the pairs with its first node are
    compared, so pairs grow with the members and not with their square. Buckets whose nodes are
    then still in several classes are settled by `rare_pairs`, which loses none. Pairs are compared by
    signature, then on the full sets.
    """
    if percent < 80:
        raise ValueError("bands are laid out for similarities of 80 percent and more")
    prints = _written(
        _prints(docs, words, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    nodes = stage(prints.where("n > 0").groupBy("k1", "k2").agg(
        F.min("row").alias("node"), F.min("id").alias("least_id"), F.first("n").alias("n"),
        F.first("minima").alias("minima")), "nodes")
    sets = prints.select(F.col("row").alias("node"), "hashes")
    labels = _classes(nodes.select("node", "n", "minima"), sets, percent)
    rooted = nodes.select("k1", "k2", "node", "least_id").join(labels, "node", "left").withColumn(
        "root", F.coalesce("component", "node"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = stage(rooted.join(least, "root").select("k1", "k2", "component_id"), "named")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return prints.select("id", "n", "k1", "k2").join(named, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.when(F.col("n") > 0, F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
        .otherwise(F.lit(True)).alias("kept"))


def _classes(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Classes of linked nodes as `node`, `component`, without nodes that are their own."""
    bands = F.array(*[
        F.xxhash64(F.lit(band), F.slice("minima", band * ROWS + 1, ROWS)) for band in range(BANDS)])
    members = nodes.select("node", F.explode(bands).alias("key"))
    buckets = members.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("hub"))
    buckets = stage(buckets.where("size > 1"), "buckets")
    shared = stage(members.join(broadcast_up_to(buckets, BROADCAST_ROWS), "key"), "shared")
    stars = shared.where("node <> hub")
    # Most nodes of a group are linked to the first hub of all their buckets; what is then in one
    # class needs no further look.
    nearest = stars.groupBy(F.col("node").alias("a")).agg(F.min("hub").alias("b"))
    links = _links(nearest, nodes, sets, percent)
    others = across(stars.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), components(links))
    links = links.unionByName(_links(others.join(nearest, ["a", "b"], "left_anti"), nodes, sets, percent))
    labels = components(links)
    classed = shared.where("size > 2").join(labels, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("class"))
    split = classed.groupBy("key").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x < y")
    open_nodes = stage(classed.join(split.select("key"), "key", "left_semi").select("node", "class").distinct(), "open")
    if open_nodes.isEmpty():
        return labels
    wanted = sets.join(broadcast_up_to(open_nodes.select("node"), BROADCAST_ROWS), "node", "left_semi")
    more = _links(rare_pairs(open_nodes, wanted, percent), nodes, sets, percent)
    return components(links.unionByName(more))


def _links(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of the pairs `a`, `b`, by their minima and then by their sets."""
    def side(df: DataFrame, end: str) -> DataFrame:
        return df.select(*[F.col(c).alias(end if c == "node" else f"{c}_{end}") for c in df.columns])

    signed = pairs.join(side(nodes, "a"), "a").join(side(nodes, "b"), "b")
    agreeing = F.size(F.filter(F.zip_with("minima_a", "minima_b", lambda x, y: x == y), lambda same: same))
    close = stage(signed.where(
        sizes_within(F.col("n_a"), F.col("n_b"), percent) & (agreeing >= MIN_AGREEING)
    ).select("a", "b", "n_a", "n_b"), "close")
    ids = stage(close.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ids")
    wanted = sets.join(broadcast_up_to(ids, BROADCAST_ROWS), "node", "left_semi")
    common = F.size(F.array_intersect("hashes_a", "hashes_b"))
    return stage(close.join(side(wanted, "a"), "a").join(side(wanted, "b"), "b").where(
        100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)).select("a", "b"), "links")
