"""Ranked lexical search: one automaton of all item terms counts them directly in the texts."""

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stipend.shared import stage

#: Bytes of the item texts whose terms share an automaton; one longer text has one of its own.
BLOCK_BYTES = 1 << 20

#: Parts of a block that item texts are dealt to before parts are joined to blocks.
_PARTS = 64

#: Tasks whose best rows are compared together before those of all tasks are.
_TASKS_AT_ONCE = 256

#: Bytes of a text that are searched at once, and rows that a task holds before it drops the lesser.
_PIECE = 1 << 20
_HELD = 1 << 19

# Every ASCII character outside a term becomes the guard, A-Z become lower case; all bytes of other
# characters belong to terms.
_GUARD = 0x20
_FOLD = bytes(
    b + 32 if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    else b if b > 127 or chr(b).isalnum() else _GUARD
    for b in range(256)
)
_ALL_DOCS, _ALL_TERMS = -1, -2


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, with repeats: runs of letters, digits and non-ASCII characters."""
    return text.translate(_FOLD).split()


def automaton(terms: list[bytes]) -> ahocorasick.Automaton:
    """Finds `terms` between guards, so only as whole terms; neighbours share a guard. A match gives
    the term's position in the list."""
    guarded = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        guarded.add_word(f" {term.decode('latin-1')} ", number)
    guarded.make_automaton()
    return guarded


def count_terms(found: ahocorasick.Automaton, folded: bytes) -> Counter:
    """How often each term of the automaton occurs in a folded text, searched in pieces that end at a
    guard, so that memory does not grow with the text."""
    counts: Counter = Counter()
    first = 0
    while first < len(folded):
        end = folded.find(b" ", first + _PIECE)
        end = len(folded) if end < 0 else end
        counts.update(map(itemgetter(1), found.iter(f" {folded[first:end].decode('latin-1')} ")))
        first = end + 1
    return counts


def weight(docs: int, holding: int) -> int:
    """Weight of a term that `holding` of `docs` documents hold."""
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The `k` documents of highest score for every row of `items`: `item_col`, `rank` from 1,
    `id_col` and `score`.

    Scores count whole terms of whole texts by the formula of `weight` and `_Scorer`; documents of
    score 0 are left out, equal scores go by ascending id, null ids last. Ids are integers. Null,
    empty and blank texts have no terms; repeated documents are ranked one by one; repeated item
    rows each get their ranking; items without terms, an empty table of items or of documents give
    no rows. Other columns are not read.

    Nothing is indexed: the texts are scanned twice per block of items, once for the number of
    documents that hold each term, once for the scores. A document's scores are whole inside its
    task, which keeps `k` rows per item, so only these are shuffled. What is broadcast, an
    automaton and its map to the items, is bounded by `block_bytes` of item texts, or by the longest
    one. Counts that come to the driver are bounded alike, one number per term of a block.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    asked = items.select(
        F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").alias("text"))
    # Equal texts are searched once.
    texts = stage(
        asked.where(F.octet_length("text") > 0).select("text").distinct()
        .select("text", F.monotonically_increasing_id().alias("text_no")), "texts")
    found = None
    for part in _blocks(texts, block_bytes):
        block = [(r.text_no, Counter(terms_of(r.text.encode()))) for r in texts.where(part).collect()]
        best = _search_block(spark, rows, block, k)
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = spark.createDataFrame([], "text_no bigint, id bigint, score bigint, rank int")
    named = asked.join(texts, "text").select("item", "text_no")
    return found.join(named, "text_no").select(
        F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _blocks(texts: DataFrame, block_bytes: int) -> list[Column]:
    """Conditions that cut `texts` into blocks of at most `block_bytes`, or of one crowded part.

    Only sums of parts come to the driver, _PARTS of them per block.
    """
    size = F.octet_length("text").cast("bigint")
    total = texts.agg(F.sum(size)).first()[0]
    if total is None:
        return []
    part = F.pmod(F.xxhash64("text_no"), F.lit(_PARTS * -(-total // block_bytes)))
    sizes = sorted(texts.groupBy(part.alias("part")).agg(F.sum(size).alias("size")).collect())
    blocks, room = [], 0
    for number, bytes_ in sizes:
        if bytes_ > room:
            blocks.append([number, number])
            room = block_bytes
        blocks[-1][1] = number
        room -= bytes_
    return [part.between(first, last) for first, last in blocks]


def _search_block(spark, rows: DataFrame, block: list[tuple[int, Counter]], k: int) -> DataFrame:
    terms = sorted(set().union(*[counts for _, counts in block]))
    number = {term: n for n, term in enumerate(terms)}
    found = spark.sparkContext.broadcast(automaton(terms) if terms else None)

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = np.zeros(len(terms), np.int64)
        with_terms = all_terms = 0
        for _, text in _texts(batches):
            folded = text.translate(_FOLD)
            n = len(folded.split())
            all_terms += n
            with_terms += n > 0
            if n and found.value:
                docs[list(count_terms(found.value, folded))] += 1
        held = np.nonzero(docs)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([_ALL_DOCS, _ALL_TERMS, *held.tolist()], pa.int32()),
             pa.array([with_terms, all_terms, *docs[held].tolist()], pa.int64())], ["term", "docs"])

    counted = rows.mapInArrow(holding, "term int, docs bigint").groupBy("term").agg(F.sum("docs"))
    docs_with = dict(counted.collect())
    all_docs, all_terms = docs_with.get(_ALL_DOCS, 0), docs_with.get(_ALL_TERMS, 0)
    outputs = sorted(
        (number[term], item, times * weight(all_docs, docs_with[number[term]]))
        for item, (_, counts) in enumerate(block) for term, times in counts.items()
        if number[term] in docs_with
    )
    scorer = spark.sparkContext.broadcast(
        _Scorer(outputs, len(terms), [n for n, _ in block], all_docs, all_terms, k))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _Best(scorer.value)
        for doc_id, text in _texts(batches):
            folded = text.translate(_FOLD)
            if found.value:
                kept.offer(doc_id, len(folded.split()), count_terms(found.value, folded))
        yield kept.rows()

    scored = rows.mapInArrow(best, "text_no bigint, id bigint, score bigint")
    some = F.floor(F.spark_partition_id() / _TASKS_AT_ONCE)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    for group in (["text_no", "some"], ["text_no"]):
        if "some" in group:
            scored = scored.withColumn("some", some)
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        scored = scored.withColumn("rank", rank).where(F.col("rank") <= k)
    return scored.select("text_no", "id", "score", "rank")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
    for batch in batches:
        for doc_id, text in zip(batch["id"], batch["text"]):
            if text.is_valid:
                yield doc_id.as_py(), text.as_py()


class _Scorer:
    """Which items a term counts for, with its weight times its repeats in the item: the slice
    `starts[term]` to `starts[term + 1]` of `items` and `weights`."""

    def __init__(self, outputs, terms: int, text_nos: list[int], docs: int, total: int, k: int):
        of_term, items, weights = (np.array(column, np.int64) for column in zip(*outputs)) if outputs else (
            np.zeros(0, np.int64),) * 3
        self.starts = np.searchsorted(of_term, np.arange(terms + 1))
        self.items, self.weights = items, weights
        self.text_nos = np.array(text_nos, np.int64)
        self.docs, self.total, self.k = docs, total, k

    def scores(self, n_terms: int, counts: Counter) -> np.ndarray:
        """The score of a document of `n_terms` terms for every item, in 64-bit integers."""
        out = np.zeros(len(self.text_nos), np.int64)
        terms = np.fromiter(counts, np.int64, len(counts))
        tf = np.fromiter(counts.values(), np.int64, len(counts))
        length = 100 - 25 + (25 * n_terms * self.docs) // self.total
        part = (1_000_000_000 * tf) // (1000 * tf + 12 * length)
        first, size = self.starts[terms], self.starts[terms + 1] - self.starts[terms]
        at = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
        np.add.at(out, self.items[at], self.weights[at] * np.repeat(part, size))
        return out


class _Best:
    """The k best rows of every item among the documents of a task."""

    def __init__(self, scorer: _Scorer):
        self.scorer = scorer
        self.least = np.ones(len(scorer.text_nos), np.int64)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def offer(self, doc_id: int | None, n_terms: int, counts: Counter) -> None:
        if not counts:
            return
        scores = self.scorer.scores(n_terms, counts)
        items = np.nonzero(scores >= self.least)[0]
        self.held.append((items, scores[items], np.full(len(items), doc_id or 0, np.int64),
                          np.full(len(items), doc_id is None)))
        self.size += len(items)
        if self.size > max(_HELD, 2 * self.scorer.k * len(self.least)):
            self._drop()

    def _drop(self) -> None:
        """Keep k rows per item, and ask as much of later ones as the last of them scores."""
        if not self.held:
            return
        columns = [np.concatenate(column) for column in zip(*self.held)]
        items, scores, ids, nulls = columns
        order = np.lexsort((ids, nulls, -scores, items))
        sorted_items = items[order]
        place = np.arange(len(order)) - np.searchsorted(sorted_items, sorted_items)
        kept = order[place < self.scorer.k]
        last = order[place == self.scorer.k - 1]
        self.least[items[last]] = scores[last]
        self.held = [tuple(column[kept] for column in columns)]
        self.size = len(kept)

    def rows(self) -> pa.RecordBatch:
        self._drop()
        none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, bool),)
        items, scores, ids, nulls = self.held[0] if self.held else none
        return pa.RecordBatch.from_arrays(
            [pa.array(self.scorer.text_nos[items]), pa.array(ids, mask=nulls), pa.array(scores)],
            ["text_no", "id", "score"])
