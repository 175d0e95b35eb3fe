"""Pack tokenised documents into sequences by patterns from non-negative least squares."""

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stipend.shared import stage

SEQUENCE = 1024
END_ID = 2

#: Documents of a pattern at most.
PATTERN_DOCS = 3

_ITERATIONS = 600

#: Texts between two spaces whose ids a worker remembers at most.
_REMEMBERED = 400_000

#: The one special token of the vocabulary, which a text may spell out.
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256


class _Ids(dict):
    """Ids, as little-endian unsigned 32-bit bytes, of a text after a space.

    The vocabulary's pattern begins a new piece at every space before a character that is no white
    space, so a text may be cut there and the ids of its parts joined.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, part: str) -> bytes:
        ids = array("I", self.encode(" " + part)).tobytes()
        if len(self) >= _REMEMBERED:
            self.clear()
        if len(part) < 64:
            self[part] = ids
        return ids


@lru_cache(maxsize=1)
def tokenizer(path: str):
    """Function from a text to the bytes of its ids; `path` is a rank file of the vocabulary."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    encoding = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    known = _Ids(encoding.encode_ordinary)
    special = array("I", [SPECIAL_ID]).tobytes()

    def plain(text: str) -> bytes:
        head, *parts = text.split(" ")
        if "" in parts or not all(map(str.isprintable, parts)) and any(
            p[:1].isspace() for p in parts
        ):
            # Runs of white space: a part begins only at the last space of a run.
            joined, whole = [], head
            for part in parts:
                if part and not part[0].isspace():
                    joined.append(whole)
                    whole = part
                else:
                    whole += " " + part
            head, *parts = [*joined, whole]
        ids = array("I", encoding.encode_ordinary(head)).tobytes()
        return ids + b"".join(map(known.__getitem__, parts))

    def encode(text: str) -> bytes:
        if SPECIAL not in text:
            return plain(text)
        return special.join(map(plain, text.split(SPECIAL)))

    return encode


def pieces(
    docs: DataFrame, vocabulary: str, size: int = SEQUENCE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Tokenised pieces: `doc_id`, `piece`, `start`, `length`, `ids_crc32`, and the place `task`,
    `nth` of the piece among those of its length in its task.

    A document is its ids and END_ID; null is an empty text. Longer ones than `size` are cut so that
    only the first piece is shorter. Whole texts are tokenised in Arrow batches.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
    end = array("I", [END_ID]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(vocabulary)
        task, seen = TaskContext.get().partitionId(), [0] * (size + 1)
        for batch in batches:
            of, cells = [], []
            for row, text in enumerate(batch["text"]):
                ids = encode(text.as_py() or "") + end
                total = len(ids) // 4
                cut = (total - 1) % size + 1
                start, piece = 0, 0
                while start < total:
                    of.append(row)
                    cells.append((piece, start, cut - start,
                                  zlib.crc32(ids[4 * start : 4 * cut]), task, seen[cut - start]))
                    seen[cut - start] += 1
                    start, cut, piece = cut, cut + size, piece + 1
            columns = np.array(cells, np.int64).reshape(-1, 6).T
            types = [pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(of, pa.int64())),
                 *[pa.array(x).cast(t) for x, t in zip(columns, types)]], names)

    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, "
                                "ids_crc32 bigint, task bigint, nth bigint")


def pattern_counts(histogram: np.ndarray, size: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each is repeated, for a histogram of lengths 0 … `size`.

    All multisets of up to PATTERN_DOCS lengths that fill a sequence exactly are enumerated, and
    their repeat counts fitted to the histogram by non-negative least squares (accelerated projected
    gradient steps). The counts are rounded to what the histogram still holds, largest first, and
    the residual lengths are packed by best fit, longest first, in groups of equal lengths.
    The work depends on `size` alone, not on the number of documents.
    """
    left = histogram.astype(np.int64).copy()
    whole, left[size] = int(left[size]), 0
    result = [((size,), whole)] if whole else []
    short = np.arange(1, size // 2 + 1)
    patterns = [np.stack([short, size - short, np.zeros_like(short)], 1)]
    if PATTERN_DOCS > 2:
        a, b = np.meshgrid(np.arange(1, size // 3 + 1), short, indexing="ij")
        c = size - a - b
        fits = (a <= b) & (b <= c)
        patterns.append(np.stack([a[fits], b[fits], c[fits]], 1))
    lengths = np.concatenate(patterns)
    lengths = lengths[((left[lengths] > 0) | (lengths == 0)).all(axis=1)]
    if len(lengths):
        counts = _least_squares(lengths, left, size)
        for n in np.argsort(-counts, kind="stable"):
            pattern = [int(x) for x in lengths[n] if x]
            uses = {x: pattern.count(x) for x in pattern}
            times = min(round(float(counts[n])), *(int(left[x]) // k for x, k in uses.items()))
            if times > 0:
                for x, k in uses.items():
                    left[x] -= times * k
                result.append((tuple(pattern), times))
    return result + _best_fit(left, size)


def _least_squares(lengths: np.ndarray, histogram: np.ndarray, size: int) -> np.ndarray:
    """Non-negative x that brings the sums of x over the patterns near to the histogram."""
    goal = histogram.astype(float)
    flat = lengths.ravel()

    def apply(x: np.ndarray) -> np.ndarray:
        made = np.bincount(flat, np.repeat(x, lengths.shape[1]), size + 1)
        made[0] = 0
        return made

    def back(r: np.ndarray) -> np.ndarray:
        r[0] = 0
        return r[lengths].sum(axis=1)

    v = np.ones(len(lengths))
    for _ in range(20):  # largest eigenvalue by power steps
        v = back(apply(v))
        v /= np.linalg.norm(v) or 1
    rate = 1 / (1.05 * (np.linalg.norm(back(apply(v))) or 1))
    x = np.zeros(len(lengths))
    ahead, momentum = x, 1.0
    for _ in range(_ITERATIONS):
        nearer = np.maximum(0, ahead - rate * back(apply(ahead) - goal))
        following = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        ahead = nearer + (momentum - 1) / following * (nearer - x)
        x, momentum = nearer, following
    return x


def _best_fit(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit of the lengths, longest first; equal lengths go to equal sequences at once."""
    room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    for length in range(size, 0, -1):
        count = int(left[length])
        while count:
            space = min((s for s, open_ in room.items() if s >= length and open_), default=None)
            if space is None:
                held = min(size // length, count)
                new = {(length,) * held: count // held}
                if count % held:
                    new[(length,) * (count % held)] = 1
                for pattern, times in new.items():
                    at = room[size - sum(pattern)]
                    at[pattern] = at.get(pattern, 0) + times
                break
            pattern, times = room[space].popitem()
            filled = min(times, count)
            if times > filled:
                room[space][pattern] = times - filled
            at, longer = room[space - length], (*pattern, length)
            at[longer] = at.get(longer, 0) + filled
            count -= filled
    return [(pattern, times) for open_ in room.values() for pattern, times in open_.items()]


def slots(patterns: list[tuple[tuple[int, ...], int]], size: int = SEQUENCE) -> tuple[np.ndarray, ...]:
    """Ranges of the n-th piece of a length, ascending: first `length, n` as one number, the
    sequence that first piece goes to, and the offset there."""
    taken = [0] * (size + 1)
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return (table[:, 0] << 48) + table[:, 1], table[:, 2], table[:, 3]


def pack(
    docs: DataFrame, vocabulary: str, size: int = SEQUENCE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """`doc_id`, `piece`, `start`, `length`, `ids_crc32`, `sequence_id` and `offset` of every piece.

    The pieces are written once. Their histogram, at most `size` numbers, is all that reaches the
    driver, which finds the patterns. The n-th piece of a length goes to the n-th slot for that
    length: n is the piece's place in its task plus the pieces of tasks before, which a running sum
    over one row per task and length gives. Equal lengths, a third of all rows or more, thus need no
    sort and no common task. The slots, a few thousand whatever the input, travel with the code.
    An empty table gives no rows; repeated rows and null ids are packed like any other.
    """
    made = stage(pieces(docs, vocabulary, size, id_col, text_col), "pieces")
    per_task = stage(made.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    histogram = np.zeros(size + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    firsts, sequences, offsets = slots(pattern_counts(histogram, size), size)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = per_task.select(
        "length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = made.join(per_task, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("before") + F.col("nth")).alias("nth"))
    fields = placed.drop("nth").schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nth = (batch["length"].to_numpy() << 48) + batch["nth"].to_numpy()
            at = np.searchsorted(firsts, nth, "right") - 1
            sequence = sequences[at] + (nth - firsts[at])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offsets[at])], fields.names)

    return placed.mapInArrow(run, fields)
