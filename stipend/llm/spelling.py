"""Spelling variants of words, found through a reduced alphabet and verified on the words."""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stipend.shared import stage

#: Symbols that letters are hashed to.
SYMBOLS = 8

MIN_LENGTH = 5
MIN_COUNT = 3

#: A form is at least so many times as frequent as its variant.
FORM_TIMES = 2

#: Pairs of words that two neighbouring reduced words may stand for before their words are compared
#: through the whole alphabet.
CROWDED = 4096

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}

# Characters of a text that are searched at once, and words a task holds before it sends them on.
_PIECE = 1 << 20
_HELD = 200_000

# Rows that a task makes at once.
_ROWS = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = 0xD6E8FEB86659FD93
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# All letters that words may have, and their numbers, from 1, when no two share one.
_LETTERS = [*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("À"), ord("ÿ") + 1)]
_WHOLE = np.zeros(256, np.uint64)
_WHOLE[_LETTERS] = np.arange(1, len(_LETTERS) + 1)


def word_counts(
    docs: DataFrame, typo_every: int | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """How often each `word` occurs in all texts, as `n`.

    Words are runs of Latin letters, of which only A-Z are lower-cased; null texts have none. With
    `typo_every`, words lose a letter now and then: let h be the CRC-32 of `<id>:<word>` (a null id
    is empty); if `typo_every` divides h, the letter h modulo the length goes. Long texts are
    searched in pieces, and tasks combine their counts before the shuffle.
    """
    rows = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
        F.col(f"`{text_col}`").alias("text"),
    ).where(F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["text"]):
                start = zlib.crc32(f"{doc_id.as_py()}:".encode())
                for word, n in _runs(text.as_py()).items():
                    word = word.lower() if word.isascii() else word.translate(_LOWER)
                    if typo_every:
                        h = zlib.crc32(word.encode(), start)
                        if h % typo_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    held[word] += n
                if len(held) >= _HELD:
                    yield _counted(held)
                    held.clear()
        yield _counted(held)

    return rows.mapInArrow(run, "word string, n bigint").where("word <> ''").groupBy("word").agg(
        F.sum("n").alias("n"))


def _runs(text: str) -> Counter:
    counts: Counter = Counter()
    first = 0
    while first < len(text):
        end = min(first + _PIECE, len(text))
        while end < len(text) and _RUN.match(text, end):
            end = _RUN.match(text, end).end()
        counts.update(_RUN.findall(text, first, end))
        first = end
    return counts


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])


def reduction(symbols: int) -> np.ndarray:
    """Symbol, from 1, of every letter code: neighbouring letters get different ones."""
    return np.arange(256, dtype=np.uint64) * np.uint64(5) % np.uint64(symbols) + np.uint64(1)


def spelling_forms(
    counts: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
    symbols: int = SYMBOLS, crowded: int = CROWDED,
) -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near` and `form_n` of every word of `counts` (`word`, `n`) that
    is long and frequent enough.

    Words are near if they differ by one letter inserted, deleted or replaced. The form is the near
    word of largest `n` (ties: the first by code points) if it is FORM_TIMES as frequent, else null;
    `root` is reached from form to form. As counts at least double on the way, it has few steps,
    which are taken in doubling strides. No words give no rows; words hold Latin letters only.
    """
    vocabulary = counts.where((F.char_length("word") >= min_length) & (F.col("n") >= min_count))
    vocabulary = stage(_keyed(vocabulary, reduction(symbols)), "vocabulary")
    near = near_words(vocabulary, symbols, crowded)
    both = near.unionByName(near.select(
        F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    best = both.groupBy("a").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("minus"), F.col("b"))).alias("best"))
    enough = -F.col("best.minus") >= FORM_TIMES * F.col("n")
    formed = stage(vocabulary.join(best, F.col("word") == F.col("a"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, F.col("best.b")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n"),
    ), "formed")
    roots = _roots(formed.where("form is not null").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def near_words(vocabulary: DataFrame, symbols: int, crowded: int = CROWDED) -> DataFrame:
    """Every pair of near words once, as `a`, `n_a`, `b`, `n_b`; `vocabulary` comes from `_keyed`.

    Near words have reduced words that are equal or one edit apart. Each distinct reduced word meets
    the vocabulary of reduced words through its one-edit neighbourhood; as the neighbours of two
    words mirror each other, only those that are shorter or have a greater symbol in a place are
    made. The words behind two neighbours are compared in full. Where these would be more than
    `crowded` pairs, their words are met again through neighbourhoods in the whole alphabet, where
    each key is one word: so no group is compared pair by pair, and no pair is lost.
    """
    reduced = stage(vocabulary.groupBy("reduced").agg(
        F.count("*").alias("size"), F.min("word").alias("word")), "reduced")
    made = _neighbours(reduced.select(F.col("reduced").alias("x"), "size", "word"), reduction(symbols), symbols)
    met = made.join(reduced.select(F.col("reduced").alias("key"), F.col("size").alias("size_y")), "key").select(
        "x", F.col("key").alias("y"), (F.col("size") * F.col("size_y")).alias("pairs"))
    same = reduced.where("size > 1").select(
        F.col("reduced").alias("x"), F.col("reduced").alias("y"), (F.col("size") * F.col("size")).alias("pairs"))
    met = stage(met.unionByName(same), "met")
    first = vocabulary.select(F.col("reduced").alias("x"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    second = vocabulary.select(F.col("reduced").alias("y"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    one_edit = F.levenshtein("a", "b", 1) == 1
    near = met.where(F.col("pairs") <= crowded).join(first, "x").join(second, "y").where(
        ((F.col("x") != F.col("y")) | (F.col("a") < F.col("b"))) & one_edit).select("a", "n_a", "b", "n_b")
    dense = met.where(F.col("pairs") > crowded).select(F.explode(F.array("x", "y")).alias("reduced")).distinct()
    words = stage(vocabulary.join(dense, "reduced", "left_semi"), "crowded")
    if words.isEmpty():
        return stage(near, "near")
    made = _neighbours(words.select(F.col("whole").alias("x"), F.lit(1).cast("bigint").alias("size"), "word"),
                       _WHOLE, len(_LETTERS))
    first = words.select(F.col("whole").alias("x"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    second = words.select(F.col("whole").alias("key"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    dense_near = made.join(second, "key").join(first, "x").where(one_edit).select("a", "n_a", "b", "n_b")
    # A pair may be found from both alphabets, then perhaps the other way round.
    ordered = [F.least("a", "b").alias("a"), F.when(F.col("a") < F.col("b"), F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
               F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.col("n_b")).otherwise(F.col("n_a")).alias("n_b")]
    return stage(near.unionByName(dense_near).select(*ordered).distinct(), "near")


def _roots(forms: DataFrame) -> DataFrame:
    """`word` and the `root` its forms lead to, from `word` and its first form as `root`."""
    forms = stage(forms, "forms")
    while True:
        onward = forms.select(F.col("word").alias("root"), F.col("root").alias("further"))
        forms = stage(forms.select("word", "root").join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if forms.where("moved").isEmpty():
            return forms.select("word", "root")


def _keyed(words: DataFrame, table: np.ndarray) -> DataFrame:
    """`word` and `n` with the hashes of the word's symbols, `reduced`, and of its letters, `whole`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            for rows, letters in _by_length(batch["word"]):
                for key, numbers in zip(keys, (table, _WHOLE)):
                    digits = numbers[letters]
                    key[rows] = _key((digits * _powers(digits.shape[1])).sum(axis=1), digits.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch["word"], batch["n"], *map(pa.array, keys)], ["word", "n", "reduced", "whole"])

    return words.select("word", "n").mapInArrow(run, "word string, n bigint, reduced bigint, whole bigint")


def _neighbours(words: DataFrame, table: np.ndarray, symbols: int) -> DataFrame:
    """`key`, `x`, `size`: the keys of the words one edit from the symbols of `word`, of which the
    shorter ones and those with a greater symbol in one place.

    Keys are sums over the places, so that a neighbour's comes from the word's own and long words
    need no copies of themselves.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, size = batch["x"].to_numpy(), batch["size"].to_numpy()
            for rows, letters in _by_length(batch["word"]):
                for made, key in neighbour_keys(table[letters], symbols):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(x[rows][made]), pa.array(size[rows][made])], ["key", "x", "size"])

    return words.mapInArrow(run, "key bigint, x bigint, size bigint")


def neighbour_keys(digits: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and keys of the neighbours of words of one length, a matrix of their symbols."""
    length = digits.shape[1]
    powers = _powers(length)
    parts = digits * powers
    whole = parts.sum(axis=1)
    before = np.cumsum(parts, axis=1) - parts
    shorter = before + (whole[:, None] - before - parts) * _UNBASE
    # Of equal symbols in a row only the first goes: the others leave the same word.
    apart = np.ones(digits.shape, bool)
    apart[:, 1:] = digits[:, 1:] != digits[:, :-1]
    row, place = np.nonzero(apart)
    yield row, _key(shorter[row, place], length - 1)
    for more in np.arange(1, symbols, dtype=np.uint64):
        row, place = np.nonzero(digits + more <= symbols)
        yield row, _key(whole[row] + more * powers[place], length)


def _powers(length: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(min(length, 1), np.uint64), np.full(max(length - 1, 0), _BASE)]))


def _key(sums: np.ndarray, length: int) -> np.ndarray:
    mixed = sums + np.uint64(length * _MIX & 0xFFFFFFFFFFFFFFFF)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(_MIX)
    return (mixed ^ (mixed >> np.uint64(29))).view(np.int64)


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and letter codes of words of the same length, a bounded number at once."""
    coded = [w.as_py().encode("latin-1") for w in words]
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    for length in np.unique(lengths):
        same = np.nonzero(lengths == length)[0]
        step = max(1, _ROWS // max(1, int(length)))
        for first in range(0, len(same), step):
            rows = same[first : first + step]
            letters = np.frombuffer(b"".join(coded[n] for n in rows), np.uint8)
            yield rows, letters.reshape(len(rows), length)
