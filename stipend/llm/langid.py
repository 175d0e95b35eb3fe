"""Language identification: scripts narrow the candidates, Viterbi labels spans of words."""

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stipend.shared import stage

#: Script blocks as (name, first code point, last code point).
SCRIPTS = [
    ("latin", 0x0041, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
]

#: Name of a document that has no letter.
UNDETERMINED = "und"

#: Letter groups that a model keeps at most, in equal parts for all languages, most frequent first.
MODEL_ROWS = 200_000

#: Log-probability lost by a change of language between two words.
SWITCH_PENALTY = 12.0

#: Most that one word counts against a language.
WORD_LIMIT = 10.0

#: A language is written in the scripts that make up this share of its letters.
SCRIPT_SHARE = 0.02

_GROUP = 3
# Signs such as ½ or Ⅷ are numbers, not letters, though part of words to `re`.
_NO_LETTERS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
_WORD = re.compile(rf"[^\W\d_{_NO_LETTERS}]+")
_ALNUM = re.compile(r"[^\W\d_]+")
_FIRSTS = np.array([first for _, first, _ in SCRIPTS])
_REMEMBERED = 300_000
_CELLS = 2_000_000
_TEXT_AT_ONCE = 8 << 20


def words_of(text: str) -> list[str]:
    """Maximal runs of letters. The class without number signs is slow to match, so it only cuts the
    words that hold such a sign."""
    found = _ALNUM.findall(text)
    if not found or "".join(found).isalpha():
        return found
    return [part for word in found for part in ([word] if word.isalpha() else _WORD.findall(word))]


def _script(word: str) -> str:
    code = ord(word[0])
    n = int(np.searchsorted(_FIRSTS, code, "right")) - 1
    return SCRIPTS[n][0] if n >= 0 and code <= SCRIPTS[n][2] else "other"


@dataclass
class Model:
    """Learned languages, their scripts and the log-probabilities of their letter groups."""

    langs: list[str]
    groups: dict[str, int]
    scores: np.ndarray  # a row per group; row 0, of unknown groups, is zero
    scripts: dict[str, np.ndarray]  # which languages use a script


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from all rows of `docs` that have a text and a language.

    Groups of three letters, with the edges of words, are counted in the tasks and summed. Of each
    language the model keeps the most frequent, all that are as frequent or none, up to its part of
    MODEL_ROWS, so its size is bounded and no language crowds out another; its chances are shares of
    all groups of the language, kept or not.
    """
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: Counter = Counter()
        for batch in batches:
            words: dict[str, Counter] = {}
            for text, lang in zip(batch["text"], batch["lang"]):
                words.setdefault(lang.as_py(), Counter()).update(words_of(text.as_py().lower()))
            for lang, counts in words.items():
                for word, n in counts.items():
                    edged = f" {word} "
                    groups[lang, "script", _script(word)] += n * len(word)
                    for start in range(len(word)):
                        groups[lang, "group", edged[start : start + _GROUP]] += n
        keys = list(groups)
        yield pa.RecordBatch.from_arrays(
            [*[pa.array([k[n] for k in keys], pa.string()) for n in range(3)],
             pa.array([groups[k] for k in keys], pa.int64())], ["lang", "kind", "item", "n"])

    counts = stage(rows.mapInArrow(count, "lang string, kind string, item string, n bigint").groupBy(
        "lang", "kind", "item").agg(F.sum("n").alias("n")), "groups")
    every = counts.where("kind = 'group'")
    # A row per language: their number is that of the labels.
    totals = {r["lang"]: r["n"] for r in every.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    quota = MODEL_ROWS // max(1, len(totals))
    # Groups by how often they occur, a few rows per language, give the least count that is kept.
    down = Window.partitionBy("lang").orderBy(F.col("n").desc())
    least = every.groupBy("lang", "n").agg(F.count("*").alias("groups")).withColumn(
        "so_far", F.sum("groups").over(down)).where(F.col("so_far") <= quota).groupBy("lang").agg(
        F.min("n").alias("least"))
    found = counts.join(F.broadcast(least), "lang", "left").where(
        (F.col("kind") == "script") | (F.col("n") >= F.col("least"))).collect()
    langs = sorted({row["lang"] for row in found})
    at = {lang: n for n, lang in enumerate(langs)}
    groups = {"": 0}
    for row in found:
        if row["kind"] == "group":
            groups.setdefault(row["item"], len(groups))
    seen, letters = np.zeros((len(groups), len(langs))), {}
    for row in found:
        if row["kind"] == "group":
            seen[groups[row["item"]], at[row["lang"]]] += row["n"]
        else:
            letters.setdefault(row["item"], np.zeros(len(langs)))[at[row["lang"]]] += row["n"]
    total = np.array([totals.get(lang, 0) for lang in langs], float)
    scores = np.log((seen + 0.5) / (total + 0.5 * len(groups)))
    scores[0] = 0
    written = sum(letters.values(), np.zeros(len(langs)))
    scripts = {s: n >= SCRIPT_SHARE * np.maximum(written, 1) for s, n in letters.items()}
    return Model(langs, groups, scores.astype(np.float32), scripts)


class _Words(dict):
    """Row of a word in `table`, the scores of the words of one task."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.new = model, []
        self.table = np.zeros((0, len(model.langs)), np.float32)

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n

    def settle(self) -> np.ndarray:
        """The table, with the words that came since."""
        if not self.new:
            return self.table
        model, get = self.model, self.model.groups.get
        ids, starts = [], []
        for word in self.new:
            edged = f" {word} "
            starts.append(len(ids))
            ids += [get(edged[n : n + _GROUP], 0) for n in range(len(word))]
        scores = np.add.reduceat(model.scores[ids], starts, axis=0)
        scores = np.maximum(scores - scores.max(axis=1, keepdims=True), -WORD_LIMIT)
        unknown = np.zeros(len(model.langs), bool)
        able = np.array([model.scripts.get(_script(word), unknown) for word in self.new])
        scores[~able & able.any(axis=1, keepdims=True)] = -WORD_LIMIT
        scores[~able.any(axis=1)] = 0
        if len(self.table) < len(self):
            wider = np.zeros((max(len(self), 2 * len(self.table)), len(model.langs)), np.float32)
            wider[: len(self.table)] = self.table
            self.table = wider
        self.table[len(self) - len(self.new) : len(self)] = scores
        self.new = []
        return self.table


def viterbi(scores: list[np.ndarray]) -> list[np.ndarray]:
    """Best language of every word, for several texts (words × languages each) at a time.

    The texts advance together, word by word, longest first, so each step is one array operation.
    """
    order = sorted(range(len(scores)), key=lambda n: -len(scores[n]))
    result: list[np.ndarray] = [np.zeros(0, np.int64)] * len(scores)
    first = 0
    while first < len(order) and len(scores[order[first]]):
        longest = len(scores[order[first]])
        group = order[first : first + max(1, _CELLS // longest)]
        first += len(group)
        group = [n for n in group if len(scores[n])]
        sizes = np.array([len(scores[n]) for n in group])
        every = np.concatenate([scores[n] for n in group])
        begin = np.cumsum(sizes) - sizes
        active = np.searchsorted(-sizes, -np.arange(longest), "left")  # texts longer than t words
        value = every[begin].copy()
        stay = np.ones((longest, len(group), value.shape[1]), bool)
        source = np.zeros((longest, len(group)), np.int16)
        for t in range(1, longest):
            k = active[t]
            before = value[:k]
            best = before.argmax(axis=1)
            moved = before[np.arange(k), best][:, None] - SWITCH_PENALTY
            stay[t, :k], source[t, :k] = before >= moved, best
            value[:k] = np.maximum(before, moved) + every[begin[:k] + t]
        labels = np.zeros((longest, len(group)), np.int64)
        state = value.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            k = active[t]
            labels[t, :k] = state[:k]
            kept = stay[t, np.arange(k), state[:k]]
            state[:k] = np.where(kept, state[:k], source[t, :k])
        for n, text in enumerate(group):
            result[text] = labels[: sizes[n], n]
    return result


def predict(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id`, `lang_pred`, `score` and `spans` of every row of `docs`.

    Each word is scored by its letter groups for the languages that use its script (all alike if
    none does). The best path through the words of the whole text, with a penalty for each change,
    gives spans of one language, as first and last word. The language with most letters is
    predicted, ties to the first name; its share of the letters is the score. A text that is null or
    has no letter, or a model without languages, gives `und`, 0 and no spans. Rows are independent.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("lang", pa.string())])

    def label(texts: list[str | None], known: _Words):
        langs = known.model.langs
        words = [words_of(text.lower()) if text and langs else [] for text in texts]
        ids = [np.fromiter(map(known.__getitem__, w), np.int64, len(w)) for w in words]
        table = known.settle()
        for w, path in zip(words, viterbi([table[n] for n in ids])):
            if not w:
                yield UNDETERMINED, 0.0, []
                continue
            sizes = np.fromiter(map(len, w), np.int64, len(w))
            letters = np.bincount(path, sizes, len(langs))
            cuts = [0, *(np.nonzero(np.diff(path))[0] + 1).tolist(), len(path)]
            best = int(letters.argmax())
            yield langs[best], float(letters[best] / letters.sum()), [
                (start, end - 1, langs[path[start]]) for start, end in zip(cuts, cuts[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words(shared.value)
        for batch in batches:
            texts = batch["text"].to_pylist()
            found, waiting, size = [], [], 0
            for text in texts:
                waiting.append(text)
                size += len(text or "")
                if size > _TEXT_AT_ONCE:
                    found += label(waiting, known)
                    waiting, size = [], 0
                    if len(known) > _REMEMBERED:
                        known = _Words(shared.value)
            found += label(waiting, known)
            langs, scores, spans = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array([[dict(zip(span.names, s)) for s in each] for each in spans],
                          pa.list_(span))],
                ["doc_id", "lang_pred", "score", "spans"])

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, spans "
                                "array<struct<first_word:int,last_word:int,lang:string>>")


def held_out(doc_id: str) -> Column:
    """Documents that nothing is learned from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
