"""Quality rules: shape and repetition of a text, and lines that many documents of a host share."""

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stipend.llm.sizes import broadcast_up_to
from stipend.shared import stage

WORD = r"[^\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "[#*$%&|<>]"

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: A line in more documents of a host than this is removed.
MAX_DOCS_PER_LINE = 10

#: Removed lines, or rows that lose some, that may be broadcast: a few numbers each.
BROADCAST_ROWS = 1_000_000

#: A document that loses more than this share of its words to removed lines is rejected.
MAX_LOST_PERCENT = 50


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, also where a lambda refers to it."""
    return F.transform(F.array(value), body)[0]


def _paired(by: int, hashes: Column) -> Column:
    """Hash of each element with the one `by` places on."""
    left = F.greatest(F.size(hashes) - by, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, left), F.slice(hashes, by + 1, left),
                      lambda a, b: F.xxhash64(a, b))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words inside windows of `window` words that occur twice or more, first included.

    Window hashes are built by doubling; the few texts with equal windows are sorted by hash, and
    the positions of equal neighbours, in order, cover the words.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    width = 1
    while width < window:
        hashes = let(hashes, partial(_paired, width))
        width *= 2

    def covered(h: Column) -> Column:
        places = F.array_sort(F.transform(h, lambda x, n: F.struct(x.alias("h"), n.alias("n"))))
        return let(places, lambda s: let(F.array_sort(F.transform(
            F.filter(s, lambda e, n: (e["h"] == F.get(s, n - 1)["h"]) | (e["h"] == F.get(s, n + 1)["h"])),
            lambda e: e["n"],
        )), lambda p: F.aggregate(
            F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.coalesce(
                F.least(b - a, F.lit(window)), F.lit(window))),
            F.lit(0), lambda total, n: total + n)))

    return let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0)).cast("bigint")


def line_key(line: Column) -> Column:
    """Hash of a line as it is compared across documents: lower case, single spaces, trimmed."""
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))))


def _counted(docs: DataFrame, id_col: str, text_col: str, source_col: str, count_texts: bool) -> DataFrame:
    """Every row with its counts and `lines`: key, number and words of each line that has a word."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("host"), text.alias("text"),
        F.col(text_col).alias("given"))
    full = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, _SPACES, "")) > 0)
    numbered = F.filter(
        F.transform(F.split("text", "\n"), lambda x, n: F.struct(x.alias("x"), n.alias("n"))),
        lambda e: F.length(F.translate(e["x"], _SPACES, "")) > 0)
    return rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).select(
        "doc_id", "host", "given", (F.xxhash64("text") if count_texts else F.lit(None).cast("bigint")).alias("body"),
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.translate("text", _SPACES, "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(_SYMBOLS)).cast("bigint").alias("n_symbols"),
        let(full, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.transform(numbered, lambda e: F.struct(
            line_key(e["x"]).alias("line"), e["n"].alias("line_no"),
            F.regexp_count(e["x"], F.lit(WORD)).alias("n"))).alias("lines"),
    ).withColumn("row", F.monotonically_increasing_id())


def _frequent_lines(counted: DataFrame, max_docs_per_line: int, count_texts: bool) -> DataFrame:
    """`row`, `line_no` and words `n` of the lines that too many documents of their host hold."""
    once = F.array_distinct(F.transform("lines", lambda e: e["line"]))
    texts = counted.select("host", "body", F.explode(once).alias("line"))
    if count_texts:
        texts = texts.distinct()
    frequent = stage(
        texts.groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > max_docs_per_line)
        .select(F.col("host").alias("_h"), F.col("line").alias("_l")),
        "frequent",
    )
    lines = counted.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.*")
    gone = lines.join(
        frequent, F.col("host").eqNullSafe(F.col("_h")) & (F.col("line") == F.col("_l")), "left_semi")
    return gone.select("row", "line_no", "n")


def _verdicts(joined: DataFrame, max_lost_percent: int, *more: str) -> DataFrame:
    lost_words = F.coalesce(F.col("lost"), F.lit(0)).cast("bigint")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    depleted = (lost_words > 0) & (
        (100 * lost_words > max_lost_percent * F.col("n_words"))
        | (F.col("n_words") - lost_words < MIN_WORDS))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), lost_words.alias("lost_words"), *more)


def quality_rules(
    docs: DataFrame, max_docs_per_line: int = MAX_DOCS_PER_LINE,
    max_lost_percent: int = MAX_LOST_PERCENT, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source", count_texts: bool = False,
) -> DataFrame:
    """The verdicts of `without_frequent_lines` alone: its arguments and columns, but for `text`. No text
    is written or moved: a line leaves its hash, number and words, a row one number of lost words."""
    counted = stage(
        _counted(docs, id_col, text_col, source_col, count_texts).drop("given"), "counted")
    gone = _frequent_lines(counted, max_docs_per_line, count_texts)
    lost = stage(gone.groupBy("row").agg(F.sum("n").alias("lost")), "lost")
    joined = counted.drop("lines").join(broadcast_up_to(lost, BROADCAST_ROWS), "row", "left")
    return _verdicts(joined, max_lost_percent)


def without_frequent_lines(
    docs: DataFrame, max_docs_per_line: int = MAX_DOCS_PER_LINE,
    max_lost_percent: int = MAX_LOST_PERCENT, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source", count_texts: bool = False,
) -> DataFrame:
    """Every row of `docs`: `doc_id`, the counts, `base_failed`, `lost_words`, `kept` and the `text` that
    is left without the lines its host repeats; the counts but `lost_words` are those of the whole text.

    Lines are split at line feeds and compared in lower case with single spaces. A line that more
    than `max_docs_per_line` documents of one host hold is removed there from all of them. Every row is
    a document, also if its text or id is another's; with `count_texts` equal texts of a host count as
    one, so that copies do not condemn each other. A document that loses more
    than `max_lost_percent` of its words, or has fewer than MIN_WORDS left of them, is rejected, and
    so is one that fails the base rules (too short, too repetitive). A null text has no words and
    fails; a null host is a host; an empty table gives no rows; other columns are not read.

    A null text stays null, blank lines stay. The counts are expressions over one row. The line table is narrow: a hash per distinct line of a
    text, counted in each task first, so hot hosts and hot lines shuffle no more than one row per task and
    line. Every row keeps its own number, written once, so repeated ids stay apart.
    """
    counted = stage(_counted(docs, id_col, text_col, source_col, count_texts), "counted")
    lines = stage(_frequent_lines(counted, max_docs_per_line, count_texts), "lost")
    few = lines.count() <= BROADCAST_ROWS
    lost = lines.groupBy("row").agg(F.sum("n").alias("lost"), F.collect_list("line_no").alias("gone"))
    whole = F.split("given", "\n")
    left = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(whole) - 1), F.col("gone")), lambda n: F.get(F.col("whole"), n))
    joined = counted.drop("lines").join(F.broadcast(lost) if few else lost, "row", "left").withColumn(
        "whole", F.when(F.col("gone").isNotNull(), whole)
    ).withColumn("text", F.when(F.col("gone").isNull(), F.col("given")).otherwise(F.array_join(left, "\n")))
    return _verdicts(joined, max_lost_percent, "text")
