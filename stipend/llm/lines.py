"""Fuzzy line deduplication by MinHash, exact Jaccard similarity and distributed union-find."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stipend.llm.components import across, components
from stipend.llm.prefixes import rare_pairs
from stipend.llm.sizes import broadcast_up_to
from stipend.shared import own_folder, released, stage, write_stage

#: Shorter lines are only compared for equality: a character more or less is a fifth of their shingles.
MIN_CHARS = 20

#: Characters of the shingles that are compared exactly, and the similarity in percent that links lines.
SHINGLE = 5
PERCENT = 80

#: Keys of a set: the hash range has so many marks, and the ROWS least hashes from a mark on are a key. At a
#: similarity of 0.8 sets share one of the keys of 6 minima in 99.2 %, at 0.9 in more than 99.99 %.
BANDS = 16
ROWS = 6

#: Sets smaller than this have keys of FEW_ROWS, as 6 are much of such a set; those from SMALL * PERCENT / 100
#: on have both, so that two linked sets always have one kind in common.
SMALL = 20
FEW_ROWS = 2

#: Lines with so many different word starts (START characters behind a blank) have keys of the hashes of these
#: instead of every shingle's; those with fewer than BOTH, keys of their shingles, too. A start is longer than a
#: shingle and so lost by more changes, and rarer: keys are of START_ROWS.
START = 8
STARTED = 24
BOTH = 40
START_ROWS = 4

#: Of the minima at the marks, one byte each, as many must agree in a pair to be compared: 4 standard
#: deviations below what is expected at 0.8 (3.5 for word starts).
AGREEING = 7
STARTS_AGREEING = 4

#: Pairs for each line of a bucket, up to which lines of two classes are compared; crowds meet by their rarest shingles.
PAIRWISE = 32

#: Rows of narrow tables (ids, line numbers) that may be broadcast: some tens of MB.
BROADCAST_ROWS = 1_000_000

_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"

# Kinds of keys.
_STARTS, _SHINGLES, _FEW = range(3)
_MARKS = [(n << 64) // BANDS - (1 << 63) for n in range(BANDS)]
_SKETCH_BYTES = 8


def normal(line: Column) -> Column:
    """A line as it is compared: lower case, without white space around it."""
    return F.lower(F.trim(line, F.lit(" \t\r\x0b\x0c")))


def _lines(rows: DataFrame) -> DataFrame:
    """Lines of `_row`, `_id`, `_text` that are not blank: also `line_no`, `line` and its hash `id`."""
    lines = rows.select("_row", "_id", F.posexplode(F.split("_text", "\n")).alias("line_no", "line"))
    lines = lines.withColumn("line", normal(F.col("line"))).where("line <> ''")
    return lines.withColumn("id", F.xxhash64("line"))


def _places(code: Column) -> Column:
    """Where the shingles of a line in UTF-32 begin; in that code all characters are equally wide, so a
    shingle is found without reading up to it."""
    return F.sequence(F.lit(0), F.greatest(F.octet_length(code) - 4 * SHINGLE, F.lit(0)), F.lit(4))


def _shingle(code: Column, at: Column) -> Column:
    return F.xxhash64(F.substr(code, at + 1, F.lit(4 * SHINGLE)))


def _signatures(lines: DataFrame) -> DataFrame:
    """Band `keys` and the sketches `x` and `y`, a byte of each first minimum, of every distinct line,
    a row for each `kind` of keys it has.

    The hashes of a line are sorted within its row, and each mark's minima are the next ones behind it, as in
    one-permutation MinHash with rotation; equal lines fall together then.
    """
    starts = F.array_distinct(F.regexp_extract_all("line", F.lit(f"(?s) (?=(.{{{START}}}))"), F.lit(1)))
    begun = lines.select("id", "line", starts.alias("starts"))
    hashed = begun.select(
        "id", F.when(F.size("starts") >= STARTED, F.transform("starts", lambda start: F.xxhash64(start))).alias("some"),
        F.when(F.size("starts") < BOTH, _grams(F.encode("line", "UTF-32"))).alias("every"))
    kinds = F.array(*[
        F.when(which, F.struct(F.lit(kind).alias("kind"), F.lit(rows).alias("rows"), hashes.alias("hashes")))
        for kind, rows, which, hashes in (
            (_STARTS, START_ROWS, F.col("some").isNotNull(), F.col("some")),
            (_SHINGLES, ROWS, 100 * F.size("every") >= PERCENT * SMALL, F.col("every")),
            (_FEW, FEW_ROWS, F.col("every").isNotNull() & (F.size("every") < SMALL), F.col("every")))])
    each = hashed.select("id", F.explode(kinds).alias("set")).where("set is not null").select(
        "id", "set.kind", "set.rows", F.sort_array("set.hashes").alias("least"))
    marked = each.select("id", "kind", "rows", F.concat("least", F.slice("least", 1, ROWS)).alias("least"), F.sort_array(
        F.concat("least", F.array(*[F.lit(mark).cast("bigint") for mark in _MARKS]))).alias("marked"))
    # Hashes below a mark: its place without the marks below it.
    found = marked.select("id", "kind", "rows", "least", F.array(*[
        (F.array_position("marked", F.lit(mark).cast("bigint")) - 1 - n).cast("int")
        for n, mark in enumerate(_MARKS)]).alias("at"))
    firsts = [F.shiftleft(F.get("least", F.get("at", F.lit(n))).bitwiseAND(F.lit(255).cast("bigint")), 8 * (n % _SKETCH_BYTES))
              for n in range(BANDS)]
    wide = found.select(
        "id", "kind", reduce(Column.bitwiseOR, firsts[:_SKETCH_BYTES]).alias("x"),
        reduce(Column.bitwiseOR, firsts[_SKETCH_BYTES:]).alias("y"), *[
            F.xxhash64("kind", F.lit(n), F.slice("least", F.get("at", F.lit(n)) + 1, F.col("rows"))).alias(f"k{n}")
            for n in range(BANDS)])
    once = wide.groupBy("id", "kind").agg(
        *[F.first(c).alias(c) for c in ("x", "y")], *[F.first(f"k{n}").alias(f"k{n}") for n in range(BANDS)])
    return once.select("id", "kind", "x", "y", F.array(*[f"k{n}" for n in range(BANDS)]).alias("keys"))


def _alike(other: str) -> Column:
    """Whether enough bytes of the sketches `x`, `y` and `x_<other>`, `y_<other>` agree."""
    unlike = []
    for c in "xy":
        bits = F.col(c).bitwiseXOR(F.col(f"{c}_{other}"))
        for n in (4, 2, 1):  # all bits of a byte into its lowest
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, n))
        unlike.append(F.bit_count(bits.bitwiseAND(F.lit(0x0101010101010101))))
    least = F.when(F.col("kind") == _STARTS, STARTS_AGREEING).when(F.col("kind") == _SHINGLES, AGREEING).otherwise(1)
    return BANDS - unlike[0] - unlike[1] >= least


def near_classes(lines: DataFrame) -> DataFrame:
    """Classes of near lines as `node`, `component`, without those that are their own.

    A line is compared with the first lines of its buckets, the first of these to begin with: pairs
    grow with the lines. Where a bucket then still holds several classes, lines of two classes are
    compared if that makes up to PAIRWISE pairs a line; crowds of more meet by their rarest shingles,
    which loses no pair and does not grow with the square of lines that share an opening or a passage
    (`rare_pairs`): what is rare is counted among the lines that share crowded buckets, where neither
    is. Only pairs with like sketches are compared on their texts.
    """
    kept = own_folder(lines.sparkSession, "shared")
    with released():
        signatures = _compiled(_signatures(lines.where(F.char_length("line") >= MIN_CHARS)), "signatures")
        members = signatures.select("id", "kind", "x", "y", F.explode("keys").alias("key"))
        buckets = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        shared = write_stage(members.join(broadcast_up_to(stage(buckets, "buckets"), BROADCAST_ROWS), "key"), kept)
    # The few lines that share a bucket are all that is read from here on.
    lines = _texts(lines, shared.select("id").distinct())
    first = shared.groupBy("key").agg(F.min("id").alias("hub"))
    hubs = shared.join(first, "key").where("id = hub").select(
        "key", "hub", F.col("x").alias("x_hub"), F.col("y").alias("y_hub"))
    shared = stage(shared.join(hubs, "key").withColumn("alike", _alike("hub")).drop("x_hub", "y_hub"), "with_hubs")
    stars = stage(shared.where("id <> hub and alike").select(
        F.col("id").alias("a"), F.col("hub").alias("b")).distinct(), "star_pairs")
    nearest = stars.groupBy("a").agg(F.min("b").alias("b"))
    links = _links(nearest, lines)
    others = across(stars, components(links)).join(nearest, ["a", "b"], "left_anti")
    links = links.unionByName(_links(others, lines))
    labels = components(links)
    classed = shared.where("n > 2").join(
        broadcast_up_to(labels.withColumnRenamed("node", "id"), BROADCAST_ROWS), "id", "left"
    ).select("key", "id", "kind", "x", "y", "n", "hub", F.coalesce("component", "id").alias("class"))
    sizes = classed.groupBy("key", "class").agg(F.count("*").alias("c")).groupBy("key").agg(
        F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("within"), F.max_by("class", "c").alias("main"))
    twice = F.col("m") * F.col("m") - F.col("within")
    mixed = sizes.where(twice > 0).select("key", "main", (twice <= 2 * PAIRWISE * F.col("m")).alias("few"))
    open_lines = stage(classed.join(mixed, "key"), "open")
    pairs = _pairs_in(open_lines.where("few"))
    crowd = stage(open_lines.where("not few").select("id", "kind", "x", "y", "class", "hub"), "crowd")
    if not crowd.isEmpty():
        groups = components(crowd.select("id", "hub")).select(F.col("node").alias("id"), F.col("component").alias("group"))
        nodes = crowd.select("id", "class").distinct().join(groups, "id", "left").select(
            F.col("id").alias("node"), "class", F.coalesce("group", "id").alias("group"))
        sets = _sets(lines, crowd.select("id").distinct())
        met = stage(rare_pairs(nodes, sets, PERCENT, within=("group",)), "met")
        pairs = pairs.unionByName(_alike_pairs(met, crowd.select("id", "kind", "x", "y").distinct()))
    more = _links(pairs.distinct(), lines)
    return labels if more.isEmpty() else components(links.unionByName(more))


def _pairs_in(rows: DataFrame) -> DataFrame:
    """The pairs of a bucket's lines in two classes that may be alike. One of a pair is not in the
    bucket's largest class, so that this is not compared with itself."""
    other = rows.select("key", F.col("id").alias("b"), F.col("class").alias("class_b"), *[F.col(c).alias(f"{c}_b") for c in "xy"])
    return rows.where(F.col("class") != F.col("main")).withColumnRenamed("id", "a").join(other, "key").where(
        (F.col("class") != F.col("class_b")) & ((F.col("a") > F.col("b")) | (F.col("class_b") == F.col("main")))
        & (F.col("a") != F.col("hub")) & (F.col("b") != F.col("hub")) & _alike("b")
    ).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _alike_pairs(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs of lines that are alike in a kind of their sketches."""
    other = rows.select("kind", F.col("id").alias("b"), *[F.col(c).alias(f"{c}_b") for c in "xy"])
    return pairs.join(rows.withColumnRenamed("id", "a"), "a").join(other, ["kind", "b"]).where(
        _alike("b")).select("a", "b").distinct()


def _texts(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """`id` and `line` of the wanted distinct lines."""
    ids = stage(ids, "ids")
    return _compressed(
        lines.select("id", "line").join(broadcast_up_to(ids, BROADCAST_ROWS), "id", "left_semi")
        .dropDuplicates(["id"]).select("id", "line"), "texts")


def _compiled(df: DataFrame, label: str) -> DataFrame:
    """`stage` for a step of many long expressions: the JVM compiles no method of more than 8000 bytes
    of code, so Spark is not to join these into one."""
    conf = df.sparkSession.conf
    before = conf.get(_METHOD_LIMIT)
    conf.set(_METHOD_LIMIT, "8000")
    try:
        return stage(df, label)
    finally:
        conf.set(_METHOD_LIMIT, before)


def _compressed(df: DataFrame, label: str) -> DataFrame:
    """`stage` for texts, which take most of the disk."""
    return write_stage(df, own_folder(df.sparkSession, label), "zstd")


def _grams(code: Column | str) -> Column:
    """Distinct shingles of a line in UTF-32. The line is an argument of the outer function: as a column
    inside the inner one it would be copied out of its row for each shingle."""
    return F.array_distinct(F.flatten(F.transform(
        F.array(code), lambda whole: F.transform(_places(whole), lambda at: _shingle(whole, at)))))


def _sets(lines: DataFrame, ids: DataFrame) -> DataFrame:
    coded = _texts(lines, ids).select("id", F.encode("line", "UTF-32").alias("code"))
    # Written, as a condition on the hashes would be moved in front of them and make them again.
    return stage(coded.select(F.col("id").alias("node"), _grams("code").alias("hashes")), "sets")


def _links(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The pairs whose sets of SHINGLE characters have a Jaccard similarity of PERCENT."""
    pairs = stage(pairs, "pairs")
    texts = _texts(lines, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    # In UTF-32 only behind the joins: it is four times as wide to shuffle.
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("line_a")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b")
    coded = both.select("a", "b", *[F.encode(f"line_{end}", "UTF-32").alias(f"code_{end}") for end in "ab"])
    sets = coded.select("a", "b", _grams("code_a").alias("x"), _grams("code_b").alias("y"))
    # The condition is put to written sizes: Spark would move it in front of the sets and make them
    # again for each of their uses.
    sizes = stage(sets.select("a", "b", (F.size("x") + F.size("y")).alias("total"),
                              F.size(F.array_intersect("x", "y")).alias("common")), "sizes")
    return sizes.where(100 * F.col("common") >= PERCENT * (F.col("total") - F.col("common"))).select("a", "b")


def duplicate_lines(docs: DataFrame, row: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines to remove, as `_row` and the `_dropped` line numbers of the row.

    `docs` numbers its rows in the column `row`. Lines are split at line feeds; equal lines, however
    short, and lines linked through any chain of near ones form a class, of which the first line
    stays: of the smallest id, null ids first, then of the first row and line. Blank lines stay.
    """
    rows = docs.select(F.col(f"`{row}`").alias("_row"), F.col(f"`{id_col}`").alias("_id"),
                       F.col(f"`{text_col}`").alias("_text"))
    # Cut and lower-cased once; the steps below each read the columns they need.
    lines = _compressed(_lines(rows), "lines")
    labels = near_classes(lines).withColumnRenamed("node", "id")
    places = lines.select("id", "_id", "_row", "line_no")
    classed = places.join(broadcast_up_to(labels, BROADCAST_ROWS), "id", "left").select(
        F.coalesce("component", "id").alias("class"), F.struct("_id", "_row", "line_no").alias("place"))
    firsts = stage(
        classed.groupBy("class").agg(F.count("*").alias("n"), F.min("place").alias("first"))
        .where("n > 1").select("class", "first"), "firsts")
    return classed.join(broadcast_up_to(firsts, BROADCAST_ROWS), "class").where(
        F.col("place") != F.col("first")
    ).groupBy(F.col("place._row").alias("_row")).agg(F.collect_list("place.line_no").alias("_dropped"))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the duplicate lines taken out of its texts, and `n_lines`, `n_dropped` and
    `emptied`: had a line that is not blank, and has none left. Columns of these names are replaced,
    all others, whatever their names, are kept.

    Rows of `docs` must come in the same order whenever it is read, as from files. Null texts stay
    null, empty and blank ones as they are; repeated rows count as separate documents, so the later
    ones lose their lines. Every step in between reads written tables.
    """
    row, dropped = unused("_row", docs), unused("_dropped", docs)
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    lost = stage(duplicate_lines(numbered, row, id_col, text_col), "dropped").withColumnsRenamed(
        {"_row": row, "_dropped": dropped})
    joined = numbered.join(broadcast_up_to(lost, BROADCAST_ROWS), row, "left")
    whole, gone = F.col(f"`{text_col}`"), F.col(f"`{dropped}`")
    left = F.filter(F.split(whole, "\n"), lambda line, n: ~F.array_contains(gone, n))
    text = F.when(gone.isNull(), whole).otherwise(F.array_join(left, "\n"))
    # Counted in bytes, as splitting every text again would cost more.
    breaks = F.octet_length(whole) - F.octet_length(F.replace(whole, F.lit("\n"), F.lit("")))
    blank = F.translate(text, " \t\n\x0b\x0c\r", "") == ""
    return joined.select(
        *[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns
          if c not in ("n_lines", "n_dropped", "emptied")],
        F.coalesce(breaks + 1, F.lit(0)).cast("int").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).alias("n_dropped"),
        F.coalesce(gone.isNotNull() & blank, F.lit(False)).alias("emptied"),
    )


def unused(name: str, df: DataFrame) -> str:
    """`name`, with underscores in front until no column of `df` has it."""
    while name in map(str.lower, df.columns):
        name = f"_{name}"
    return name
