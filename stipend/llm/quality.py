"""Quality classifier: document evidence combined with shrunken posteriors of host and path."""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stipend.llm.rows import columns_of, packed
from stipend.shared import stage

#: Labelled documents that the document classifier is fitted on at most.
SAMPLE = 20_000

#: A document is rejected if its chance to be bad is above this.
CUT = 0.5

#: Words and word beginnings count as signs of bad documents from this many of them on, if they are
#: this much more likely there, as a logarithm.
MIN_DOCS = 5
MIN_ODDS = 3.0
STRONG_ODDS = 5.0

#: Signs that are kept at most, strongest first.
MAX_SIGNS = 50_000

#: Labelled documents that a site's prior counts as, at least and at most.
PRIOR_RANGE = (1.0, 1000.0)

_WORD = re.compile(rb"[^\x00-\x20]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_BEGINNINGS = (4, 5)
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t\n\r",
            "mark": b"!?", "symbol": b"#*$%&<>@^~=+\\", "bar": b"|", "stop": b".,;:"}
_NUMBERS = 18


@dataclass
class Evidence:
    """A fitted document classifier: signs with their strength, and weights of the numbers."""

    signs: dict[str, float] = field(default_factory=dict)
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    weights: np.ndarray | None = None
    prior: float = 0.0

    def log_odds(self, numbers: np.ndarray) -> np.ndarray:
        """Log-odds to be bad that the text alone adds to those of the sample."""
        if self.weights is None:
            return np.zeros(len(numbers))
        scaled = np.clip((numbers - self.mean) / self.spread, -8, 8)
        return scaled @ self.weights[1:] + self.weights[0] - self.prior


def signs_of(text: str) -> set[str]:
    """Distinct lower-case words and beginnings of longer words (marked by a dash)."""
    words = set(_LETTERS.findall(text.lower()))
    return words | {f"{w[:n]}-" for w in words for n in _BEGINNINGS if len(w) > n}


_tables = {name: np.isin(np.arange(256), np.frombuffer(chars, np.uint8)) for name, chars in _CLASSES.items()}


def numbers_of(text: str | None, signs: dict[str, float]) -> np.ndarray:
    """What the classifier sees of a text; whole texts, any length."""
    data = (text or "").encode()
    words = _WORD.findall(data)
    result = np.zeros(_NUMBERS)
    if not words:
        return result
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size, n = len(data), len(words)
    shares = [counts[table].sum() / size for table in _tables.values()]
    distinct: dict[bytes, int] = {}
    repeats, last = 0, None
    for word in words:
        distinct[word] = distinct.get(word, 0) + 1
        repeats += word == last
        last = word
    found = [signs[s] for s in signs_of(text) if s in signs] if signs else []
    strong = sum(x >= STRONG_ODDS for x in found)
    result[:] = [
        1, *shares, np.log(n), min(size / n, 100), len(distinct) / n, max(distinct.values()) / n,
        repeats / n, np.log1p(len(found) - strong), np.log1p(strong), max(found, default=0),
        100 * len(found) / (n + 20), len(distinct) / n**0.7,
    ]
    return result


def bad_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """`_label_id` and `_bad`: of quality 0 or toxic. Rows without id or any label are left out,
    repeated ones are bad if one of them is."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = F.col("quality").isNotNull() | F.col("toxic").isNotNull()
    return labels.where(F.col(id_col).isNotNull() & known).groupBy(
        F.col(id_col).alias("_label_id")
    ).agg(F.max(F.coalesce(bad, F.lit(False)).cast("int")).alias("_bad"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Evidence:
    """Fit the document classifier on SAMPLE labelled documents at most, chosen by the hash of
    their id. One half gives the signs, the other the weights, so the signs' strength is not judged
    on the documents it was learned from. Equal texts count once, as bad if one of them is. One class alone gives a classifier that knows nothing.
    """
    chosen = stage(bad_labels(labels, id_col).orderBy(F.xxhash64("_label_id"), "_label_id").limit(SAMPLE),
                   "chosen")
    # SAMPLE rows of two numbers: a proven bound.
    sample = stage(
        docs.select(F.col(id_col).alias("_label_id"), F.col(text_col).alias("text")).where("text is not null")
        .join(F.broadcast(chosen), "_label_id")
        .groupBy("text").agg(F.max("_bad").alias("bad"))
        .select("text", "bad", (F.xxhash64("text") % 2 == 0).alias("half")), "sample")
    totals = {(r["half"], r["bad"]): r["count"] for r in sample.groupBy("half", "bad").count().collect()}
    if len({bad for _, bad in totals}) < 2:
        return Evidence()
    good_docs, bad_docs = totals.get((True, 0), 0), totals.get((True, 1), 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, bad in zip(batch["text"], batch["bad"]):
                for sign in signs_of(text.as_py()):
                    counts.setdefault(sign, [0, 0])[bad.as_py()] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()),
                 *[pa.array([c[n] for c in counts.values()], pa.int64()) for n in range(2)]],
                ["sign", "good", "bad"])

    odds = F.log((F.col("bad") + 0.5) / (bad_docs + 1)) - F.log((F.col("good") + 0.5) / (good_docs + 1))
    signs = sample.where("half").select("text", "bad").mapInArrow(
        count, "sign string, good bigint, bad bigint"
    ).groupBy("sign").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).where(
        F.col("bad") >= MIN_DOCS).withColumn("odds", odds).where(F.col("odds") >= MIN_ODDS)
    found = {r["sign"]: r["odds"] for r in signs.orderBy(F.col("odds").desc(), "sign").limit(MAX_SIGNS).collect()}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch["bad"], pa.array([numbers_of(t.as_py(), found) for t in batch["text"]],
                                        pa.list_(pa.float64()))], ["bad", "x"])

    rows = sample.where("not half").select("text", "bad").mapInArrow(
        measure, "bad int, x array<double>").collect()
    return _logistic(found, np.array([r["x"] for r in rows]).reshape(-1, _NUMBERS),
                     np.array([r["bad"] for r in rows], float))


def _logistic(signs: dict[str, float], x: np.ndarray, y: np.ndarray) -> Evidence:
    """Logistic regression by Newton steps with a small ridge."""
    if not 0 < y.sum() < len(y):
        return Evidence()
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    scaled = np.column_stack([np.ones(len(x)), np.clip((x - mean) / spread, -8, 8)])
    ridge = np.diag([1e-6, *[1.0] * (scaled.shape[1] - 1)])
    weights = np.zeros(scaled.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(scaled @ weights, -30, 30)))
        slope = scaled.T @ (y - p) - ridge @ weights
        step = np.linalg.solve((scaled * (p * (1 - p))[:, None]).T @ scaled + ridge, slope)
        weights += np.clip(step, -3, 3)
    return Evidence(signs, mean, spread, weights, float(np.log(y.mean() / (1 - y.mean()))))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(rates: DataFrame) -> float:
    """Documents that the prior of a site counts as, by the method of moments over its sites.

    `rates` has `n`, `k` bad of them and the `mean` that its group is shrunk to. What the rates vary
    beyond chance is the spread of the sites; sites that do not differ get the strongest prior.
    """
    rate = F.col("k") / F.col("n")
    chance = F.col("mean") * (1 - F.col("mean"))
    found = rates.agg(
        F.sum(F.col("n") * (rate - F.col("mean")) ** 2).alias("seen"), F.sum(chance).alias("chance"),
        F.sum("n").alias("n"), F.sum(F.col("n") * chance).alias("weighed")).first()
    low, high = PRIOR_RANGE
    if not found["n"] or not found["weighed"] or found["n"] <= 0:
        return high
    between = max(0.0, (found["seen"] - found["chance"]) / found["n"])
    within = found["weighed"] / found["n"]
    return high if between <= within / (1 + high) else max(low, min(high, within / between - 1))


def site_posteriors(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", host_col: str = "source",
    path_col: str = "lang",
) -> tuple[DataFrame, DataFrame, float]:
    """Chance of a bad document per host (`_host`, `_host_p`) and per host and path (`_host`,
    `_path`, `_path_p`), and the global one, over all labelled documents.

    Rates are grouped sums of narrow columns, combined in the task. Host rates are shrunk to the
    global rate, path rates to their host's posterior, each by a prior whose strength the spread of
    the rates gives. Null hosts and paths are sites of their own.
    """
    narrow = docs.select(F.col(id_col).alias("_label_id"), F.col(host_col).alias("_host"), F.col(path_col).alias("_path"))
    paths = stage(
        narrow.join(bad_labels(labels, id_col), "_label_id").groupBy("_host", "_path").agg(
            F.count("*").alias("n"), F.sum("_bad").alias("k")), "sites")
    whole = paths.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    p = ((whole["k"] or 0) + 1) / ((whole["n"] or 0) + 2)
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("mean", F.lit(p))
    m = _strength(hosts)
    hosts = stage(hosts.select("_host", ((F.col("k") + m * p) / (F.col("n") + m)).alias("_host_p")), "hosts")
    upper = hosts.withColumnRenamed("_host", "_h")
    rates = paths.join(upper, F.col("_host").eqNullSafe(F.col("_h"))).withColumn("mean", F.col("_host_p"))
    m = _strength(rates)
    paths = stage(rates.select(
        "_host", "_path", ((F.col("k") + m * F.col("mean")) / (F.col("n") + m)).alias("_path_p")), "paths")
    return hosts, paths, p


def classify(
    docs: DataFrame, labels: DataFrame, cut: float = CUT, id_col: str = "doc_id",
    text_col: str = "text", host_col: str = "source", path_col: str = "lang",
) -> DataFrame:
    """`docs` with `p_bad`, the posterior chance of a bad document, and `kept` (at most `cut`);
    columns of these names are replaced.

    The log-odds are those of the document's site (its path, else its host, else all sites) plus
    what its text adds. Texts are read where they lie, whole, in Arrow batches, and joined only with
    the small table of sites. Null and blank texts are scored as empty ones; rows repeat as they
    are; without labels every document is kept.
    """
    model = fit(docs, labels, id_col, text_col)
    hosts, paths, p = site_posteriors(docs, labels, id_col, host_col, path_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    whole = packed(docs, F.col(f"`{host_col}`").alias("host"), F.col(f"`{path_col}`").alias("path"))
    schema = StructType([*whole.schema.fields, StructField("_evidence", DoubleType())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = shared.value
        for batch in batches:
            numbers = np.array([numbers_of(t.as_py(), evidence.signs) for t in batch["row"].field(at)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(evidence.log_odds(numbers.reshape(-1, _NUMBERS)))],
                schema.names)

    read = whole.mapInArrow(run, schema)
    host, path = F.col("host"), F.col("path")
    sites = paths.withColumnRenamed("_host", "_h").withColumnRenamed("_path", "_p")
    joined = read.join(
        sites, host.eqNullSafe(F.col("_h")) & path.eqNullSafe(F.col("_p")), "left"
    ).drop("_h", "_p").join(hosts, host.eqNullSafe(F.col("_host")), "left")
    site = F.coalesce("_path_p", "_host_p", F.lit(p))
    chance = 1 / (1 + F.exp(-(F.col("_evidence") + _logit(site))))
    known = bool(model.weights is not None)
    return joined.withColumn("p_bad", chance if known else F.lit(p)).withColumn(
        "kept", F.col("p_bad") <= cut if known else F.lit(True)
    ).select(*columns_of(docs, "p_bad", "kept"), "p_bad", "kept")
