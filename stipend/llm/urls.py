"""URL rules found by hashed host-suffix and path-prefix expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stipend.llm.rows import columns_of, packed

#: The rules of the registered query, as (verdict, rule).
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]

#: Hex digits of the SHA-256 digest that are the join key.
PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _folder(path: Column) -> Column:
    """The path up to its last slash."""
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def _digest(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat(host, folder), 256)


def url_verdicts(pages: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """`pages` next to `host`, `path`, `rule` and `verdict`; columns of these names are replaced.

    `rules` has `rule` (host and path as one text, split at the first slash) and `verdict`. A rule
    fits its host and all subdomains if the path starts with the rule's; the longest wins, of two
    as long ones the one with the longer host, of repeated ones the smaller verdict. Without a rule
    that fits the verdict is `allow` and the rule null; so it is for null and malformed urls. Long
    urls are read whole; repeated rows and all other columns, whatever their names, stay; no pages
    give no rows, no rules allow everything.

    Each distinct url is expanded into the suffixes of its host times the folders its path lies in,
    no more labels and folders than some rule has. Expressions and rules meet in an equality join
    on a short hash prefix; the full digest, the rest of a rule's path that ends within a name, and
    the texts themselves then confirm it. One url's matches are reduced to the best one in the task
    first, so a url that fills a third of the table costs one row. The rules are broadcast only if
    their size allows it.
    """
    at = F.instr("rule", "/")
    rules = rules.where(F.col("rule").isNotNull() & F.col("verdict").isNotNull()).select(
        "rule", "verdict",
        F.when(at > 0, F.substring_index("rule", "/", 1)).otherwise(F.col("rule")).alias("_host"),
        F.when(at > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise("").alias("_path"),
    ).withColumn("_folder", _folder(F.col("_path")))
    rules = rules.withColumn("_digest", _digest(F.col("_host"), F.col("_folder")))
    rules = rules.withColumn("_key", F.substring("_digest", 1, PREFIX_DIGITS))
    most = rules.agg(
        F.max(F.size(F.split("_host", r"\."))).alias("labels"),
        F.max(F.size(F.split("_folder", "/"))).alias("folders"),
    ).first()
    labels, folders = most["labels"] or 1, most["folders"] or 1

    urls = pages.select(F.col(f"`{url_col}`").alias("_url")).where("_url is not null").distinct()
    urls = urls.select("_url", host_of(F.col("_url")).alias("_h"), path_of(F.col("_url")).alias("_p"))
    parts, names = F.split("_h", r"\."), F.split("_p", "/")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.lit(labels), F.size(parts))),
        lambda n: F.array_join(F.slice(parts, -n, n), "."),
    )
    prefixes = F.transform(
        F.sequence(F.lit(1), F.least(F.lit(folders), F.size(names))),
        lambda n: F.when(n == 1, F.lit("")).otherwise(
            F.concat(F.array_join(F.slice(names, 1, n - 1), "/"), F.lit("/"))),
    )
    expressions = urls.withColumn("_s", F.explode(suffixes)).withColumn("_f", F.explode(prefixes))
    expressions = expressions.withColumn("_d", _digest(F.col("_s"), F.col("_f")))
    hits = expressions.withColumn("_key", F.substring("_d", 1, PREFIX_DIGITS)).join(rules, "_key").where(
        (F.col("_d") == F.col("_digest")) & (F.col("_s") == F.col("_host"))
        & F.startswith(F.col("_p"), F.col("_path"))
    )
    order = F.struct(F.length("rule"), F.length("_host"))
    best = hits.groupBy("_url").agg(F.max_by(
        F.struct("rule", "verdict"), F.struct(order, F.col("verdict") == "allow")).alias("_best"))
    whole = packed(pages, F.col(f"`{url_col}`").alias("url"))
    return whole.join(best, F.col("url") == F.col("_url"), "left").select(
        *columns_of(pages, "host", "path", "rule", "verdict"),
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.verdict"), F.lit("allow")).alias("verdict"),
    )
