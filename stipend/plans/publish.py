"""Publication of the newest batch as numbered files."""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stipend import fixed_values as fixed
from stipend.functions.amounts import int_trunc, money_text
from stipend.operators.latest import latest_batch, latest_batch_by
from stipend.operators.numbering import assign_group_batches, batch_manifest
from stipend.shared import own_folder, released, stage, write_stage
from stipend.sinks.delimited import FileSet, csv_line, export_file_sets


@dataclass(frozen=True)
class Profile:
    name: str
    category: str | None
    strict: bool
    rows_per_file: int
    sep: str
    formatted: bool
    prefix: str
    ext: str


PROFILES = {values[0]: Profile(*values) for values in fixed.PROFILES}


def _cells(formatted: bool) -> list[Column]:
    """The record columns; if `formatted`, amounts with two decimals and integer columns truncated.
    Nulls stay null."""
    styled = {c: money_text(F.col(c)) for c in fixed.TWO_DECIMAL_COLUMNS}
    styled |= {c: int_trunc(F.col(c)) for c in fixed.INTEGER_COLUMNS}
    if not formatted:
        styled = {}
    return [styled.get(c, F.col(c)).alias(c) for c in fixed.RECORD_COLUMNS]


def publish_latest_batch(
    spark: SparkSession, records: DataFrame, profile: Profile, out: str
) -> DataFrame:
    """Write the newest batch of a profile as `<out>/<prefix>/<prefix>-<n>.<ext>`; return the manifest
    of the files.

    The rows are numbered once, and both the files and the manifest come from that numbering, so
    counts and contents cannot differ. Without any row no file is written, and those of an earlier
    run go. Only the manifest, one row per file, stays in the shared folder.
    """
    kept = own_folder(spark, "manifest")
    with released():
        rows = latest_batch(records, profile.category, profile.strict)
        return write_stage(_publish(rows.withColumn("set_no", F.lit(0)), [profile], [out]).drop("set_no"), kept)


def publish_profiles(
    spark: SparkSession, records: DataFrame, profiles: Iterable[Profile], out: str
) -> DataFrame:
    """Write the newest batches of several profiles, each below `<out>/<profile name>`; return
    their manifests as one, with the column `profile`.

    The newest batches of all wage types are found together, one pass for each of the two readings of
    the newest time, and all profiles are numbered, sorted and written together, however many there are.
    """
    profiles = list(profiles)
    kept = own_folder(spark, "manifests")
    with released():
        # Written, as cutting key ranges reads the rows twice.
        rows = stage(reduce(DataFrame.unionByName, _newest_of(records, profiles)), "newest")
        outs = [f"{out.rstrip('/')}/{p.name}" for p in profiles]
        manifest = _publish(rows, profiles, outs)
        name = F.element_at(F.array(*[F.lit(p.name) for p in profiles]), F.col("set_no") + 1)
        return write_stage(manifest.select(name.alias("profile"), "*").drop("set_no"), kept)


def _newest_of(records: DataFrame, profiles: list[Profile]) -> Iterator[DataFrame]:
    """The newest rows of the profiles, with the place of their profile in the list as `set_no`."""
    for n, profile in enumerate(profiles):
        if profile.category is None:
            rows = latest_batch(records, None, profile.strict)
            yield rows.select(*fixed.RECORD_COLUMNS, F.lit(n).alias("set_no"))
    for strict in sorted({p.strict for p in profiles if p.category is not None}):
        places: dict[str, list[int]] = {}
        for n, profile in enumerate(profiles):
            if profile.strict == strict and profile.category is not None:
                places.setdefault(profile.category, []).append(n)
        scope = records.filter(F.col("LGART").isin(list(places)))
        of_category = reduce(
            lambda rest, c: F.when(F.col("LGART") == c, F.array(*map(F.lit, places[c]))).otherwise(rest),
            places, F.lit(None).cast("array<int>"))
        rows = latest_batch_by(scope, strict=strict)
        yield rows.select(*fixed.RECORD_COLUMNS, F.explode(of_category).alias("set_no"))


def _publish(newest: DataFrame, profiles: list[Profile], outs: list[str]) -> DataFrame:
    """Write the rows of each `set_no`; the manifest of all files, with `set_no`."""
    sizes = [p.rows_per_file for p in profiles]
    batched = assign_group_batches(newest.select("set_no", *fixed.RECORD_COLUMNS), "set_no", sizes, ["PERNR"])
    sets = [FileSet(out, p.prefix, p.ext, p.sep) for out, p in zip(outs, profiles)]
    styles: dict[tuple[bool, str], list[int]] = {}
    for n, profile in enumerate(profiles):
        styles.setdefault((profile.formatted, profile.sep), []).append(n)
    line = F.coalesce(*[
        F.when(F.col("set_no").isin(places), csv_line(_cells(formatted), sep))
        for (formatted, sep), places in styles.items()])
    export_file_sets(
        batched.select("set_no", "batch_no", "row_no", line.alias("line")),
        sets, batched.schema["batch_no"].metadata["batches"], fixed.RECORD_COLUMNS)
    manifest = batch_manifest(batched, ["PERNR"], sizes, tuple(fixed.INTEGER_COLUMNS), "set_no")
    ends = F.array(*[F.struct(F.lit(p.prefix).alias("prefix"), F.lit(p.ext).alias("ext")) for p in profiles])
    end = F.element_at(ends, F.col("set_no") + 1)
    return manifest.withColumn("file", F.concat(end["prefix"], F.lit("-"), "batch_no", F.lit("."), end["ext"]))
