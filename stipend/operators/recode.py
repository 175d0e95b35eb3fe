"""Whole-cell replacement of values in every column."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_pass(pairs: Iterable[tuple[str, str]]) -> dict[str, str]:
    """The single replacement that equals making the replacements of `pairs` one after another."""
    result: dict[str, str] = {}
    for old, new in pairs:
        result = {source: new if target == old else target for source, target in result.items()}
        result.setdefault(old, new)
    return result


def recode(
    df: DataFrame, pairs: Iterable[tuple[str, str]], null_text: str | None = None
) -> DataFrame:
    """All columns as text, with each cell that equals a source value replaced by its target.

    Cells are compared as a whole and by case. Nulls stay null unless `null_text` is given. Each
    cell is one lookup in a constant map, however many pairs there are.
    """
    mapping = one_pass(pairs)
    targets = F.create_map(*[F.lit(text) for pair in mapping.items() for text in pair])

    def recoded(name):
        cell = F.col(f"`{name}`").cast("string")
        if null_text is not None:
            cell = F.coalesce(cell, F.lit(null_text))
        return (F.coalesce(targets[cell], cell) if mapping else cell).alias(name)

    return df.select(*[recoded(name) for name in df.columns])
