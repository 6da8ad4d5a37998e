"""Shared column expressions and Spark helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import global_sum, materialize
from ..sources.tables import read_table

__all__ = ["BLANKS", "global_rank", "global_sum", "let", "materialize",
           "read_table", "text_of", "words"]

# A word is a run of characters other than these six.
BLANKS = " \t\n\x0b\x0c\r"


def text_of(column: str | Column = "text") -> Column:
    """The column as text, null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(text: Column) -> Column:
    """Words of a non-null text, in order; an empty array when it has none."""
    spaced = text
    for blank in BLANKS[1:]:
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    # A one-character pattern needs no regular expression.
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    A lambda that refers to an outer expression evaluates it again for every
    element; a lambda variable is evaluated once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def global_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Add the 1-based global row number in ``order``."""
    return global_sum(df, F.lit(1), *order, name=name)
