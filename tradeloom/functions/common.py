"""Small argument helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    """A column, or the column of that name."""
    return c if isinstance(c, Column) else F.col(c)


def as_value(v) -> Column:
    """A column as it is, anything else as a literal."""
    return v if isinstance(v, Column) else F.lit(v)


def unpacked(pages: DataFrame, inside: str, name: str, at: str = "_at") -> DataFrame:
    """One row per entry of the array `inside`, with its place `at`; a page without entries gives none.

    The same rows as `posexplode`, for which Catalyst asks in addition whether a page is empty. That
    question goes down to where pages come from, behind or into a join, and builds each page once more.
    """
    return pages.select("*", F.posexplode_outer(inside).alias(at, name)).filter(F.col(at).isNotNull())
