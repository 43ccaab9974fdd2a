"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.functions.common import as_col

NIL_UUID = "00000000-0000-0000-0000-000000000000"


def upper_or_none(c: Column | str) -> Column:
    """Upper-case a name; a missing one becomes the text NONE."""
    return F.upper(F.coalesce(as_col(c), F.lit("None")))


def blank_to_null(c: Column | str) -> Column:
    """Blank text is no value."""
    c = as_col(c)
    return F.when(F.trim(c) != "", c)


def is_blank(c: Column | str) -> Column:
    return F.trim(F.coalesce(as_col(c), F.lit(""))) == ""


def pair_part(c: Column | str, index: int, strict: bool = True, sep: str = "/") -> Column:
    """Part `index` (1-based) of a separated pair.

    Strict raises where the part is missing, lenient gives null.
    """
    parts = F.split(as_col(c), f"\\{sep}", -1)
    part = F.try_element_at(parts, F.lit(index))
    if not strict:
        return part
    problem = F.raise_error(F.concat(F.lit(f"no part {index} in value: "), F.coalesce(as_col(c), F.lit("null"))))
    return F.coalesce(part, problem.cast("string"))


def before(c: Column | str, sep: str = "-") -> Column:
    """Text before the first separator, or all of it."""
    return F.substring_index(as_col(c), sep, 1)


def comma_number(c: Column | str, kind: str = "double") -> Column:
    """Number written with a decimal comma."""
    return F.replace(as_col(c), F.lit(","), F.lit(".")).cast(kind)


def comma_number_or_zero(c: Column | str, kind: str = "double") -> Column:
    """Decimal-comma number; a missing or blank one is zero."""
    return F.when(is_blank(c), F.lit(0).cast(kind)).otherwise(comma_number(c, kind))


def unquoted(c: Column | str) -> Column:
    """Drop double quotes, then outer blanks."""
    return F.trim(F.replace(as_col(c), F.lit('"'), F.lit("")))


def names_any(c: Column | str, markers: list[str]) -> Column:
    """True where the text holds one of the markers, whatever the case."""
    low = F.lower(as_col(c))
    found = F.lit(False)
    for marker in markers:
        found = found | F.contains(low, F.lit(marker.lower()))
    return found


def name_id(c: Column | str) -> Column:
    """Identifier in UUID shape, derived from the trimmed name.

    A task that runs again gives the same id, which a random one would not.
    """
    h = F.sha2(F.trim(as_col(c)), 256)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(h, start, size) for start, size in cuts])
