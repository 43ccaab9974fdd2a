"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.functions.common import as_col, as_value

ISO = "yyyy-MM-dd'T'HH:mm:ss"
ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def drop_fraction(c: Column | str) -> Column:
    """Remove fractional seconds in front of a closing Z. Only a text with a point is searched."""
    text = as_col(c)
    return F.when(F.contains(text, F.lit(".")), F.regexp_replace(text, r"\.\d*Z$", "Z")).otherwise(text)


def iso_ts(c: Column | str, zulu: bool = False, fraction: bool = False) -> Column:
    """Naive timestamp of ISO text; the Z, where there is one, is just a letter."""
    text = drop_fraction(c) if fraction else as_col(c)
    return F.to_timestamp_ntz(text, F.lit(ISO_Z if zulu else ISO))


def exact_ts(c: Column | str) -> Column:
    """Naive timestamp of ISO text with its fraction, if any; the Z is just a letter. For ordering only."""
    text = as_col(c)
    bare = F.when(F.endswith(text, F.lit("Z")), F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(F.regexp_replace(text, "Z$", ""))
    return bare.cast("timestamp_ntz")


def day_start(v) -> Column:
    """Midnight of a date, as a naive timestamp."""
    return as_value(v).cast("date").cast("timestamp_ntz")


def epoch_local(c: Column | str, tz: str) -> Column:
    """Wall-clock time in `tz` of epoch seconds, independent of the session zone."""
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=as_col(c).cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def month_first(c: Column | str) -> Column:
    """First day of a `YYYY-MM` month."""
    return F.to_date(F.concat(as_col(c), F.lit("-01")))


def month_last(c: Column | str) -> Column:
    """Last day of a `YYYY-MM` month, December included."""
    return F.last_day(month_first(c))


def window_start(until, days: int = 45) -> Column:
    """First day of a look-back window."""
    return F.date_sub(as_value(until).cast("date"), days)


def months_back(until, months: int = 3) -> Column:
    return F.add_months(as_value(until).cast("date"), -months)
