"""Facts held in the names of landed files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.functions.common import as_col

# Names of posting reports, orders_<scheme>_<from>_<to>.csv
REPORT_NAME = r"orders_(fbo|fbs).*\.csv$"
REPORT_PERIOD = r"orders_(?:fbo|fbs)_(\d{8})_(\d{8})\.csv$"


def base_name(path: Column | str) -> Column:
    return F.substring_index(as_col(path), "/", -1)


def report_scheme(path: Column | str) -> Column:
    """FBO or FBS, or null where the name is not that of a posting report."""
    name = base_name(path)
    scheme = F.regexp_extract(name, "^" + REPORT_NAME, 1)
    return F.upper(F.nullif(scheme, F.lit("")))


def report_period(path: Column | str) -> tuple[Column, Column]:
    """First and last day in the name of a posting report; null where it has none."""
    name = base_name(path)
    return tuple(
        F.to_date(F.nullif(F.regexp_extract(name, "^" + REPORT_PERIOD, i), F.lit("")), "yyyyMMdd")
        for i in (1, 2)
    )
