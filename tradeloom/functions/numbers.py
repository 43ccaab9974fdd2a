"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.functions.common import as_col

MONEY = "decimal(18,2)"


def money(c: Column | str) -> Column:
    return as_col(c).cast(MONEY)


def price_before_discount(price: Column | str, kind: Column | str, discount: Column | str) -> Column:
    """Kind 0 is a per cent discount, any other kind an amount."""
    price, discount = as_col(price), as_col(discount)
    share = price * (F.lit(1.0) + discount / F.lit(100.0))
    return F.when(F.coalesce(as_col(kind) == 0, F.lit(False)), share).otherwise(price + discount)


def available(c: Column | str) -> Column:
    """Only the number one means available."""
    return F.coalesce(as_col(c) == 1, F.lit(False))


def whole(c: Column | str) -> Column:
    """Whole part of a sheet number; sheets hold every number as a float. Ids keep all their digits."""
    return as_col(c).cast("decimal(38,9)").cast("bigint")


def max_or_zero(c: Column | str) -> Column:
    return F.coalesce(F.max(as_col(c)), F.lit(0))
