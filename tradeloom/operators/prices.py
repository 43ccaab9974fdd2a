"""Competitor prices: products, their sources and the offers of a source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.common import as_value
from tradeloom.functions.numbers import available, price_before_discount
from tradeloom.functions.times import epoch_local
from tradeloom.operators.lookup import offer_ids
from tradeloom.sources.schemas import PRICE_OFFER

# Columns of the staged price rows, in order.
COLUMNS = [
    "transaction_id", "client_code", "name", "articul", "category_name", "brand_name", "default_price",
    "company_id", "company_name", "region_name", "price", "in_stock", "discount_type", "discount", "offer_name",
    "offer_id", "date", "last_check_date", "original_price", "date_create", "card_price",
]


def price_offers(pages: DataFrame, run_id, run_ts, tz: str = "Europe/Moscow") -> DataFrame:
    """One row per offer; a source without offers stands in for itself if it has a price.

    Sources without a company (false or zero) are dropped. Such a stand-in has
    no dates and no card price. `tz` is the zone the dates are shown in. Only the
    last explode drops rows: a missing product or source has no offers either.
    """
    objects = pages.select(F.explode_outer("result.objects").alias("o"))
    sources = objects.select("o", F.explode_outer("o.sources").alias("s")) \
        .filter(~F.coalesce(F.lower("s.company_id"), F.lit("")).isin("false", "0"))
    s = F.col("s")
    stand_in = F.struct(
        s["price"].alias("price"), s["in_stock"].alias("in_stock"), s["discount_type"].alias("discount_type"),
        s["discount"].alias("discount"), s["company_name"].alias("offer"), F.lit(None).alias("date"),
        F.lit(None).alias("last_check_date"), F.lit(None).alias("data"),
    ).cast(PRICE_OFFER)
    offers = F.when(F.size("s.offers") > 0, F.col("s.offers")) \
        .when(s["price"].isNotNull(), F.array(stand_in))
    rows = sources.select("o", "s", F.explode(offers).alias("f"))
    card_at = F.array_position(F.col("f.data.key"), "card_price")
    values = {
        **{c: F.col("o").getField(c) for c in ("client_code", "name", "articul", "category_name", "brand_name",
                                               "default_price")},
        **{c: s[c] for c in ("company_id", "company_name", "region_name")},
        **{c: F.col("f").getField(c) for c in ("price", "discount_type", "discount")},
        "transaction_id": as_value(run_id),
        "in_stock": available("f.in_stock"),
        "offer_name": F.col("f.offer"),
        "date": epoch_local("f.date", tz),
        "last_check_date": epoch_local("f.last_check_date", tz),
        "original_price": price_before_discount("f.price", "f.discount_type", "f.discount"),
        "date_create": as_value(run_ts).cast("timestamp_ntz"),
        "card_price": F.try_element_at(F.col("f.data.value"), F.nullif(card_at, F.lit(0)).cast("int")),
    }
    return rows.select(*[values[c].alias(c) for c in COLUMNS if c != "offer_id"])


def priced_rows(rows: DataFrame, offers: DataFrame) -> DataFrame:
    """Price rows with their offer id, in staged order."""
    return offer_ids(rows, offers).select(*COLUMNS)
