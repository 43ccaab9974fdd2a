"""ERP dictionaries, stock and price list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.common import as_value, unpacked
from tradeloom.functions.text import NIL_UUID, comma_number_or_zero, is_blank, names_any, unquoted
from tradeloom.operators.dedup import first_wins

# Words that mark a price list entry as out of use.
OBSOLETE = ["устарел", "не использовать"]


#: Where a row was delivered; staged beside it where the last one delivered is to win.
PLACE = ("page", "item_no")


def _items(pages: DataFrame, placed: bool = False) -> DataFrame:
    if not placed:
        return unpacked(pages, "items", "i").select("i.*")
    return unpacked(pages, "items", "i", "item_no").select(*PLACE, "i.*")


def item_rows(pages: DataFrame, run_id, placed: bool = False) -> DataFrame:
    """Items; marketplaces have the same columns."""
    return _items(pages, placed).select(
        "id", "name", F.col("updateAt").alias("update_at"), as_value(run_id).alias("transaction_id"), *(PLACE if placed else ()))


def organization_rows(pages: DataFrame, run_id) -> DataFrame:
    return _items(pages).select(
        "id", "name", "inn", "kpp", F.col("updateAt").alias("update_at"), as_value(run_id).alias("transaction_id"))


def barcode_rows(pages: DataFrame, run_id, placed: bool = False) -> DataFrame:
    """Barcodes; entries with the nil id are dropped, a blank retail price is zero."""
    kept = _items(pages, placed).filter(F.coalesce(F.col("barcodeID") != NIL_UUID, F.lit(True)))
    return kept.select(
        F.col("id").alias("item_id"), F.col("barcodeID").alias("barcode_id"), "barcode",
        F.col("orgId").alias("org_id"), F.col("marketId").alias("market_id"),
        unquoted("article").alias("article"), comma_number_or_zero("RRC").alias("rrc"),
        as_value(run_id).alias("transaction_id"), *(PLACE if placed else ()),
    )


def stock_rows(pages: DataFrame, run_id, stock_date) -> DataFrame:
    """Stock of items that have an id."""
    return _items(pages).filter(~is_blank("id")).select(
        as_value(run_id).alias("transaction_id"), as_value(stock_date).cast("date").alias("stock_date"),
        F.col("id").alias("item_id"), "quantity",
    )


def barcode_prices(pages: DataFrame, run_id, run_ts, obsolete: list[str] | None = None) -> DataFrame:
    """Price list by barcode: the first entry of a barcode wins.

    Barcodes are trimmed before they are compared. Obsolete entries are dropped
    first, so they cannot hide a live one.
    """
    entries = pages.select("page", F.posexplode("`Данные`").alias("item_no", "e")).select(
        "page", "item_no", F.col("e.`Номенклатура`").alias("name"), F.col("e.`РРЦ`").alias("rrc"),
        F.col("e.`Дистр`").alias("distr"), F.col("e.`Себестоимость`").alias("net"),
        F.col("e.`Штрихкоды`").alias("barcodes"),
    )
    live = entries.filter(~names_any("name", obsolete or OBSOLETE))
    each = live.select("*", F.posexplode(F.array_distinct("barcodes")).alias("code_no", "code")) \
        .filter(~is_blank("code")).withColumn("barcode", F.trim("code"))
    return first_wins(each, ["barcode"], ["page", "item_no", "code_no"]).select(
        as_value(run_id).alias("transaction_id"), "name", "rrc", "distr", "net", "barcode",
        as_value(run_ts).cast("timestamp_ntz").alias("date_update"),
    )
