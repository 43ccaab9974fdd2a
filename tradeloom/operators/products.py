"""Product catalogue: attributes, SKU expansion and staged product rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.common import as_value
from tradeloom.operators.dedup import first_wins, last_wins
from tradeloom.operators.lookup import require

# Attribute ids of the catalogue.
ATTRIBUTES = {"brand": 85, "category": 8229}

# Columns of the staged product rows, in order.
COLUMNS = [
    "owner_code", "barcode", "created_at", "sku", "marketing_price", "min_ozon_price", "min_price", "offer_id",
    "old_price", "premium_price", "price", "name", "brand", "category", "transaction_id",
]

_ORDER = ["page", "item_no", "part_no"]


def owner_columns(pages: DataFrame) -> list[str]:
    """What tells owners apart on pages that were landed for several of them at once."""
    return [c for c in ("source", "owner") if c in pages.columns]


def pick_attributes(pages: DataFrame, ids: dict[str, int] | None = None, key: str = "id") -> DataFrame:
    """One row per owner and product of a page with the wanted attributes.

    An attribute is the first value of the last entry with its id that has
    values. `key` names the id inside an entry; older pages say `attribute_id`.
    """
    def pick(wanted: int) -> Column:
        entries = F.filter(F.col("item.attributes"),
                           lambda a: (a[key] == wanted) & (F.size(a["values"]) > 0))
        return F.try_element_at(F.try_element_at(entries, F.lit(-1))["values"], F.lit(1))["value"]

    by = owner_columns(pages)
    found = pages.select(*by, "page", F.posexplode("result").alias("item_no", "item"))
    wanted = ids or ATTRIBUTES
    return found.select(*by, "page", "item_no", F.col("item.id").alias("id"),
                        *[pick(v).alias(name) for name, v in wanted.items()])


def last_attributes(picked: DataFrame) -> DataFrame:
    """One row per owner and product: the last one delivered."""
    return last_wins(picked, [*owner_columns(picked), "id"], ["page", "item_no"]).drop("page", "item_no")


def items(pages: DataFrame) -> DataFrame:
    """Product items with their owner, page and position."""
    return pages.select(*owner_columns(pages), "page", F.posexplode("result.items").alias("item_no", "item"))


def expand_skus(item_rows: DataFrame, fbo_only: bool = False) -> DataFrame:
    """One row per SKU: an item without one stands for its FBO and its FBS SKU.

    The older job knew the FBO SKU only.
    """
    pair = [F.col("item.fbo_sku")] if fbo_only else [F.col("item.fbo_sku"), F.col("item.fbs_sku")]
    skus = F.when(F.col("item.sku") == 0, F.array(*pair)).otherwise(F.array(F.col("item.sku")))
    return item_rows.select("*", F.posexplode(skus).alias("part_no", "sku"))


def product_rows(pages: DataFrame, attributes: DataFrame, owner, run_id, fbo_only: bool = False) -> DataFrame:
    """Staged product rows, the first of each owner and SKU; an item without attributes is an error.

    Every item is looked up, also one whose SKUs another item has taken. `owner` is a value, or the
    column that tells the owners of the pages apart.
    """
    by = owner_columns(pages)
    found = require(items(pages).withColumn("id", F.col("item.id")), attributes, [*by, "id"])
    every = first_wins(expand_skus(found, fbo_only), [*by, "sku"], _ORDER)
    outside = {
        "owner_code": as_value(owner), "transaction_id": as_value(run_id),
        "sku": F.col("sku"), "brand": F.col("brand"), "category": F.col("category"),
    }
    inside = {c: F.col("item").getField(c) for c in COLUMNS if c not in outside}
    return every.select(*[{**inside, **outside}[c].alias(c) for c in COLUMNS])


def sku_barcodes(pages: DataFrame) -> DataFrame:
    """Barcode per owner and SKU as text; the last delivered item wins."""
    by = owner_columns(pages)
    every = expand_skus(items(pages)).select(
        *by, *_ORDER, F.col("sku").cast("string").alias("sku"), F.col("item.barcode").alias("barcode"))
    return last_wins(every, [*by, "sku"], _ORDER).select(*by, "sku", "barcode")


def product_ids(pages: DataFrame) -> DataFrame:
    """Distinct product ids of the id pages, per owner."""
    return pages.select(*owner_columns(pages), F.explode("result.items.product_id").alias("product_id")).distinct()
