"""Ozon and KZ stock, nested or delimited feeds to staged rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.common import as_value, unpacked
from tradeloom.functions.text import before, comma_number, upper_or_none
from tradeloom.operators.lookup import require
from tradeloom.operators.products import owner_columns

# Staged columns with their types, in order.
OZON_COLUMNS = {
    "owner": "string", "date": "date", "sku": "string", "method": "string", "category": "string",
    "currency": "string", "base_price": "double", "discount_price": "double", "premium_price": "double",
    "ozon_card_price": "double", "name": "string", "brand": "string", "seller": "string",
    "warehouse": "string", "warehouse_region": "string", "warehouse_id": "string", "quantity": "int",
    "transaction_id": "bigint", "barcode": "string",
}
# KZ export header -> staged column and how its value is read.
KZ_COLUMNS = [
    ("name", "Наименование", "text"),
    ("barcode", "Штрихкод", "text"),
    ("sku", "SKU", "text"),
    ("org", "SKU", "before dash"),
    ("item_id", "ID товара", "text"),
    ("qnt_to_send", "К отправке", "text"),
    ("qnt_in_sale", "В продаже", "text"),
    ("qnt_to_return", "Возврат", "text"),
    ("qnt_defective", "Брак", "text"),
    ("cost", "Себест. (руб.)", "number"),
    ("price", "Стоимость продажи (руб.)", "number"),
    ("qnt", "Общий остаток", "whole"),
    ("cost_total", "Общая сумма остатков (руб.)", "number"),
    ("price_total", "Себест. (сумма) (руб.)", "number"),
    ("price_sale", "Стоимость продажи (сумма) (руб.)", "number"),
    ("qnt_sdh", "Остаток на СДХ", "whole"),
    ("qnt_foto", "Остаток на фотостудии", "whole"),
    ("price_sdh", "Остаток на СДХ (сумма) (руб.)", "number"),
    ("qnt_available_to_send", "Доступно к отправке", "whole"),
]
# The three totals are loaded under each other's names; this puts each under its own.
KZ_TOTALS_BY_MEANING = {
    "cost_total": "Себест. (сумма) (руб.)",
    "price_total": "Общая сумма остатков (руб.)",
    "price_sale": "Стоимость продажи (сумма) (руб.)",
}


def _conform(df: DataFrame, values: dict) -> DataFrame:
    return df.select(*[
        values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in OZON_COLUMNS.items()
    ])


def _codes(pages: DataFrame, barcodes: DataFrame) -> tuple[DataFrame, list[str]]:
    """Barcodes by text SKU, and the columns they are looked up by."""
    by = [c for c in owner_columns(pages) if c in barcodes.columns]
    return barcodes.select(*by, F.col("sku").cast("string").alias("sku"), "barcode"), [*by, "sku"]


def seller_stock_lines(pages: DataFrame, barcodes: DataFrame, owner, run_id, stock_date) -> DataFrame:
    """Seller-stats stock, one row per SKU and warehouse; every SKU must have a barcode entry.

    `barcodes` holds one row per `sku`, or per owner and SKU where it names the owner as the pages do.
    """
    items = pages.select("*", F.explode_outer("result").alias("item")).drop("result") \
        .select("*", F.explode("item.stock").alias("cell"), F.col("item.sku").cast("string").alias("sku"))
    found = require(items, *_codes(pages, barcodes))
    item, cell = F.col("item"), F.col("cell")
    values = {
        "owner": as_value(owner), "date": as_value(stock_date), "sku": F.col("sku"),
        "category": item["category"]["name"], "method": item["method"],
        "quantity": cell["quantity"], "transaction_id": as_value(run_id), "barcode": F.col("barcode"),
        "warehouse": upper_or_none(cell["warehouse"]["name"]),
        "warehouse_region": cell["warehouse"]["region"], "warehouse_id": cell["warehouse"]["id"],
    }
    for name in ("currency", "base_price", "discount_price", "premium_price", "ozon_card_price"):
        values[name] = item["price"][name]
    for name in ("name", "brand", "seller"):
        values[name] = item["info"][name]
    return _conform(found, values)


def analytics_stock_lines(pages: DataFrame, barcodes: DataFrame, owner, run_id, stock_date) -> DataFrame:
    """Analytics stock in the same columns; a SKU may lack a barcode."""
    rows = unpacked(pages, "result.rows", "r").drop("result", "_at") \
        .withColumn("sku", F.col("r.sku").cast("string"))
    codes, on = _codes(pages, barcodes)
    found = rows.join(codes, on, "left")
    return _conform(found, {
        "owner": as_value(owner), "date": as_value(stock_date), "sku": F.col("sku"),
        "name": F.col("r.item_name"), "warehouse": upper_or_none("r.warehouse_name"),
        "quantity": F.col("r.free_to_sell_amount"), "transaction_id": as_value(run_id),
        "barcode": F.col("barcode"),
    })


def older_stock_lines(pages: DataFrame, owner, stock_date) -> DataFrame:
    """Analytics stock in the older nine columns."""
    r = F.col("r")
    return unpacked(pages, "result.rows", "r").select(
        r["sku"].alias("sku"), r["item_code"].alias("item_code"), r["item_name"].alias("item_name"),
        r["free_to_sell_amount"].alias("free_to_sell"), r["promised_amount"].alias("promised"),
        r["reserved_amount"].alias("reserved"), upper_or_none(r["warehouse_name"]).alias("warehouse"),
        as_value(owner).alias("owner"), as_value(stock_date).cast("date").alias("create_at"),
    )


def kz_stock_lines(rows: DataFrame, owner, run_id, stock_date, fix_names: bool = False) -> DataFrame:
    """KZ stock in 22 columns; a number that does not parse fails the job.

    The three totals keep their customary places; `fix_names` puts each total
    under the name that fits its meaning.
    """
    read = {
        "text": F.col, "before dash": before, "number": comma_number,
        "whole": lambda c: F.trim(F.col(c)).cast("int"),
    }
    moved = KZ_TOTALS_BY_MEANING if fix_names else {}
    return rows.select(
        as_value(owner).alias("owner"), as_value(stock_date).cast("date").alias("stock_date"),
        *[read[how](f"`{moved.get(name, key)}`").alias(name) for name, key, how in KZ_COLUMNS],
        as_value(run_id).alias("transaction_id"),
    )
