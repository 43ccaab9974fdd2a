"""WB orders, sales and stock, flat documents to staged rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.common import as_value
from tradeloom.functions.text import upper_or_none
from tradeloom.functions.times import iso_ts

# Staged column -> key of the document, in staged order. None marks a computed column.
ORDER_COLUMNS = {
    "date": "date", "owner_code": None, "last_change_date": "lastChangeDate",
    "supplier_article": "supplierArticle", "tech_size": "techSize", "barcode": "barcode",
    "total_price": "totalPrice", "discount_percent": "discountPercent", "warehouse_name": None,
    "oblast": "regionName", "income_id": "incomeID", "odid": None, "subject": "subject",
    "category": "category", "brand": "brand", "is_cancel": "isCancel", "cancel_dt": "cancelDate",
    "g_number": "gNumber", "sticker": "sticker", "srid": "srid", "order_type": "orderType", "nm_id": "nmId",
    "spp": "spp", "finished_price": "finishedPrice", "price_with_disc": "priceWithDisc",
    "country_name": "countryName", "oblast_okrug_name": "oblastOkrugName", "region_name": "regionName",
    "transaction_id": None,
}
SALE_COLUMNS = {
    "date": "date", "owner_code": None, "last_change_date": "lastChangeDate", "warehouse_name": None,
    "country_name": "countryName", "oblast_okrug_name": "oblastOkrugName", "region_name": "regionName",
    "supplier_article": "supplierArticle", "barcode": "barcode", "category": "category", "subject": "subject",
    "brand": "brand", "tech_size": "techSize", "income_id": "incomeID", "is_supply": "isSupply",
    "is_realization": "isRealization", "total_price": "totalPrice", "discount_percent": "discountPercent",
    "spp": "spp", "for_pay": "forPay", "finished_price": "finishedPrice", "price_with_disc": "priceWithDisc",
    "sale_id": "saleID", "sticker": "sticker", "g_number": "gNumber", "odid": None, "srid": "srid",
    "nm_id": "nmId", "transaction_id": None,
}
STOCK_COLUMNS = {
    "transaction_id": None, "owner_code": None, "last_change_date": "lastChangeDate", "warehouse_name": None,
    "supplier_article": "supplierArticle", "barcode": "barcode", "quantity": "quantity",
    "in_way_to_client": "inWayToClient", "in_way_from_client": "inWayFromClient",
    "quantity_full": "quantityFull", "category": "category", "subject": "subject", "brand": "brand",
    "price": "Price", "discount": "Discount", "is_supply": "isSupply", "is_realization": "isRealization",
    "nmId": "nmId", "create_at": None,
}


def _project(docs: DataFrame, columns: dict, owner, run_id, **extra) -> DataFrame:
    computed = {
        "owner_code": as_value(owner), "transaction_id": as_value(run_id), "odid": F.lit(0),
        "warehouse_name": upper_or_none("warehouseName"), **extra,
    }
    return docs.select(*[(F.col(key) if key else computed[name]).alias(name) for name, key in columns.items()])


def recent_orders(docs: DataFrame, since) -> DataFrame:
    """Orders dated on or after `since`; a change to an older order is dropped."""
    return docs.filter(iso_ts("date").cast("date") >= as_value(since).cast("date"))


def known_sales(docs: DataFrame) -> DataFrame:
    """Sales that name an order, with `srid` as text.

    Only the number zero names none; the text "0" and a missing one are kept. The field is read as
    the JSON value it is, as both look alike as text.
    """
    number = F.schema_of_variant("srid") != "STRING"
    zero = F.coalesce(number & (F.try_variant_get("srid", "$", "double") == 0), F.lit(False))
    return docs.filter(~zero).withColumn("srid", F.col("srid").cast("string"))


def order_lines(docs: DataFrame, owner, run_id, since) -> DataFrame:
    return _project(recent_orders(docs, since), ORDER_COLUMNS, owner, run_id)


def sale_lines(docs: DataFrame, owner, run_id, since) -> DataFrame:
    return _project(recent_orders(known_sales(docs), since), SALE_COLUMNS, owner, run_id)


def stock_lines(docs: DataFrame, owner, run_id, stock_date) -> DataFrame:
    return _project(docs, STOCK_COLUMNS, owner, run_id, create_at=as_value(stock_date).cast("date"))
