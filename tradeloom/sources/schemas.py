"""Schemas of the landed feeds, as Spark DDL.

Numbers that act as keys (SKU, barcode) and may arrive as text or as a number
are declared as strings: JSON numbers are read into them without loss.
"""

from __future__ import annotations

FBO_PAGE = (
    "result array<struct<order_id:bigint, order_number:string, posting_number:string, status:string, created_at:string,"
    " in_process_at:string, products:array<struct<sku:bigint, name:string, quantity:int, offer_id:string, price:string>>,"
    " analytics_data:struct<region:string, city:string, warehouse_name:string, warehouse_id:bigint>,"
    " financial_data:struct<products:array<struct<product_id:bigint, commission_amount:double,"
    " commission_percent:double, payout:double, old_price:double, total_discount_value:double,"
    " total_discount_percent:double, client_price:string>>>>>"
)
FBS_PAGE = (
    "result struct<has_next:boolean, postings:array<struct<order_id:bigint, order_number:string, posting_number:string,"
    " status:string, in_process_at:string,"
    " products:array<struct<sku:bigint, name:string, quantity:int, offer_id:string, price:string>>,"
    " analytics_data:struct<region:string, city:string, warehouse_name:string, warehouse_id:bigint>,"
    " financial_data:struct<products:array<struct<product_id:bigint, commission_amount:double,"
    " commission_percent:double, payout:double, old_price:double, total_discount_value:double,"
    " total_discount_percent:double, client_price:string>>>>>>"
)

PRODUCT_PAGE = (
    "result struct<items:array<struct<id:bigint, sku:bigint, fbo_sku:bigint, fbs_sku:bigint, barcode:string,"
    " created_at:string, marketing_price:string, min_ozon_price:string, min_price:string, offer_id:string,"
    " old_price:string, premium_price:string, price:string, name:string>>>"
)
PRODUCT_ID_PAGE = "result struct<items:array<struct<product_id:bigint>>, last_id:string>"
ATTRIBUTE_PAGE = (
    "result array<struct<id:bigint, attributes:array<struct<id:bigint, values:array<struct<value:string>>>>>>"
)
ATTRIBUTE_PAGE_OLDER = (
    "result array<struct<id:bigint, attributes:array<struct<attribute_id:bigint, values:array<struct<value:string>>>>>>"
)

SELLER_STOCK_PAGE = (
    "result array<struct<sku:string, method:string, category:struct<name:string>,"
    " price:struct<currency:string, base_price:double, discount_price:double, premium_price:double,"
    " ozon_card_price:double>, info:struct<name:string, brand:string, seller:string>,"
    " stock:array<struct<quantity:int, warehouse:struct<name:string, region:string, id:string>>>>>"
)
ANALYTICS_STOCK_PAGE = (
    "result struct<rows:array<struct<sku:string, item_code:string, item_name:string, free_to_sell_amount:int,"
    " promised_amount:int, reserved_amount:int, warehouse_name:string>>>"
)

WB_ORDER = (
    "date string, lastChangeDate string, supplierArticle string, techSize string, barcode string,"
    " totalPrice double, discountPercent double, warehouseName string, regionName string, incomeID bigint,"
    " subject string, category string, brand string, isCancel boolean, cancelDate string, gNumber string,"
    " sticker string, srid string, orderType string, nmId bigint, spp double, finishedPrice double,"
    " priceWithDisc double, countryName string, oblastOkrugName string"
)
WB_SALE = (
    "date string, lastChangeDate string, warehouseName string, countryName string, oblastOkrugName string,"
    " regionName string, supplierArticle string, barcode string, category string, subject string, brand string,"
    " techSize string, incomeID bigint, isSupply boolean, isRealization boolean, totalPrice double,"
    " discountPercent double, spp double, forPay double, finishedPrice double, priceWithDisc double,"
    " saleID string, sticker string, gNumber string, srid variant, nmId bigint"
)
WB_STOCK = (
    "lastChangeDate string, warehouseName string, supplierArticle string, barcode string, quantity int,"
    " inWayToClient int, inWayFromClient int, quantityFull int, category string, subject string, brand string,"
    " Price double, Discount double, isSupply boolean, isRealization boolean, nmId bigint"
)

PRICE_OFFER = (
    "struct<price:double, in_stock:int, discount_type:int, discount:double, offer:string, date:bigint,"
    " last_check_date:bigint, data:array<struct<key:string, value:string>>>"
)
PRICE_PAGE = (
    "result struct<pagination:struct<pages_cnt:int, page:int>, objects:array<struct<client_code:string,"
    " name:string, articul:string, category_name:string, brand_name:string, default_price:double,"
    " sources:array<struct<company_id:string, company_name:string, region_name:string, price:double,"
    f" in_stock:int, discount_type:int, discount:double, offers:array<{PRICE_OFFER}>>>>>>"
)

ERP_ITEM_PAGE = "items array<struct<id:string, name:string, updateAt:string>>"
ERP_BARCODE_PAGE = (
    "items array<struct<id:string, barcodeID:string, barcode:string, orgId:string, marketId:string,"
    " article:string, RRC:string>>"
)
ERP_ORGANIZATION_PAGE = "items array<struct<id:string, name:string, inn:string, kpp:string, updateAt:string>>"
ERP_MARKETPLACE_PAGE = "items array<struct<id:string, name:string, updateAt:string>>"
ERP_STOCK_PAGE = "items array<struct<id:string, quantity:double>>"
ERP_PRICE_PAGE = (
    "`Данные` array<struct<`Номенклатура`:string, `РРЦ`:double, `Дистр`:double, `Себестоимость`:double,"
    " `Штрихкоды`:array<string>>>"
)

# Columns 0-17 of the advertising sheets, read as text.
AD_SHEET = ", ".join(f"c{i} string" for i in range(18))

REALIZATION_PAGE = (
    "result struct<header:struct<num:string, doc_date:string, contract_date:string, contract_num:string,"
    " currency_code:string, doc_amount:double, vat_amount:double, payer_inn:string, payer_kpp:string,"
    " payer_name:string, rcv_inn:string, rcv_kpp:string, rcv_name:string, start_date:string, stop_date:string>,"
    " rows:array<struct<row_number:int, product_id:bigint, product_name:string, barcode:string, offer_id:string,"
    " commission_percent:double, price:double, price_sale:double, sale_amount:double, sale_commission:double,"
    " sale_discount:double, sale_price_seller:double, sale_qty:int, return_sale:double, return_amount:double,"
    " return_commission:double, return_discount:double, return_price_seller:double, return_qty:int>>>"
)

# Feed name -> (schema, file holds one JSON document over many lines)
FEEDS = {
    "fbo": (FBO_PAGE, True),
    "fbs": (FBS_PAGE, True),
    "products": (PRODUCT_PAGE, True),
    "product_ids": (PRODUCT_ID_PAGE, True),
    "attributes": (ATTRIBUTE_PAGE, True),
    "attributes_older": (ATTRIBUTE_PAGE_OLDER, True),
    "seller_stock": (SELLER_STOCK_PAGE, True),
    "analytics_stock": (ANALYTICS_STOCK_PAGE, True),
    "wb_orders": (WB_ORDER, True),
    "wb_sales": (WB_SALE, True),
    "wb_stock": (WB_STOCK, True),
    "prices": (PRICE_PAGE, True),
    "erp_items": (ERP_ITEM_PAGE, True),
    "erp_barcodes": (ERP_BARCODE_PAGE, True),
    "erp_organizations": (ERP_ORGANIZATION_PAGE, True),
    "erp_marketplaces": (ERP_MARKETPLACE_PAGE, True),
    "erp_stock": (ERP_STOCK_PAGE, True),
    "erp_prices": (ERP_PRICE_PAGE, True),
    "realization": (REALIZATION_PAGE, True),
}
