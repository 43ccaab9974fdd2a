"""Queries over the flattened feeds."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from showcase import feeds
from showcase.registry import query, table
from tradeloom.operators import advertising, erp, postings, prices, products, realization, stock, wb
from tradeloom.operators.dedup import distinct_keys
from tradeloom.operators.lookup import insert_offers, insert_warehouses
from tradeloom.sources import schemas

OWNER, RUN = "SELLER", 7
SINCE = date(1995, 5, 15)
STOCK_DAY = date(2001, 11, 30)

CENTS = "CAST(CAST({} AS DECIMAL(18,2)) AS VARCHAR)"
TIME = "strftime({}, '%Y-%m-%dT%H:%M:%S')"
WH = "CASE WHEN l_tax = 0 THEN 'NONE' ELSE 'WH ' || l_suppkey END"


def _posting_sql(created: str, limit: str, warehouse: str, scheme: str) -> str:
    """Lines of the postings, one branch per place a product has in them."""
    branches = " UNION ALL ".join([
        # the product of the posting itself; line 6 holds it twice
        "SELECT *, l_partkey AS sku, CAST(l_quantity AS INT) AS quantity, l_extendedprice AS p, l_discount AS amount,"
        " 3.0 AS percent FROM l",
        "SELECT *, l_partkey, CAST(l_quantity AS INT), l_extendedprice, l_discount, 3.0 FROM l WHERE l_linenumber = 6",
        "SELECT *, l_partkey, 2, l_discount, l_discount, 3.0 FROM l WHERE l_linenumber = 4",
        "SELECT *, l_partkey + 1, 1, l_tax, l_quantity, 2.0 FROM l WHERE l_linenumber IN (3, 6)",
    ])
    return f"""WITH l AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE {limit} AND l_linenumber <> 7), p AS ({branches})
    SELECT 'SELLER' AS owner_code, l_orderkey AS order_id, o_custkey || '-' || l_orderkey AS order_number,
        l_orderkey || '-' || l_linenumber AS posting_number,
        CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'awaiting' ELSE 'cancelled' END AS status,
        {created} AS created_at, {TIME.format('l_shipdate')} || 'Z' AS in_process_at, sku, 'part ' || sku AS name,
        quantity, 'of-' || l_partkey AS offer_id, {CENTS.format('p')} AS price, o_orderpriority AS region,
        NULLIF(l_returnflag, 'N') AS city, {warehouse} AS warehouse_name, l_suppkey AS warehouse_id,
        CAST(amount AS DOUBLE) AS commission_amount, CAST(percent AS DOUBLE) AS commission_percent,
        l_extendedprice AS payout, sku AS product_id, l_extendedprice AS old_price,
        l_discount AS total_discount_value, l_tax AS total_discount_percent,
        {CENTS.format('l_extendedprice')} AS client_price, 7 AS transaction_id, '{scheme}' AS schema FROM p"""


@query("flatten_postings", _posting_sql(
    f"{TIME.format('o_orderdate')} || CASE WHEN l_linenumber IN (1, 3, 5) THEN '.125Z' ELSE 'Z' END",
    "o_orderdate >= TIMESTAMP '1995-05-15'", WH, "FBO"))
def flatten_postings(spark, sf):
    pages = feeds.fbo(feeds.lines(spark, sf))
    return postings.flatten_fbo(pages, OWNER, RUN, SINCE)


@query("flatten_fbs", _posting_sql(
    f"{TIME.format('l_shipdate')} || 'Z'", "l_shipdate >= TIMESTAMP '1995-05-15'", "'FBS'", "FBS"))
def flatten_fbs(spark, sf):
    pages = feeds.fbs(feeds.lines(spark, sf))
    return postings.flatten_fbs(pages, OWNER, RUN, SINCE)


@query("latest_postings", """
    SELECT l_orderkey || '-' || l_linenumber AS posting_number,
        strftime(max(l_shipdate), '%Y-%m-%dT%H:%M:%SZ') AS in_process_at
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def latest_postings(spark, sf):
    last = postings.latest_postings(feeds.fbo(feeds.lines(spark, sf)))
    return last.select(F.explode("result").alias("p")).select("p.posting_number", "p.in_process_at")


_WB = {
    "supplier_article": "'art-' || l_partkey", "tech_size": "CAST(l_linenumber AS VARCHAR)",
    "barcode": "lpad(CAST(l_partkey AS VARCHAR), 13, '0')", "category": "l_returnflag", "subject": "l_linestatus",
    "brand": "'b' || l_linenumber", "nm_id": "l_partkey", "total_price": "l_extendedprice",
    "discount_percent": "l_discount", "spp": "l_tax", "finished_price": "l_extendedprice * (1 - l_discount)",
    "price_with_disc": "l_extendedprice", "region_name": "'region ' || l_linenumber",
    "oblast": "'region ' || l_linenumber", "income_id": "l_orderkey", "odid": "0", "owner_code": "'SELLER'",
    "date": TIME.format("l_shipdate"), "last_change_date": TIME.format("l_shipdate"), "warehouse_name": WH,
    "is_cancel": "NULLIF(l_returnflag, 'A') = 'R'", "g_number": "'g' || l_orderkey", "sticker": "''",
    "cancel_dt": f"CASE WHEN l_returnflag = 'R' THEN {TIME.format('l_shipdate')} ELSE '0001-01-01T00:00:00' END",
    "srid": "'o' || l_orderkey", "order_type": "'client'", "country_name": "'RU'",
    "oblast_okrug_name": "'okrug ' || l_linenumber", "transaction_id": "7", "is_supply": "l_linestatus = 'O'",
    "is_realization": "l_returnflag = 'A'",
    "for_pay": "CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END",
    "sale_id": "CASE WHEN l_returnflag = 'R' THEN 'R' ELSE 'S' END || l_orderkey",
    "quantity": "CAST(l_quantity AS INT)", "in_way_to_client": "l_linenumber", "in_way_from_client": "0",
    "quantity_full": "CAST(l_quantity AS INT) + l_linenumber", "price": "l_extendedprice", "discount": "l_discount",
    "nmId": "l_partkey", "create_at": "'2001-11-30'",
}


def _wb_sql(columns, where: str, **other: str) -> str:
    values = {**_WB, **other}
    return f"SELECT {', '.join(f'{values[c]} AS {c}' for c in columns)} FROM lineitem WHERE {where}"


@query("wb_order_lines", _wb_sql(wb.ORDER_COLUMNS, "l_shipdate >= TIMESTAMP '1995-05-15'"))
def wb_order_lines(spark, sf):
    return wb.order_lines(feeds.wb_orders(feeds.line_items(spark, sf)), OWNER, RUN, SINCE)


_SALE_SRID = "CASE WHEN l_linenumber = 6 THEN '0' ELSE 'o' || l_orderkey END"


@query("wb_sale_lines", _wb_sql(wb.SALE_COLUMNS, "l_shipdate >= TIMESTAMP '1995-05-15' AND l_linenumber <> 7", srid=_SALE_SRID))
def wb_sale_lines(spark, sf):
    return wb.sale_lines(feeds.wb_sales(feeds.line_items(spark, sf)), OWNER, RUN, SINCE)


@query("wb_stock_lines", _wb_sql(wb.STOCK_COLUMNS, "true"))
def wb_stock_lines(spark, sf):
    return wb.stock_lines(feeds.wb_stock(feeds.line_items(spark, sf)), OWNER, RUN, STOCK_DAY)


@query("ozon_stock_lines", f"""
    WITH c AS (
        SELECT *, CAST(l_quantity AS INT) AS qty, {WH} AS wh, CAST(l_suppkey AS VARCHAR) AS wid FROM lineitem
            WHERE l_linenumber <> 7
        UNION ALL SELECT *, l_linenumber, 'RESERVE', NULL FROM lineitem WHERE l_linenumber IN (3, 6))
    SELECT c_mktsegment AS owner, '2001-11-30' AS date, CAST(l_partkey AS VARCHAR) AS sku, l_linestatus AS method,
        l_returnflag AS category, 'RUB' AS currency, l_extendedprice AS base_price, l_discount AS discount_price,
        l_tax AS premium_price, CAST(NULL AS DOUBLE) AS ozon_card_price, 'part ' || l_partkey AS name,
        l_linestatus AS brand, 's' AS seller, wh AS warehouse, l_returnflag AS warehouse_region, wid AS warehouse_id,
        qty AS quantity, 7 AS transaction_id, 'bc-' || c_mktsegment || p_partkey AS barcode
    FROM c JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""")
def ozon_stock_lines(spark, sf):
    """All owners at once; a SKU has a barcode of its own with each of them."""
    pages = feeds.seller_stock(feeds.owned_lines(spark, sf), "owner")
    return stock.seller_stock_lines(pages, _owned_codes(spark, sf), F.col("owner"), RUN, STOCK_DAY)


def _owned_codes(spark, sf):
    """Barcodes of all owners; the table's size says nothing of theirs, so they must not be broadcast by it."""
    owners = F.explode(F.array(*[F.lit(o) for o in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")]))
    return table(spark, sf, "part").withColumn("owner", owners).selectExpr(
        "owner", "cast(p_partkey as string) as sku", "concat('bc-', owner, p_partkey) as barcode", "p_size").hint("shuffle_hash")


@query("ozon_stock_flat", f"""
    SELECT c_mktsegment AS owner, '2001-11-30' AS date, CAST(l_partkey AS VARCHAR) AS sku, CAST(NULL AS VARCHAR) AS method,
        CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS currency, CAST(NULL AS DOUBLE) AS base_price,
        CAST(NULL AS DOUBLE) AS discount_price, CAST(NULL AS DOUBLE) AS premium_price,
        CAST(NULL AS DOUBLE) AS ozon_card_price, 'part ' || l_partkey AS name, CAST(NULL AS VARCHAR) AS brand,
        CAST(NULL AS VARCHAR) AS seller, {WH} AS warehouse, CAST(NULL AS VARCHAR) AS warehouse_region,
        CAST(NULL AS VARCHAR) AS warehouse_id, CAST(l_quantity AS INT) AS quantity, 7 AS transaction_id,
        'bc-' || c_mktsegment || p_partkey AS barcode
    FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 10) ON l_partkey = p_partkey
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""")
def ozon_stock_flat(spark, sf):
    pages = feeds.analytics_stock(feeds.owned_lines(spark, sf), "owner")
    return stock.analytics_stock_lines(pages, _owned_codes(spark, sf).filter("p_size > 10"), F.col("owner"), RUN, STOCK_DAY)


@query("ozon_stock_older", f"""
    SELECT CAST(l_partkey AS VARCHAR) AS sku, 'c' || l_partkey AS item_code, 'part ' || l_partkey AS item_name,
        CAST(l_quantity AS INT) AS free_to_sell, l_linenumber AS promised, 0 AS reserved, {WH} AS warehouse,
        'SELLER' AS owner, '2001-11-30' AS create_at FROM lineitem""")
def ozon_stock_older(spark, sf):
    return stock.older_stock_lines(feeds.analytics_stock(feeds.line_items(spark, sf)), OWNER, STOCK_DAY)


# One row per SKU of the product pages: the part's own, or its FBO and FBS SKU.
_OWNED_PARTS = """(SELECT * FROM part, (SELECT 'BUILDING' AS owner UNION ALL SELECT 'MACHINERY')
    WHERE owner = 'BUILDING' OR p_size > 5)"""
_SKUS = f"""s AS (SELECT p_partkey + 1 AS sku, 0 AS part_no, * FROM {_OWNED_PARTS}
    UNION ALL SELECT p_partkey + 2, 1, * FROM {_OWNED_PARTS} WHERE p_size <= 10)"""
_OWN_CODE = "concat('bc-', owner, p_partkey)"
_BRAND = "p_brand"
_CATEGORY = "CASE WHEN p_size <= 5 THEN NULL ELSE p_type END"


@query("product_rows", f"""
    WITH {_SKUS}, f AS (SELECT *, row_number() OVER (PARTITION BY owner, sku ORDER BY p_partkey, part_no) AS rn FROM s)
    SELECT owner AS owner_code, 'bc-' || owner || p_partkey AS barcode, '2024-01-01T00:00:00Z' AS created_at, sku,
        {CENTS.format('p_retailprice')} AS marketing_price, '' AS min_ozon_price, '' AS min_price,
        'of-' || p_partkey AS offer_id, {CENTS.format('p_retailprice + 10')} AS old_price, '' AS premium_price,
        {CENTS.format('p_retailprice')} AS price, p_name AS name, {_BRAND} AS brand, {_CATEGORY} AS category,
        7 AS transaction_id
    FROM f WHERE rn = 1""")
def product_rows(spark, sf):
    """Two owners at once; they share SKUs and keep their own first row of each.

    One task reads a file of many parts, whose documents are many times as large, so the parts are dealt to tasks first.
    """
    part = feeds.owned_parts(spark, sf).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    found = products.last_attributes(products.pick_attributes(feeds.attributes(part, "id", "owner")))
    return products.product_rows(feeds.products(part, "owner", barcode=_OWN_CODE), found, F.col("owner"), RUN)


_PICKED = f"SELECT p_partkey + 1000000000 AS id, {_BRAND} AS brand, {_CATEGORY} AS category FROM part"


@query("product_attributes", _PICKED)
def product_attributes(spark, sf):
    return products.last_attributes(products.pick_attributes(feeds.attributes(table(spark, sf, "part"))))


@query("product_attributes_older", _PICKED)
def product_attributes_older(spark, sf):
    key = "attribute_id"
    return products.last_attributes(products.pick_attributes(feeds.attributes(table(spark, sf, "part"), key), key=key))


@query("sku_expand_dedup", f"""
    WITH {_SKUS} SELECT owner, CAST(sku AS VARCHAR) AS sku,
        'bc-' || owner || max(p_partkey) AS barcode FROM s GROUP BY owner, sku""")
def sku_expand_dedup(spark, sf):
    return products.sku_barcodes(feeds.products(feeds.owned_parts(spark, sf), "owner", barcode=_OWN_CODE))


@query("product_ids", "SELECT DISTINCT c_mktsegment AS owner, l_partkey AS product_id FROM lineitem"
                      " JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey")
def product_ids(spark, sf):
    """Ids of the id pages, per owner; pages repeat them."""
    items = F.array(F.struct(F.col("l_partkey").alias("product_id")))
    pages = feeds.owned_lines(spark, sf).select("owner", F.struct(items.alias("items")).alias("result"))
    return products.product_ids(pages)


@query("sku_expand_older", "SELECT p_partkey + 1 AS sku, 'bc-' || p_partkey AS barcode FROM part")
def sku_expand_older(spark, sf):
    every = products.expand_skus(products.items(feeds.products(table(spark, sf, "part"))), fbo_only=True)
    return every.select("sku", "item.barcode")


@query("sku_union", """
    SELECT CAST(l_partkey AS VARCHAR) AS sku FROM lineitem
    UNION SELECT CAST(l_partkey + 1 AS VARCHAR) FROM lineitem WHERE l_linenumber IN (3, 6)
    UNION SELECT CAST(p_partkey AS VARCHAR) FROM part""")
def sku_union(spark, sf):
    line = table(spark, sf, "lineitem")
    ordered = line.select(F.col("l_partkey").alias("sku"))
    added = line.filter("l_linenumber in (3, 6)").select((F.col("l_partkey") + 1).alias("sku"))
    catalogue = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("sku"))
    return distinct_keys(ordered, added, catalogue)


@query("sale_warehouses", f"SELECT DISTINCT {WH} AS warehouse_name FROM lineitem WHERE l_linenumber <> 7"
                          " AND l_shipdate >= TIMESTAMP '1995-05-15'")
def sale_warehouses(spark, sf):
    rows = wb.sale_lines(feeds.wb_sales(feeds.line_items(spark, sf)), OWNER, RUN, SINCE)
    return distinct_keys(rows, key="warehouse_name")


@query("erp_barcodes", f"""
    SELECT CAST(p_partkey AS VARCHAR) AS item_id, 'id-' || p_partkey AS barcode_id, 'bc-' || p_partkey AS barcode,
        'org' AS org_id, p_brand AS market_id, p_name AS article,
        CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 0.0 ELSE p_retailprice END AS rrc, 7 AS transaction_id
    FROM part WHERE p_type <> 'PROMO'""")
def erp_barcodes(spark, sf):
    item = f"""named_struct('id', cast(p_partkey as string), 'barcodeID', if(p_type = 'PROMO',
        '00000000-0000-0000-0000-000000000000', concat('id-', p_partkey)), 'barcode', concat('bc-', p_partkey),
        'orgId', 'org', 'marketId', p_brand, 'article', concat(' "', p_name, '" '),
        'RRC', case p_type when 'SMALL' then null when 'LARGE' then ' '
            else replace({feeds.CENTS.format('p_retailprice')}, '.', ',') end)"""
    return erp.barcode_rows(feeds.erp_pages(table(spark, sf, "part"), item, schemas.ERP_BARCODE_PAGE), RUN)


@query("erp_items", """SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, '2024-01-01' AS update_at,
    7 AS transaction_id FROM part""")
def erp_items(spark, sf):
    item = "named_struct('id', cast(p_partkey as string), 'name', p_name, 'updateAt', '2024-01-01')"
    return erp.item_rows(feeds.erp_pages(table(spark, sf, "part"), item, schemas.ERP_ITEM_PAGE), RUN)


@query("erp_organizations", """SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name,
    CAST(s_nationkey AS VARCHAR) AS inn, CAST(NULL AS VARCHAR) AS kpp, '2024-01-01' AS update_at,
    7 AS transaction_id FROM supplier""")
def erp_organizations(spark, sf):
    item = """named_struct('id', cast(s_suppkey as string), 'name', s_name, 'inn', cast(s_nationkey as string),
        'kpp', cast(null as string), 'updateAt', '2024-01-01')"""
    pages = feeds.erp_pages(table(spark, sf, "supplier"), item, schemas.ERP_ORGANIZATION_PAGE)
    return erp.organization_rows(pages, RUN)


@query("erp_marketplaces", """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, '2024-01-01' AS update_at,
    7 AS transaction_id FROM customer""")
def erp_marketplaces(spark, sf):
    item = "named_struct('id', cast(c_custkey as string), 'name', c_name, 'updateAt', '2024-01-01')"
    pages = feeds.erp_pages(table(spark, sf, "customer"), item, schemas.ERP_MARKETPLACE_PAGE)
    return erp.item_rows(pages, RUN)


@query("erp_stock", """SELECT 7 AS transaction_id, '2001-11-30' AS stock_date, CAST(l_partkey AS VARCHAR) AS item_id,
    l_quantity AS quantity FROM lineitem WHERE l_returnflag = 'A'""")
def erp_stock(spark, sf):
    item = """named_struct('id', case l_returnflag when 'A' then cast(l_partkey as string) when 'N' then ' ' end,
        'quantity', l_quantity)"""
    return erp.stock_rows(feeds.erp_pages(feeds.line_items(spark, sf), item, schemas.ERP_STOCK_PAGE), RUN, STOCK_DAY)


@query("barcode_prices", """
    WITH b AS (SELECT 'bc-' || p_partkey AS barcode, 0 AS code_no, * FROM part WHERE p_type <> 'ECONOMY'
        UNION ALL SELECT 'bc-' || (p_partkey + 1), 1, * FROM part WHERE p_type <> 'ECONOMY'),
    f AS (SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY p_partkey, code_no) AS rn FROM b)
    SELECT 7 AS transaction_id, p_name AS name, p_retailprice AS rrc, p_retailprice - 1 AS distr,
        p_retailprice - 2 AS net, barcode, '2024-02-01 06:00:00' AS date_update FROM f WHERE rn = 1""")
def barcode_prices(spark, sf):
    return erp.barcode_prices(feeds.erp_prices(table(spark, sf, "part")), RUN, datetime(2024, 2, 1, 6))


def _kz_sql(cost_total: str, price_total: str) -> str:
    return f"""SELECT 'SELLER' AS owner, '2001-11-30' AS stock_date, 'part ' || l_partkey AS name,
        lpad(CAST(l_partkey AS VARCHAR), 13, '0') AS barcode,
        CASE WHEN l_linenumber = 7 THEN 'NODASH'
            ELSE 'ORG' || l_suppkey || '-' || l_partkey || '-' || l_linenumber END AS sku,
        CASE WHEN l_linenumber = 7 THEN 'NODASH' ELSE 'ORG' || l_suppkey END AS org,
        CAST(l_partkey AS VARCHAR) AS item_id, CAST(l_linenumber AS VARCHAR) AS qnt_to_send, '1' AS qnt_in_sale,
        '0' AS qnt_to_return, '0' AS qnt_defective, l_tax AS cost, l_extendedprice AS price,
        CAST(l_quantity AS INT) AS qnt, {cost_total} AS cost_total, {price_total} AS price_total,
        CAST({CENTS.format('l_extendedprice + 3')} AS DOUBLE) AS price_sale, 4 AS qnt_sdh, 0 AS qnt_foto,
        l_discount AS price_sdh, 2 AS qnt_available_to_send, 7 AS transaction_id FROM lineitem"""


_SUM_STOCK = f"CAST({CENTS.format('l_extendedprice + 1')} AS DOUBLE)"
_SUM_COST = f"CAST({CENTS.format('l_extendedprice + 2')} AS DOUBLE)"


@query("kz_stock", _kz_sql(_SUM_STOCK, _SUM_COST))
def kz_stock(spark, sf):
    return stock.kz_stock_lines(feeds.kz_stock(feeds.line_items(spark, sf)), OWNER, RUN, STOCK_DAY)


@query("kz_stock_by_meaning", _kz_sql(_SUM_COST, _SUM_STOCK))
def kz_stock_by_meaning(spark, sf):
    rows = feeds.kz_stock(feeds.line_items(spark, sf))
    return stock.kz_stock_lines(rows, OWNER, RUN, STOCK_DAY, fix_names=True)


@query("ad_traffic", f"""
    SELECT strftime(ts, '%Y-%m-%d') AS date, event_type AS source, 'cpc' AS medium, 'campaign ' || user_id AS campaign,
        CASE WHEN event_type <> 'view' THEN event_type END AS content,
        CASE WHEN event_type <> 'click' THEN 'term' END AS term, CAST(user_id AS INT) AS sessions,
        CAST(event_id AS INT) AS followers, CAST(trunc(value) AS INT) AS add_to_basket, 2 AS add_to_favorites,
        3 AS cancel, CAST(trunc(value * 2) AS INT) AS session_duration, 1 AS ordered_qnt,
        CAST({CENTS.format('value')} AS DOUBLE) AS sum_cost, CAST({CENTS.format('value + 1')} AS DOUBLE) AS sum_price,
        5 AS range_attr_qnt, CAST(NULL AS DOUBLE) AS range_attr_sum_cost,
        CAST({CENTS.format('value + 2')} AS DOUBLE) AS range_attr_sum_price, strftime(ts, '%Y-%m-%d') AS report_date,
        'SELLER' AS owner_code, 'doc' AS doc_uuid FROM events""")
def ad_traffic(spark, sf):
    return advertising.traffic_rows(feeds.ad_traffic(table(spark, sf, "events")), OWNER, "doc")


_AD_ORDERS = f"""
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS report_date, l_linenumber AS id_com_category,
        l_returnflag AS category_name, CAST(l_partkey AS VARCHAR) AS sku, 'part ' || l_partkey AS name,
        CAST(l_suppkey AS INT) AS seller_id, 'seller ' || l_suppkey AS seller_name, CAST(l_partkey AS INT) AS brand_id,
        'brand ' || l_partkey AS brand_name, l_linestatus AS source, 'organic' AS medium, 'c' AS campaign,
        CASE WHEN l_tax <> 0 THEN 'content' END AS content, 'term' AS term, CAST(l_quantity AS INT) AS ordered_qnt,
        CAST({CENTS.format('l_extendedprice')} AS DOUBLE) AS sum_price, CAST({CENTS.format('l_tax')} AS DOUBLE)
        AS sum_cost, l_linenumber AS range_attr_qnt, CAST({CENTS.format('l_discount')} AS DOUBLE)
        AS range_attr_sum_price, CAST(NULL AS DOUBLE) AS range_attr_sum_cost,
        strftime(l_shipdate, '%Y-%m-%d') AS date, 'SELLER' AS owner_code, 'doc' AS doc_uuid FROM lineitem"""


@query("ad_orders", _AD_ORDERS)
def ad_orders(spark, sf):
    return advertising.order_rows(feeds.ad_orders(feeds.line_items(spark, sf)), OWNER, "doc")


_SHOP_ID = """CASE WHEN trim(offer_name) = '' THEN NULL ELSE
    substr(sha256(trim(offer_name)), 1, 8) || '-' || substr(sha256(trim(offer_name)), 9, 4) || '-' ||
    substr(sha256(trim(offer_name)), 13, 4) || '-' || substr(sha256(trim(offer_name)), 17, 4) || '-' ||
    substr(sha256(trim(offer_name)), 21, 12) END"""
# Offers of the lines: two of the full source, or the stand-in of a source without offers.
_OFFERS = f"""src AS (
    SELECT *, CAST(l_suppkey + 1 AS VARCHAR) AS company_id, ' shop ' || l_suppkey AS offer_name, 0 AS discount_type,
        l_discount AS discount, l_linenumber = 1 AS in_stock, true AS dated, {CENTS.format('l_tax')} AS card_price
        FROM lineitem WHERE l_linenumber NOT IN (5, 7)
    UNION ALL SELECT *, CAST(l_suppkey + 1 AS VARCHAR),
        CASE WHEN l_tax = 0 THEN '  ' ELSE 'shop ' || l_suppkey || ' ' END, 1, l_discount, l_linenumber = 1, true, NULL
        FROM lineitem WHERE l_linenumber NOT IN (5, 7)
    UNION ALL SELECT *, NULL, 'company ' || l_suppkey, 1, l_tax, true, false, NULL
        FROM lineitem WHERE l_linenumber IN (5, 6) AND l_returnflag <> 'N'),
    offers AS (SELECT 7 AS transaction_id, lpad(CAST(l_partkey AS VARCHAR), 13, '0') AS client_code,
        'part ' || l_partkey AS name, 'art-' || l_partkey AS articul, l_returnflag AS category_name,
        l_linestatus AS brand_name, l_extendedprice AS default_price, company_id, 'company ' || l_suppkey AS company_name,
        l_returnflag AS region_name, l_extendedprice AS price, in_stock, discount_type, discount, offer_name,
        CASE WHEN dated THEN CAST(l_shipdate + INTERVAL 3 HOUR AS VARCHAR) END AS date,
        CASE WHEN dated THEN CAST(l_shipdate + INTERVAL 4 HOUR AS VARCHAR) END AS last_check_date,
        CASE WHEN discount_type = 0 THEN l_extendedprice * (1.0::DOUBLE + discount / 100.0::DOUBLE)
            ELSE l_extendedprice + discount END AS original_price,
        '2024-02-01 06:00:00' AS date_create, card_price FROM src)"""


def _price_rows(spark, sf):
    pages = feeds.prices(feeds.line_items(spark, sf))
    return prices.price_offers(pages, RUN, datetime(2024, 2, 1, 6), tz="Etc/GMT-3")


@query("price_offers", f"WITH {_OFFERS} SELECT * FROM offers")
def price_offers(spark, sf):
    return _price_rows(spark, sf)


def _known_offers(spark, sf):
    """Dimension as it stands: the shops of suppliers in debt are not in it."""
    return table(spark, sf, "supplier").filter("s_acctbal >= 0").selectExpr(
        "concat('old-', s_suppkey) as id", "concat('shop ', s_suppkey) as name")


_DIM = f"""dim AS (SELECT 'old-' || s_suppkey AS id, 'shop ' || s_suppkey AS name FROM supplier WHERE s_acctbal >= 0),
    seen AS (SELECT DISTINCT trim(offer_name) AS name, {_SHOP_ID} AS id FROM offers WHERE trim(offer_name) <> ''),
    full_dim AS (SELECT id, name FROM dim
        UNION ALL SELECT id, name FROM seen WHERE NOT EXISTS (SELECT 1 FROM dim WHERE dim.name = seen.name))"""


@query("offer_dimension", f"WITH {_OFFERS}, {_DIM} SELECT id, name FROM full_dim")
def offer_dimension(spark, sf):
    return insert_offers(_known_offers(spark, sf), _price_rows(spark, sf))


@query("priced_rows", f"""WITH {_OFFERS}, {_DIM}
    SELECT offers.*, full_dim.id AS offer_id FROM offers LEFT JOIN full_dim ON full_dim.name = trim(offer_name)
        AND trim(offer_name) <> ''""")
def priced_rows(spark, sf):
    return prices.priced_rows(_price_rows(spark, sf), _known_offers(spark, sf))


@query("warehouse_dimension", f"""
    WITH dim AS (SELECT 'WH ' || s_suppkey AS code, 'WB' AS source, r_name AS cluster FROM supplier
            JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_acctbal >= 0),
    seen AS (SELECT DISTINCT {WH} AS code FROM lineitem)
    SELECT * FROM dim UNION ALL SELECT code, 'WB', 'NONE' FROM seen
        WHERE NOT EXISTS (SELECT 1 FROM dim WHERE dim.code = seen.code)""")
def warehouse_dimension(spark, sf):
    dim = table(spark, sf, "supplier").filter("s_acctbal >= 0") \
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")) \
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")) \
        .selectExpr("concat('WH ', s_suppkey) as code", "'WB' as source", "r_name as cluster")
    rows = wb.stock_lines(feeds.wb_stock(feeds.line_items(spark, sf)), OWNER, RUN, STOCK_DAY)
    # Some rows name no warehouse at all; a second insert of the same rows adds nothing.
    rows = rows.withColumn("warehouse_name", F.explode(F.expr("if(quantity = 1, array(warehouse_name, null), array(warehouse_name))")))
    return insert_warehouses(insert_warehouses(dim, rows, "WB"), rows, "WB")


_DETAIL = {
    "realizationreport_id": "CAST(l_orderkey AS VARCHAR)", "rr_dt": "strftime(l_shipdate, '%Y-%m-%d')",
    "nm_id": "CAST(l_partkey AS VARCHAR)", "barcode": "lpad(CAST(l_partkey AS VARCHAR), 13, '0')",
    "doc_type_name": "l_returnflag", "quantity": "CAST(CAST(l_quantity AS INT) AS VARCHAR)",
    "retail_amount": CENTS.format("l_extendedprice"), "office_name": "'wh ' || l_suppkey",
    "rrd_id": "CAST(l_linenumber AS VARCHAR)", "srid": "CAST(l_orderkey AS VARCHAR)",
}


@query("report_labels", "SELECT CAST(json_object(" + ", ".join(
    f"'{label}', {_DETAIL[k]}" for k, label in realization.DETAIL_LABELS.items() if k in _DETAIL) + ") AS VARCHAR) AS labelled FROM lineitem")
def report_labels(spark, sf):
    """Rows under the report's labels, dots and all, as one document each: fields that the source left out are null."""
    rows = realization.labelled(feeds.realization_detail(feeds.line_items(spark, sf)))
    return rows.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("labelled"))


@query("realization_header", """
    SELECT CAST(o_orderkey AS VARCHAR) AS num, strftime(o_orderdate, '%Y-%m-%d') AS doc_date,
        '2020-01-01' AS contract_date, 'c' || o_custkey AS contract_num, 'RUB' AS currency_code,
        o_totalprice AS doc_amount, o_totalprice AS vat_amount, '1' AS payer_inn, '2' AS payer_kpp,
        'payer' AS payer_name, '3' AS rcv_inn, '4' AS rcv_kpp, 'customer ' || o_custkey AS rcv_name,
        strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS start_date,
        strftime(last_day(o_orderdate), '%Y-%m-%d') AS stop_date FROM orders""")
def realization_header(spark, sf):
    return realization.header_rows(feeds.realization(table(spark, sf, "orders")))


@query("realization_lines", """
    SELECT CAST(o_orderkey AS VARCHAR) AS num, n AS row_number, o_custkey AS product_id,
        'p' || o_custkey AS product_name, lpad(CAST(o_custkey AS VARCHAR), 13, '0') AS barcode,
        'of-' || o_custkey AS offer_id, 5.0::DOUBLE AS commission_percent, o_totalprice AS price,
        o_totalprice AS price_sale, o_totalprice AS sale_amount, 0.0::DOUBLE AS sale_commission,
        0.0::DOUBLE AS sale_discount, o_totalprice AS sale_price_seller, n AS sale_qty, 0.0::DOUBLE AS return_sale,
        0.0::DOUBLE AS return_amount, 0.0::DOUBLE AS return_commission, 0.0::DOUBLE AS return_discount,
        0.0::DOUBLE AS return_price_seller, 0 AS return_qty
    FROM orders, (SELECT 1 AS n UNION ALL SELECT 2)""")
def realization_lines(spark, sf):
    return realization.line_rows(feeds.realization(table(spark, sf, "orders")))
