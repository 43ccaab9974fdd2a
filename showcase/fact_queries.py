"""Queries over facts, dictionaries and daily reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from showcase import feeds
from showcase.feed_queries import _AD_ORDERS, OWNER, RUN, STOCK_DAY, WH
from showcase.registry import query, table
from tradeloom.operators import advertising, erp, postings, stock, wb
from tradeloom.operators.incremental import requested
from tradeloom.plans import daily, facts
from tradeloom.sources import schemas

FROM = date(1998, 1, 1)
DAY = date(1998, 6, 15)

_OLD = """old AS (SELECT 'OLD' AS source, o_orderpriority AS owner, CAST(o_orderkey AS VARCHAR) AS order_key,
    CAST(o_custkey AS VARCHAR) AS sku, o_orderdate AS order_ts, o_orderdate AS change_ts, 1.0::DOUBLE AS quantity,
    o_totalprice AS amount, o_orderstatus = 'P' AS is_cancelled, 'OLD' AS warehouse, CAST(NULL AS VARCHAR) AS region,
    'OLD' AS schema, CAST(NULL AS VARCHAR) AS barcode FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')"""


def old_orders(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "'OLD' as source", "o_orderpriority as owner", "cast(o_orderkey as string) as order_key",
        "cast(o_custkey as string) as sku", "o_orderdate as order_ts", "o_orderdate as change_ts",
        "cast(1 as decimal(18,2)) as quantity", "cast(o_totalprice as decimal(18,2)) as amount",
        "o_orderstatus = 'P' as is_cancelled", "'OLD' as warehouse", "cast(null as string) as region",
        "'OLD' as schema", "cast(null as string) as barcode")


_TIES = ("change_ts DESC, order_ts DESC, quantity DESC, amount DESC, is_cancelled DESC, warehouse DESC, region DESC,"
         " schema DESC, barcode DESC NULLS LAST")
_OWNED = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"
_PAGE = """lpad(CAST(l_partkey AS VARCHAR), 12, '0') || '-' || lpad(CAST(l_suppkey AS VARCHAR), 12, '0') || '-' ||
    lpad(CAST(CAST(l_quantity AS INT) AS VARCHAR), 4, '0') || '-' ||
    lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR), 15, '0') || '-' || l_returnflag || '-' ||
    l_linestatus || '-' || CAST(round(l_discount * 100) AS INT) || '-' || CAST(round(l_tax * 100) AS INT)"""


def _fact_sql(wb_rows: str, ozon: bool) -> str:
    key = "'o' || l_orderkey" if ozon else "CASE WHEN l_linenumber = 6 THEN '0' ELSE 'o' || l_orderkey END"
    parts = f"""new_wb AS (SELECT 'WB' AS source, c_mktsegment AS owner, {key} AS order_key,
            CAST(l_partkey AS VARCHAR) AS sku, o_orderdate AS order_ts, l_shipdate AS change_ts,
            1.0::DOUBLE AS quantity, {wb_rows}, {WH} AS warehouse, 'region ' || l_linenumber AS region"""
    parts += (", 'client' AS schema" if ozon else
              ", CASE WHEN l_returnflag = 'R' THEN 'R' ELSE 'S' END || l_orderkey AS schema")
    parts += f""", lpad(CAST(l_partkey AS VARCHAR), 13, '0') AS barcode FROM {_OWNED}
            WHERE l_linestatus = 'O' {'' if ozon else 'AND l_linenumber <> 7'} AND o_orderdate >= TIMESTAMP '1998-01-01'
        )"""
    # A later version of line 2 lies before the range: the key has left it.
    parts += """, moved AS (SELECT * REPLACE (order_ts - INTERVAL 4 YEAR AS order_ts, TIMESTAMP '2099-01-01' AS change_ts) FROM new_wb
            WHERE region = 'region 2')"""
    union = "SELECT * FROM new_wb UNION ALL SELECT * FROM moved"
    if ozon:
        parts += f""", posting AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment, l_orderkey,
                l_linenumber ORDER BY l_shipdate DESC, {_PAGE} DESC) AS rn FROM {_OWNED} WHERE l_linestatus = 'F')
                WHERE rn = 1 AND l_linenumber <> 7),
            part_line AS (SELECT *, l_partkey AS sku, l_quantity AS q, l_extendedprice AS p FROM posting
                UNION ALL SELECT *, l_partkey, l_quantity, l_extendedprice FROM posting WHERE l_linenumber = 6
                UNION ALL SELECT *, l_partkey, 2, l_discount FROM posting WHERE l_linenumber = 4
                UNION ALL SELECT *, l_partkey + 1, 1, l_tax FROM posting WHERE l_linenumber IN (3, 6)),
            new_ozon AS (SELECT 'OZON' AS source, c_mktsegment AS owner, l_orderkey || '-' || l_linenumber AS order_key,
                CAST(sku AS VARCHAR) AS sku, o_orderdate AS order_ts, l_shipdate AS change_ts,
                CAST(sum(CAST(q AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
                CAST(sum(CAST(p AS DECIMAL(18,2)) * CAST(q AS INT)) AS DOUBLE) AS amount,
                o_orderstatus = 'P' AS is_cancelled, {WH} AS warehouse, o_orderpriority AS region, 'FBO' AS schema,
                CAST(NULL AS VARCHAR) AS barcode FROM part_line WHERE o_orderdate >= TIMESTAMP '1998-01-01'
                GROUP BY ALL)"""
        union += " UNION ALL SELECT * FROM new_ozon"
    return f"""WITH {_OLD}, {parts}, latest AS (SELECT *, row_number() OVER (
            PARTITION BY source, owner, order_key, sku ORDER BY {_TIES}) AS rn FROM ({union})),
        fact AS (SELECT * FROM old UNION ALL SELECT * EXCLUDE (rn) FROM latest WHERE rn = 1 AND order_ts >= TIMESTAMP '1998-01-01')
    SELECT * REPLACE (CAST(order_ts AS VARCHAR) AS order_ts, CAST(change_ts AS VARCHAR) AS change_ts) FROM fact"""


@query("fact_orders", _fact_sql("l_extendedprice AS amount, l_returnflag = 'R' AS is_cancelled", True))
def fact_orders(spark, sf):
    return facts.apply_orders(old_orders(spark, sf), staged_orders(spark, sf), FROM)


def staged_orders(spark, sf):
    """Sources are asked for the range that will be replaced, so the scan skips older orders.

    A later version of some keys, staged as well, lies before the range.
    """
    lines = requested(feeds.owned_lines(spark, sf), "o_orderdate", FROM)
    wb_docs = feeds.wb_orders(lines.filter("l_linestatus = 'O'"), "o_orderdate", "l_shipdate", "owner")
    staged_wb = wb.order_lines(wb_docs, F.col("owner"), RUN, FROM)
    pages = postings.latest_postings(feeds.fbo(lines.filter("l_linestatus = 'F'"), "owner"), packed=False)
    staged_ozon = postings.flatten_fbo(pages, F.col("owner"), RUN, FROM)
    return [_with_moved(facts.wb_orders(staged_wb)), facts.ozon_orders(staged_ozon)]


def _with_moved(rows):
    """The rows, and those of one region once more under another time; the lines are read and joined once for both."""
    own = "struct(order_ts, change_ts)"
    moved = "struct(order_ts - interval 4 year as order_ts, timestamp_ntz'2099-01-01 00:00:00' as change_ts)"
    each = rows.select("*", F.expr(f"explode_outer(if(region = 'region 2', array({own}, {moved}), array({own})))").alias("_at"))
    return each.select(*[F.col(f"_at.{c}").alias(c) if c in ("order_ts", "change_ts") else c for c in rows.columns])


@query("fact_sales", _fact_sql("CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS amount,"
                               " false AS is_cancelled", False))
def fact_sales(spark, sf):
    lines = requested(feeds.owned_lines(spark, sf), "o_orderdate", FROM) \
        .filter("l_linestatus = 'O'")
    docs = feeds.wb_sales(lines, "o_orderdate", "l_shipdate", "owner")
    staged = wb.sale_lines(docs, F.col("owner"), RUN, FROM)
    new = facts.wb_sales(staged)
    return facts.apply_orders(old_orders(spark, sf), [_with_moved(new)], FROM)


_OLD_STOCK = """old AS (SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS stock_date, 'KZ' AS source,
    o_orderpriority AS owner, 'OLD' AS warehouse, CAST(o_custkey AS VARCHAR) AS sku, CAST(NULL AS VARCHAR) AS barcode,
    1.0::DOUBLE AS quantity FROM orders)"""


def old_stock(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "cast(o_orderdate as date) as stock_date", "'KZ' as source", "o_orderpriority as owner", "'OLD' as warehouse",
        "cast(o_custkey as string) as sku", "cast(null as string) as barcode",
        "cast(1 as decimal(18,2)) as quantity")


@query("fact_stock", f"""
    WITH {_OLD_STOCK}, new AS (
        SELECT 'WB' AS source, 'SELLER' AS owner, {WH} AS warehouse, CAST(l_partkey AS VARCHAR) AS sku,
            lpad(CAST(l_partkey AS VARCHAR), 13, '0') AS barcode, l_quantity AS q FROM lineitem WHERE l_linestatus = 'O'
        UNION ALL SELECT 'OZON', 'SELLER', {WH}, CAST(l_partkey AS VARCHAR), 'bc-' || l_partkey, l_quantity
            FROM lineitem WHERE l_linestatus = 'F'
        UNION ALL SELECT '1C', NULL, '1C', CAST(l_partkey AS VARCHAR), NULL, l_quantity FROM lineitem
            WHERE l_returnflag = 'A')
    SELECT * FROM old WHERE stock_date <> '2001-11-30'
    UNION ALL SELECT '2001-11-30', source, owner, warehouse, sku, barcode,
        CAST(sum(CAST(q AS DECIMAL(18,2))) AS DOUBLE) FROM new GROUP BY source, owner, warehouse, sku, barcode""")
def fact_stock(spark, sf):
    return facts.apply_stock(old_stock(spark, sf), staged_stock(spark, sf), STOCK_DAY)


def staged_stock(spark, sf):
    line = feeds.line_items(spark, sf)
    barcodes = table(spark, sf, "part").selectExpr("p_partkey as sku", "concat('bc-', p_partkey) as barcode")
    from_wb = wb.stock_lines(feeds.wb_stock(line.filter("l_linestatus = 'O'")), OWNER, RUN, STOCK_DAY)
    pages = feeds.analytics_stock(line.filter("l_linestatus = 'F'"))
    from_ozon = stock.analytics_stock_lines(pages, barcodes, OWNER, RUN, STOCK_DAY)
    item = """named_struct('id', case l_returnflag when 'A' then cast(l_partkey as string) when 'N' then ' ' end,
        'quantity', l_quantity)"""
    from_erp = erp.stock_rows(feeds.erp_pages(line, item, schemas.ERP_STOCK_PAGE), RUN, STOCK_DAY)
    return [facts.wb_stock(from_wb), facts.ozon_stock(from_ozon), facts.erp_stock(from_erp)]


@query("fact_stock_kz", f"""
    WITH {_OLD_STOCK} SELECT * FROM old WHERE stock_date <> '2001-11-30'
    UNION ALL SELECT '2001-11-30', 'KZ', 'SELLER', 'KZ', CASE WHEN l_linenumber = 7 THEN 'NODASH'
            ELSE 'ORG' || l_suppkey || '-' || l_partkey || '-' || l_linenumber END,
        lpad(CAST(l_partkey AS VARCHAR), 13, '0'), CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE)
        FROM lineitem GROUP BY ALL""")
def fact_stock_kz(spark, sf):
    return facts.apply_stock_of(old_stock(spark, sf), staged_kz_stock(spark, sf), STOCK_DAY, "KZ")


def staged_kz_stock(spark, sf):
    return facts.kz_stock(stock.kz_stock_lines(feeds.kz_stock(feeds.line_items(spark, sf)), OWNER, RUN, STOCK_DAY))


@query("dictionary_upsert", """
    SELECT 'item' AS dictionary, CAST(p_partkey AS VARCHAR) AS key, p_name AS value FROM part
    UNION ALL SELECT 'item', CAST(s_suppkey AS VARCHAR), s_name FROM supplier
        WHERE s_suppkey NOT IN (SELECT p_partkey FROM part)
    UNION ALL SELECT 'barcode', 'id-' || p_partkey, CAST(p_partkey AS VARCHAR) FROM part
    UNION ALL SELECT 'barcode', 'id-' || c_custkey, 'old' FROM customer
        WHERE c_custkey NOT IN (SELECT p_partkey FROM part)
    UNION ALL SELECT 'barcode_price', 'bc-' || p_partkey, p_name FROM part
    UNION ALL SELECT 'barcode_price', 'bc-' || c_custkey, 'old' FROM customer
        WHERE c_custkey NOT IN (SELECT p_partkey FROM part)""")
def dictionary_upsert(spark, sf):
    part, customer = table(spark, sf, "part"), table(spark, sf, "customer")
    def staged(rows):
        """Every row is staged twice; the earlier one has the higher text, the later one counts."""
        place = F.explode(F.array(F.struct(F.lit("1").alias("page"), F.lit("zzz ").alias("mark")),
                                  F.struct(F.lit("2").alias("page"), F.lit("").alias("mark")))).alias("at")
        first, *rest = rows.columns
        return rows.select("*", place).select(first, *[F.concat("at.mark", c).alias(c) for c in rest], "at.page", F.lit(0).alias("item_no"))

    items = (table(spark, sf, "supplier").selectExpr("cast(s_suppkey as string) as id", "s_name as name"),
             staged(part.selectExpr("cast(p_partkey as string) as id", "p_name as name")))
    codes = (customer.selectExpr("concat('id-', c_custkey) as barcode_id", "'old' as item_id"),
             staged(part.selectExpr("concat('id-', p_partkey) as barcode_id", "cast(p_partkey as string) as item_id")))
    prices = (customer.selectExpr("concat('bc-', c_custkey) as barcode", "'old' as name"),
              staged(part.selectExpr("concat('bc-', p_partkey) as barcode", "p_name as name")))
    new = facts.apply_dictionary(items, codes, prices)
    return new["item"].selectExpr("'item' as dictionary", "id as key", "name as value") \
        .unionByName(new["barcode"].selectExpr("'barcode' as dictionary", "barcode_id as key", "item_id as value")) \
        .unionByName(new["barcode_price"].selectExpr("'barcode_price' as dictionary", "barcode as key", "name as value"))


@query("ad_fact", f"""
    WITH s AS ({_AD_ORDERS}) SELECT report_date, sku, ordered_qnt, sum_price FROM s WHERE report_date >= '2001-09-01'
    UNION ALL SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 'old', 1, o_totalprice FROM orders
        WHERE o_orderdate < TIMESTAMP '2001-09-01'""")
def ad_fact(spark, sf):
    """60 days before 31 October 2001 are replaced."""
    staged = staged_ads(spark, sf)
    old = table(spark, sf, "orders").selectExpr(
        "cast(o_orderdate as date) as report_date", "'old' as sku", "1 as ordered_qnt", "o_totalprice as sum_price")
    return facts.apply_ads(old, staged, date(2001, 10, 31))


def staged_ads(spark, sf):
    return advertising.order_rows(feeds.ad_orders(feeds.line_items(spark, sf)), OWNER, "doc") \
        .select("report_date", "sku", "ordered_qnt", "sum_price")


@query("stock_items", """
    WITH dim AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 13, '0') AS barcode, min(p_name) AS item_id FROM part
        WHERE p_size > 10 GROUP BY 1)
    SELECT lpad(CAST(l_partkey AS VARCHAR), 13, '0') AS barcode, CAST(l_partkey AS VARCHAR) AS sku,
        coalesce(item_id, lpad(CAST(l_partkey AS VARCHAR), 13, '0')) AS item, l_quantity AS quantity
    FROM lineitem LEFT JOIN dim ON dim.barcode = lpad(CAST(l_partkey AS VARCHAR), 13, '0')""")
def stock_items(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr(
        "lpad(l_partkey, 13, '0') as barcode", "cast(l_partkey as string) as sku", "l_quantity as quantity")
    dim = table(spark, sf, "part").filter("p_size > 10").selectExpr(
        "lpad(p_partkey, 13, '0') as barcode", "p_name as item_id")
    return facts.with_items(rows, dim)


# Facts as they are stored: typed, one row per order line.

def orders_fact(spark, sf):
    return feeds.owned_lines(spark, sf).selectExpr(
        "cast(o_orderdate as date) as day", "o_orderdate as order_ts", "if(l_linestatus = 'O', 'WB', 'OZON') as source", "owner",
        "concat('WH ', l_suppkey) as warehouse", "concat('P', l_partkey) as item",
        "cast(l_partkey as string) as sku", "cast(l_quantity as decimal(18,2)) as quantity",
        "cast(l_extendedprice as decimal(18,2)) as amount", "l_returnflag = 'R' as is_cancelled")


def stock_fact(spark, sf):
    return feeds.owned_lines(spark, sf).selectExpr(
        "cast(l_shipdate as date) as stock_date", "if(l_linestatus = 'O', 'WB', 'OZON') as source", "owner",
        "concat('WH ', l_suppkey) as warehouse", "concat('P', l_partkey) as item",
        "cast(l_quantity as decimal(18,2)) as quantity")


def items_dim(spark, sf):
    return table(spark, sf, "part").selectExpr("concat('P', p_partkey) as item", "p_brand as brand",
                                               "p_type as category")


def warehouse_dim(spark, sf):
    """Warehouses of suppliers in debt are not in the dimension."""
    return table(spark, sf, "supplier").filter("s_acctbal >= 0") \
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")) \
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")) \
        .select(F.expr("concat('WH ', s_suppkey)").alias("code"), F.col("r_name").alias("cluster"),
                F.explode(F.array(F.lit("WB"), F.lit("OZON"))).alias("source"))


_FACTS = f"""f AS (SELECT CAST(o_orderdate AS DATE) AS day, CAST(l_shipdate AS DATE) AS stock_date,
    CASE l_linestatus WHEN 'O' THEN 'WB' ELSE 'OZON' END AS source, c_mktsegment AS owner,
    'WH ' || l_suppkey AS warehouse, 'P' || l_partkey AS item, CAST(l_partkey AS VARCHAR) AS sku,
    CAST(l_quantity AS DECIMAL(18,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
    l_returnflag = 'R' AS is_cancelled, p_brand AS brand, p_type AS category, coalesce(r_name, 'NONE') AS cluster
    FROM {_OWNED} JOIN part ON l_partkey = p_partkey
    LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) ON l_suppkey = s_suppkey
    LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""


def _sums_sql(keys: str, on: str, days: int = 30) -> str:
    """Orders of the last days and stock of the day, joined on the keys."""
    cols = [k.strip() for k in keys.split(",")]
    same = " AND ".join(f"a.{k} = b.{k}" for k in cols)
    picked = ", ".join(f"coalesce(a.{k}, b.{k}) AS {k}" for k in cols)
    return f"""a AS (SELECT {keys}, count(*) AS orders, coalesce(sum(quantity) FILTER (NOT is_cancelled), 0) AS quantity,
            coalesce(sum(amount) FILTER (NOT is_cancelled), 0) AS amount, count(*) FILTER (is_cancelled) AS cancelled
            FROM f WHERE day > DATE '{on}' - {days} AND day <= DATE '{on}' GROUP BY {keys}),
        b AS (SELECT {keys}, sum(quantity) AS stock FROM f WHERE stock_date = DATE '{on}' GROUP BY {keys}),
        m AS (SELECT {picked}, coalesce(orders, 0) AS orders, coalesce(quantity, 0) AS quantity,
            coalesce(amount, 0) AS amount, coalesce(cancelled, 0) AS cancelled, coalesce(stock, 0) AS stock
            FROM a FULL JOIN b ON {same})"""


_SHORT = "greatest(CAST(quantity AS DOUBLE) * 14 - CAST(stock AS DOUBLE) * 30, 0) / 30.0::DOUBLE AS shortage"


def _shortage_sql(keys: str, on: str = "1998-06-15") -> str:
    return f"""WITH {_FACTS}, {_sums_sql(keys, on)}
        SELECT {keys}, CAST(stock AS DOUBLE) AS stock, CAST(quantity AS DOUBLE) / 30.0::DOUBLE AS avg_sale, {_SHORT},
            stock = 0 AS out_of_stock FROM m WHERE quantity > 0"""


@query("daily_stock", f"""WITH {_FACTS} SELECT source, owner, warehouse, item, CAST(sum(quantity) AS DOUBLE) AS quantity
    FROM f WHERE stock_date = DATE '1998-06-15' GROUP BY ALL""")
def daily_stock(spark, sf):
    return daily.daily_stock(stock_fact(spark, sf), DAY)


@query("stock_shortage", _shortage_sql("source, owner, warehouse, item"))
def stock_shortage(spark, sf):
    return daily.stock_shortage(orders_fact(spark, sf), stock_fact(spark, sf), DAY)


@query("sales_vs_stock", f"""WITH {_FACTS}, {_sums_sql('source, owner, warehouse, item', '1998-06-15', 1)}
    SELECT source, owner, warehouse, item, CAST(quantity AS DOUBLE) AS sold, CAST(amount AS DOUBLE) AS amount,
        CAST(stock AS DOUBLE) AS stock FROM m""")
def sales_vs_stock(spark, sf):
    return daily.sales_vs_stock(orders_fact(spark, sf), stock_fact(spark, sf), DAY)


@query("cluster_shortage", _shortage_sql("cluster, item"))
def cluster_shortage(spark, sf):
    return daily.cluster_shortage(orders_fact(spark, sf), stock_fact(spark, sf), warehouse_dim(spark, sf), DAY)


@query("cluster_report", f"""WITH {_FACTS}, {_sums_sql('owner, cluster', '1998-06-15')}
    SELECT owner, cluster, orders, CAST(quantity AS DOUBLE) AS quantity, CAST(amount AS DOUBLE) AS amount, cancelled,
        CAST(stock AS DOUBLE) AS stock, {_SHORT},
        CAST(stock AS DOUBLE) * 30.0::DOUBLE / nullif(CAST(quantity AS DOUBLE), 0) AS cover_days FROM m""")
def cluster_report(spark, sf):
    return daily.cluster_report(orders_fact(spark, sf), stock_fact(spark, sf), warehouse_dim(spark, sf), DAY)


@query("item_shortage", _shortage_sql("item"))
def item_shortage(spark, sf):
    return daily.item_shortage(orders_fact(spark, sf), stock_fact(spark, sf), DAY)


@query("item_report", f"""
    WITH {_FACTS}, d AS (SELECT item, day, sum(quantity) AS quantity, sum(amount) AS amount FROM f
        WHERE NOT is_cancelled AND day <= DATE '2001-06-30' GROUP BY ALL)
    SELECT item, CAST(day AS VARCHAR) AS day, CAST(quantity AS DOUBLE) AS quantity, CAST(amount AS DOUBLE) AS amount,
        CAST(sum(quantity) OVER (PARTITION BY item ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)
            AS DOUBLE) AS quantity_7d,
        CAST(sum(quantity) OVER (PARTITION BY item ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)
            AS DOUBLE) AS quantity_30d FROM d""")
def item_report(spark, sf):
    return daily.item_report(orders_fact(spark, sf), date(2001, 6, 30))


@query("product_shortage", _shortage_sql("brand, category"))
def product_shortage(spark, sf):
    return daily.product_shortage(orders_fact(spark, sf), stock_fact(spark, sf), items_dim(spark, sf), DAY)


@query("product_report", f"""WITH {_FACTS}, {_sums_sql('owner, brand', '1998-06-15')},
    r AS (SELECT owner, brand, CAST(grouping(owner) * 2 + grouping(brand) AS INT) AS level, sum(quantity) AS quantity,
        sum(amount) AS amount, sum(stock) AS stock FROM m GROUP BY ROLLUP (owner, brand))
    SELECT owner, brand, level, CAST(quantity AS DOUBLE) AS quantity, CAST(amount AS DOUBLE) AS amount,
        CAST(stock AS DOUBLE) AS stock, {_SHORT} FROM r""")
def product_report(spark, sf):
    return daily.product_report(orders_fact(spark, sf), stock_fact(spark, sf), items_dim(spark, sf), DAY)


@query("orders_by_day", f"""WITH {_FACTS}
    SELECT CAST(day AS VARCHAR) AS report_date, owner, source, sku, count(*) AS orders,
        CAST(sum(quantity) AS DOUBLE) AS quantity, CAST(sum(amount) AS DOUBLE) AS amount,
        count(*) FILTER (is_cancelled) AS cancelled FROM f
    WHERE day = (SELECT CAST(o_orderdate AS DATE) - 1 FROM orders WHERE o_orderstatus = 'F' AND o_orderkey =
        (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'F')) GROUP BY ALL""")
def orders_by_day(spark, sf):
    """Report of the last completed transaction."""
    transactions = table(spark, sf, "orders").selectExpr(
        "o_orderkey as id", "if(o_orderstatus = 'F', 'COMPLETED', 'RUNNING') as status", "o_orderdate as start_date")
    return daily.orders_by_last_completed(orders_fact(spark, sf), transactions, "order_ts")
