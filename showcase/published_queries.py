"""Queries over tables that are published slice by slice: facts by day, reports over them, folded states."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from showcase import feeds
from showcase.chain_queries import _CHAIN, _SHORT, SPAN, _both, codes
from showcase.fact_queries import (
    FROM,
    items_dim,
    old_orders,
    old_stock,
    staged_ads,
    staged_kz_stock,
    staged_orders,
    staged_stock,
    warehouse_dim,
)
from showcase.feed_queries import STOCK_DAY
from showcase.registry import ORACLES, broken, fails, new_folder, query, table
from showcase.state_queries import request_log
from tradeloom.operators import lookup, partials
from tradeloom.plans import daily, facts
from tradeloom.sources import published

AGAIN, MONTH_END = date(2000, 1, 17), date(2000, 1, 31)


def _orders_table(spark, sf) -> str:
    """The order fact by month: old days first, then the days that were asked for."""
    path = new_folder(spark, "fact-orders")
    facts.load_orders(path, [old_orders(spark, sf)], date(1900, 1, 1), "month")
    facts.load_orders(path, staged_orders(spark, sf), FROM, "month")
    return path


def _stock_table(spark, sf) -> str:
    """The stock fact by date and source: old stock at the ends of the months first, then the sums of one date."""
    path = new_folder(spark, "fact-stock")
    old = old_stock(spark, sf).withColumn("stock_date", F.last_day("stock_date"))
    published.publish(old, path, ["stock_date", "source"])
    facts.load_stock(path, staged_stock(spark, sf), STOCK_DAY)
    return path


@query("fact_orders_files", f"""SELECT * FROM ({ORACLES['fact_orders']}) WHERE CAST(order_ts AS TIMESTAMP) < TIMESTAMP '{AGAIN}' OR source = 'WB'""")
def fact_orders_files(spark, sf):
    """Days from the middle of a month on are loaded once more, when one source brings nothing; a load before that fails half-way."""
    path, staged = _orders_table(spark, sf), staged_orders(spark, sf)[:1]
    fails(lambda: facts.load_orders(path, [broken(rows, "amount") for rows in staged], AGAIN, "month"))
    facts.load_orders(path, staged, AGAIN, "month")
    return published.read(spark, path).drop("day", "month")


@query("fact_stock_files", f"""
    SELECT * REPLACE (CAST(last_day(CAST(stock_date AS DATE)) AS VARCHAR) AS stock_date) FROM ({ORACLES['fact_stock']}) WHERE warehouse = 'OLD'
    UNION ALL SELECT * FROM ({ORACLES['fact_stock']}) WHERE warehouse <> 'OLD' AND source <> 'WB'
    UNION ALL SELECT * FROM ({ORACLES['fact_stock_kz']}) WHERE stock_date = '{STOCK_DAY}'""")
def fact_stock_files(spark, sf):
    """One date is loaded, then one source of it without rows, then another one."""
    path = _stock_table(spark, sf)
    facts.load_stock(path, [staged_stock(spark, sf)[0].limit(0)], STOCK_DAY, source="WB")
    facts.load_stock(path, [staged_kz_stock(spark, sf)], STOCK_DAY, source="KZ")
    return published.read(spark, path)


@query("ad_fact_files", ORACLES["ad_fact"])
def ad_fact_files(spark, sf):
    """The window of 60 days, loaded twice: first with days that the second load does not bring."""
    path = new_folder(spark, "fact-ads")
    old = table(spark, sf, "orders").selectExpr(
        "cast(o_orderdate as date) as report_date", "'old' as sku", "cast(1 as int) as ordered_qnt", "o_totalprice as sum_price")
    staged = staged_ads(spark, sf).select("report_date", "sku", F.col("ordered_qnt").cast("int").alias("ordered_qnt"),
                                         F.col("sum_price").cast("double").alias("sum_price"))
    wrong = staged.filter(F.col("report_date") >= date(2001, 9, 1)).withColumn("sku", F.lit("gone"))
    facts.load_ads(path, old.unionByName(wrong), date(1995, 3, 1), grain="month")
    facts.load_ads(path, staged, date(2001, 10, 31), grain="month")
    return published.read(spark, path).drop("month")


# Reports over the published facts.

def _report_orders(spark, sf):
    return facts.report_orders(published.read(spark, _orders_table(spark, sf)).drop("month"), codes(spark, sf))


def _report_stock(spark, sf):
    return facts.report_stock(published.read(spark, _stock_table(spark, sf)), codes(spark, sf))


def _short_sql(keys: str, joined: str = "", shown: str | None = None) -> str:
    shown = shown or keys
    return f"""WITH {_CHAIN}, dim AS (SELECT 'WH ' || s_suppkey AS code, r_name AS r FROM supplier JOIN nation ON s_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey WHERE s_acctbal >= 0), {_both('source, warehouse, item')},
        g AS (SELECT {shown}, sum(quantity) AS quantity, sum(amount) AS amount, sum(stock) AS stock FROM m {joined} GROUP BY ALL)
        SELECT {keys}, CAST(stock AS DOUBLE) AS stock, CAST(quantity AS DOUBLE) / {SPAN}.0::DOUBLE AS avg_sale, {_SHORT},
            stock = 0 AS out_of_stock FROM g WHERE quantity > 0"""


_CLUSTER = "LEFT JOIN dim ON dim.code = m.warehouse AND m.source IN ('WB', 'OZON')"


@query("chain_item_shortage", _short_sql("item"))
def chain_item_shortage(spark, sf):
    return daily.item_shortage(_report_orders(spark, sf), _report_stock(spark, sf), STOCK_DAY, days=SPAN)


@query("chain_cluster_shortage", _short_sql("cluster, item", _CLUSTER, "coalesce(r, 'NONE') AS cluster, item"))
def chain_cluster_shortage(spark, sf):
    return daily.cluster_shortage(_report_orders(spark, sf), _report_stock(spark, sf), warehouse_dim(spark, sf), STOCK_DAY, days=SPAN)


@query("chain_product_shortage", _short_sql(
    "brand, category", "LEFT JOIN part ON item = 'P' || p_partkey", "p_brand AS brand, p_type AS category"))
def chain_product_shortage(spark, sf):
    return daily.product_shortage(_report_orders(spark, sf), _report_stock(spark, sf), items_dim(spark, sf), STOCK_DAY, days=SPAN)


@query("chain_cluster_report", f"""
    WITH {_CHAIN}, dim AS (SELECT 'WH ' || s_suppkey AS code, r_name AS r FROM supplier JOIN nation ON s_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey WHERE s_acctbal >= 0),
    e AS (SELECT source, owner, warehouse, CASE WHEN is_cancelled THEN 0 ELSE quantity END AS q, CASE WHEN is_cancelled THEN 0 ELSE amount END AS a,
            1 AS n, is_cancelled::INT AS c, 0 AS st FROM f WHERE day > DATE '2001-11-30' - {SPAN} AND day <= DATE '2001-11-30'
        UNION ALL SELECT source, owner, warehouse, 0, 0, 0, 0, quantity FROM s WHERE stock_date = DATE '2001-11-30'),
    g AS (SELECT owner, coalesce(r, 'NONE') AS cluster, sum(n)::BIGINT AS orders, sum(q) AS quantity, sum(a) AS amount,
        sum(c)::BIGINT AS cancelled, sum(st) AS stock FROM e AS m {_CLUSTER} GROUP BY ALL)
    SELECT owner, cluster, orders, CAST(quantity AS DOUBLE) AS quantity, CAST(amount AS DOUBLE) AS amount, cancelled, CAST(stock AS DOUBLE) AS stock,
        {_SHORT}, CAST(stock AS DOUBLE) * {SPAN}.0::DOUBLE / nullif(CAST(quantity AS DOUBLE), 0) AS cover_days FROM g""")
def chain_cluster_report(spark, sf):
    return daily.cluster_report(_report_orders(spark, sf), _report_stock(spark, sf), warehouse_dim(spark, sf), STOCK_DAY, days=SPAN)


@query("chain_sales_vs_stock", f"""
    WITH {_CHAIN}, e AS (SELECT source, owner, warehouse, item, CASE WHEN is_cancelled THEN 0 ELSE quantity END AS q,
            CASE WHEN is_cancelled THEN 0 ELSE amount END AS a, 0 AS st FROM f WHERE day = DATE '{MONTH_END}'
        UNION ALL SELECT source, owner, warehouse, item, 0, 0, quantity FROM s WHERE last_day(stock_date) = DATE '{MONTH_END}')
    SELECT source, owner, warehouse, item, CAST(sum(q) AS DOUBLE) AS sold, CAST(sum(a) AS DOUBLE) AS amount, CAST(sum(st) AS DOUBLE) AS stock
    FROM e GROUP BY ALL""")
def chain_sales_vs_stock(spark, sf):
    """A day of old stock: its slices alone are read."""
    return daily.sales_vs_stock(_report_orders(spark, sf), _report_stock(spark, sf), MONTH_END)


# Rows of completed transactions only.

@query("committed_orders_by_day", """
    WITH f AS (SELECT l_orderkey % 40 AS tx, CAST(o_orderdate AS DATE) AS day, c_mktsegment AS owner, CASE l_linestatus WHEN 'O' THEN 'WB' ELSE 'OZON' END AS source,
        CAST(l_partkey AS VARCHAR) AS sku, CAST(l_quantity AS DECIMAL(18,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_returnflag = 'R' AS is_cancelled
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
    t AS (SELECT o_orderkey % 40 AS id, CASE WHEN o_orderkey % 40 IN (3, 10, 39) THEN 'RUNNING' WHEN o_orderkey % 40 = 17 THEN 'FAILED' ELSE 'COMPLETED' END AS status,
        max(o_orderdate) AS start_date FROM orders WHERE o_orderkey % 40 <> 5 GROUP BY 1, 2)
    SELECT CAST(day AS VARCHAR) AS report_date, owner, source, sku, count(*) AS orders, CAST(sum(quantity) AS DOUBLE) AS quantity,
        CAST(sum(amount) AS DOUBLE) AS amount, count(*) FILTER (is_cancelled) AS cancelled
    FROM f WHERE tx IN (SELECT id FROM t WHERE status = 'COMPLETED')
        AND day = (SELECT CAST(start_date AS DATE) - 1 FROM t WHERE status = 'COMPLETED' ORDER BY id DESC LIMIT 1) GROUP BY ALL""")
def committed_orders_by_day(spark, sf):
    """Orders in a folder per transaction; some transactions run still, one failed, one is not in the ledger."""
    path = new_folder(spark, "loaded")
    loaded = feeds.owned_lines(spark, sf).selectExpr(
        "cast(o_orderdate as date) as day", "if(l_linestatus = 'O', 'WB', 'OZON') as source", "owner", "cast(l_partkey as string) as sku",
        "cast(l_quantity as decimal(18,2)) as quantity", "cast(l_extendedprice as decimal(18,2)) as amount", "l_returnflag = 'R' as is_cancelled",
        "l_orderkey % 40 as transaction_id")
    published.publish(loaded, path, ["transaction_id"])
    ledger = table(spark, sf, "orders").selectExpr("o_orderkey % 40 as id", "o_orderdate").filter("id <> 5").groupBy("id").agg(
        F.max("o_orderdate").alias("start_date")).withColumn(
        "status", F.expr("case when id in (3, 10, 39) then 'RUNNING' when id = 17 then 'FAILED' else 'COMPLETED' end"))
    return daily.orders_by_last_completed(published.read(spark, path), ledger, loaded_by="transaction_id")


# States folded batch by batch.

@query("ledger_folded", ORACLES["ledger_state"])
def ledger_folded(spark, sf):
    """Four batches of events, each read once; the first two are folded into a base, and one batch runs twice."""
    path, log = new_folder(spark, "ledger"), request_log(spark, sf)
    batch = lambda n: partials.ledger_partial(log.filter(F.pmod(F.xxhash64("seq"), F.lit(4)) == n))
    partials.add(batch(0), path, 0)
    partials.add(batch(1), path, 1)
    partials.fold(spark, path, partials.ledger_merge)
    partials.add(batch(1), path, 1)  # the base holds it
    partials.add(batch(0), path, 2)  # a wrong try of batch 2, which is replaced
    partials.add(batch(2), path, 2)
    partials.add(batch(3), path, 3)
    return partials.ledger_state(partials.parts(spark, path))


@query("feed_counts_folded", ORACLES["feed_counts"])
def feed_counts_folded(spark, sf):
    """Counts per feed and owner, from three batches of lines."""
    path = new_folder(spark, "counts")
    rows = feeds.owned_lines(spark, sf).select(
        "owner", F.expr("if(l_linestatus = 'O', 'WB', 'OZON')").alias("source"), F.lit("order").alias("type"), "l_orderkey")
    for n in range(3):
        partials.add(partials.count_partial(rows.filter(F.col("l_orderkey") % 3 == n), ["owner", "source", "type"]), path, n)
        if n == 1:
            partials.fold(spark, path, partials.count_merge)
    return partials.count_merge(partials.parts(spark, path))


@query("missing_keys", """
    SELECT count(*) AS missing_rows, min(l_partkey)::VARCHAR AS first_key, max(l_partkey)::VARCHAR AS last_key, 'stopped' AS load
    FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 3)""")
def missing_keys(spark, sf):
    """Lines are looked up among parts of which some are missing: the load is stopped with a report of all of them."""
    path = new_folder(spark, "looked-up")
    lines = table(spark, sf, "lineitem").selectExpr("l_partkey as sku", "l_quantity as quantity", "l_linestatus as status")
    dim = table(spark, sf, "part").filter("p_size > 3").selectExpr("p_partkey as sku", "p_brand as brand")
    rows, report = lookup.matched(lines, dim, ["sku"], examples=1)
    published.publish(spark.createDataFrame([], rows.schema), path, ["status"])
    try:
        published.publish(rows, path, ["status"], check=report.check)
        load = "published"
    except lookup.MissingKeys:
        load = "stopped" if not published.read(spark, path).count() else "half published"
    lost = lookup.missing(lines, dim, ["sku"])
    return lost.agg(F.lit(report.get()["rows"]).alias("missing_rows"), F.min("sku").cast("string").alias("first_key"),
                    F.max("sku").cast("string").alias("last_key"), F.lit(load).alias("load"))
