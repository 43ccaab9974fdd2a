"""Daily reports over the facts that the merges produce, and reports as files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from showcase import feeds
from showcase.fact_queries import fact_orders, fact_stock, items_dim
from showcase.feed_queries import STOCK_DAY
from showcase.registry import ORACLES, new_folder, query, table
from tradeloom.operators import realization
from tradeloom.plans import daily, facts
from tradeloom.sources import landing, sinks

SPAN = 150


def codes(spark, sf):
    return table(spark, sf, "part").selectExpr("lpad(p_partkey, 13, '0') as barcode", "concat('P', p_partkey) as item_id")


def _orders(spark, sf):
    return facts.report_orders(fact_orders(spark, sf), codes(spark, sf))


def _stock(spark, sf):
    return facts.report_stock(fact_stock(spark, sf), codes(spark, sf))


_ITEM = "coalesce(item_id, x.barcode, x.sku) AS item"
_CHAIN = f"""code AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 13, '0') AS barcode, 'P' || p_partkey AS item_id FROM part),
    f AS (SELECT CAST(CAST(order_ts AS TIMESTAMP) AS DATE) AS day, source, owner, warehouse, {_ITEM}, sku,
        CAST(quantity AS DECIMAL(18,2)) AS quantity, CAST(amount AS DECIMAL(18,2)) AS amount, is_cancelled
        FROM ({ORACLES['fact_orders']}) AS x LEFT JOIN code ON x.barcode = code.barcode),
    s AS (SELECT CAST(stock_date AS DATE) AS stock_date, source, owner, warehouse, {_ITEM},
        CAST(quantity AS DECIMAL(18,2)) AS quantity FROM ({ORACLES['fact_stock']}) AS x LEFT JOIN code ON x.barcode = code.barcode)"""


def _both(keys: str) -> str:
    """Orders of the span and stock of the day, as a union grouped once."""
    return f"""u AS (SELECT {keys}, quantity AS q, amount AS a, 0 AS st FROM f WHERE NOT is_cancelled
            AND day > DATE '2001-11-30' - {SPAN} AND day <= DATE '2001-11-30'
        UNION ALL SELECT {keys}, 0, 0, 0 FROM f WHERE is_cancelled AND day > DATE '2001-11-30' - {SPAN} AND day <= DATE '2001-11-30'
        UNION ALL SELECT {keys}, 0, 0, quantity FROM s WHERE stock_date = DATE '2001-11-30'),
    m AS (SELECT {keys}, sum(q) AS quantity, sum(a) AS amount, sum(st) AS stock FROM u GROUP BY {keys})"""


_SHORT = f"greatest(CAST(quantity AS DOUBLE) * 14 - CAST(stock AS DOUBLE) * {SPAN}, 0) / {SPAN}.0::DOUBLE AS shortage"


@query("chain_stock_shortage", f"""WITH {_CHAIN}, {_both('source, owner, warehouse, item')}
    SELECT source, owner, warehouse, item, CAST(stock AS DOUBLE) AS stock, CAST(quantity AS DOUBLE) / {SPAN}.0::DOUBLE AS avg_sale,
        {_SHORT}, stock = 0 AS out_of_stock FROM m WHERE quantity > 0""")
def chain_stock_shortage(spark, sf):
    """Feeds to staged rows to facts to the report, as one plan."""
    return daily.stock_shortage(_orders(spark, sf), _stock(spark, sf), STOCK_DAY, days=SPAN)


@query("chain_item_report", f"""
    WITH {_CHAIN}, d AS (SELECT item, day, sum(quantity) AS quantity, sum(amount) AS amount FROM f
        WHERE NOT is_cancelled AND day <= DATE '2001-06-30' GROUP BY ALL)
    SELECT item, CAST(day AS VARCHAR) AS day, CAST(quantity AS DOUBLE) AS quantity, CAST(amount AS DOUBLE) AS amount,
        CAST(sum(quantity) OVER (PARTITION BY item ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)
            AS DOUBLE) AS quantity_7d,
        CAST(sum(quantity) OVER (PARTITION BY item ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)
            AS DOUBLE) AS quantity_30d FROM d""")
def chain_item_report(spark, sf):
    return daily.item_report(_orders(spark, sf), date(2001, 6, 30))


@query("chain_product_report", f"""WITH {_CHAIN}, {_both('owner, item')},
    r AS (SELECT owner, p_brand AS brand, CAST(grouping(owner) * 2 + grouping(p_brand) AS INT) AS level, sum(quantity) AS quantity,
        sum(amount) AS amount, sum(stock) AS stock FROM m LEFT JOIN part ON item = 'P' || p_partkey GROUP BY ROLLUP (owner, p_brand))
    SELECT owner, brand, level, CAST(quantity AS DOUBLE) AS quantity, CAST(amount AS DOUBLE) AS amount,
        CAST(stock AS DOUBLE) AS stock, {_SHORT} FROM r""")
def chain_product_report(spark, sf):
    return daily.product_report(_orders(spark, sf), _stock(spark, sf), items_dim(spark, sf), STOCK_DAY, days=SPAN)


@query("chain_orders_by_day", f"""WITH {_CHAIN}
    SELECT CAST(day AS VARCHAR) AS report_date, owner, source, sku, count(*) AS orders,
        CAST(sum(quantity) AS DOUBLE) AS quantity, CAST(sum(amount) AS DOUBLE) AS amount,
        count(*) FILTER (is_cancelled) AS cancelled FROM f WHERE day = DATE '2000-03-14' GROUP BY ALL""")
def chain_orders_by_day(spark, sf):
    started = spark.sql("select 5L as id, 'COMPLETED' as status, timestamp_ntz'2000-03-15 01:00:00' as start_date")
    return daily.orders_by_day(_orders(spark, sf), started, 5, "order_ts")


_LINE_CELLS = ("num, n, o_custkey, 'p' || o_custkey, lpad(CAST(o_custkey AS VARCHAR), 13, '0'), 'of-' || o_custkey, '5.0', total, total,"
               " total, '0.0', '0.0', total, n, '0.0', '0.0', '0.0', '0.0', '0.0', '0'")


@query("exported_realization", f"""
    WITH t AS (SELECT *, CAST(o_orderkey AS VARCHAR) AS num, CAST(o_totalprice AS VARCHAR) AS total FROM orders)
    SELECT '0' AS section, '{"|".join(label for _, label in realization.HEADER_LABELS)}' AS cells
    UNION ALL SELECT '1', '{"|".join(["num", *[label for _, label in realization.LINE_LABELS]])}'
    UNION ALL SELECT '0', concat_ws('|', num, strftime(o_orderdate, '%Y-%m-%d'), '2020-01-01', 'c' || o_custkey, 'RUB', total, total,
        '1', '2', 'payer', '3', '4', 'customer ' || o_custkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d'),
        strftime(last_day(o_orderdate), '%Y-%m-%d')) FROM t
    UNION ALL SELECT '1', concat_ws('|', {_LINE_CELLS}) FROM t, (SELECT '1' AS n UNION ALL SELECT '2')""")
def exported_realization(spark, sf):
    """A report of two sections, each with a row of its labels, some of which repeat; read back as text."""
    folder = new_folder(spark, "realization")
    pages = feeds.realization(table(spark, sf, "orders"))
    sections = [(realization.header_rows(pages), [label for _, label in realization.HEADER_LABELS]),
                (realization.line_rows(pages), ["num", *[label for _, label in realization.LINE_LABELS]])]
    sinks.export_labelled(sections, folder)
    out = None
    for i, (rows, _) in enumerate(sections):
        schema = ", ".join(f"c{k} string" for k in range(len(rows.columns)))
        cells = landing.labelled_section(spark, folder, i, schema).select(
            F.lit(str(i)).alias("section"), F.concat_ws("|", *[f"c{k}" for k in range(len(rows.columns))]).alias("cells"))
        out = cells if out is None else out.unionByName(cells)
    return out


_QUARTER = "date_trunc('quarter', o_orderdate)"
_REPORT = f"""SELECT CASE o_orderstatus WHEN 'F' THEN 'FBO' ELSE 'FBS' END AS scheme, CAST(CAST({_QUARTER} AS DATE) AS VARCHAR) AS period_from,
    CAST(CAST({_QUARTER} + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS period_to, 'c' || o_custkey AS c9 FROM orders"""


def _reports(spark, sf) -> str:
    """Posting reports, a file for each scheme and quarter, under the names such reports have."""
    folder = new_folder(spark, "reports")
    orders = table(spark, sf, "orders").selectExpr(
        "if(o_orderstatus = 'F', 'fbo', 'fbs') as scheme", "date_trunc('quarter', o_orderdate) as q", "o_custkey", "o_orderkey")
    named = orders.selectExpr(
        "concat('orders_', scheme, '_', date_format(q, 'yyyyMMdd'), '_', date_format(q + interval 3 month - interval 1 day, 'yyyyMMdd')) as name",
        *[f"concat('v', o_orderkey, '-{i}') as c{i}" for i in range(9)], "concat('c', o_custkey) as c9", "'last' as c10")
    named.repartition("name").write.partitionBy("name").options(header="true", sep=";", escape='"').csv(f"{folder}/raw")
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(fs_path(f"{folder}/named"))
    for part in fs.globStatus(fs_path(f"{folder}/raw/name=*/*.csv")):
        name = part.getPath().getParent().getName().removeprefix("name=")
        fs.rename(part.getPath(), fs_path(f"{folder}/named/{name}.csv"))
    return f"{folder}/named"


@query("landed_reports", _REPORT)
def landed_reports(spark, sf):
    """Scheme and period come from the file names."""
    found = landing.report_files(spark, _reports(spark, sf), [f"c{i}" for i in range(11)])
    return found.select("scheme", "period_from", "period_to", "c9")


@query("landed_report_ids", "SELECT DISTINCT 'c' || o_custkey AS id FROM orders")
def landed_report_ids(spark, sf):
    return landing.report_ids(spark, _reports(spark, sf))
