"""Queries over lookups, cursors, batches and table states."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from showcase import feeds
from showcase.registry import query, table
from tradeloom.functions.times import iso_ts, month_first, month_last, months_back, window_start
from tradeloom.operators import dedup, incremental, lookup, state, wb

# Links of the suppliers: one for orders each, one for stock unless in debt. `owner` is the supplier.
_LINKS = """links AS (
    SELECT CASE WHEN s_nationkey < 12 THEN 'WB' ELSE 'OZON' END AS source, s_name AS owner, 'ORDER' AS subject,
        'o' || s_suppkey AS connection_id FROM supplier
    UNION ALL SELECT CASE WHEN s_nationkey < 12 THEN 'WB' ELSE 'OZON' END, s_name, 'STOCK', 's' || s_suppkey
        FROM supplier WHERE s_acctbal >= 0)"""


def _links(spark, sf):
    source = F.expr("if(s_nationkey < 12, 'WB', 'OZON')").alias("source")
    both = F.explode(F.expr("if(s_acctbal >= 0, array('ORDER', 'STOCK'), array('ORDER'))")).alias("subject")
    return table(spark, sf, "supplier").select(source, F.col("s_name").alias("owner"), both, "s_suppkey").select(
        "source", "owner", "subject",
        F.expr("concat(if(subject = 'ORDER', 'o', 's'), s_suppkey)").alias("connection_id"))


@query("owner_connections", f"""WITH {_LINKS}
    SELECT source, owner,
        (SELECT connection_id FROM links i WHERE i.source = o.source AND i.owner = o.owner AND subject = 'ORDER')
            AS order_connection_id,
        (SELECT connection_id FROM links i WHERE i.source = o.source AND i.owner = o.owner AND subject = 'STOCK')
            AS stock_connection_id
    FROM (SELECT DISTINCT source, owner FROM links) o ORDER BY owner""")
def owner_connections(spark, sf):
    return lookup.connections(_links(spark, sf))


@query("connected_owners", f"""WITH {_LINKS}
    SELECT DISTINCT s_name AS owner, s_nationkey FROM supplier
    WHERE EXISTS (SELECT 1 FROM links WHERE owner = s_name AND subject = 'STOCK')""")
def connected_owners(spark, sf):
    owners = table(spark, sf, "supplier").select(F.col("s_name").alias("owner"), "s_nationkey").distinct()
    return lookup.limit_to(owners, _links(spark, sf).filter("subject = 'STOCK'"), ["owner"])


_LATEST = """SELECT user_id, event_type, event_id, ts, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1"""
LATEST_SQL = f"SELECT user_id, event_type, event_id, CAST(epoch_us(ts) AS BIGINT) AS ts_us, value FROM ({_LATEST})"


def events(spark, sf):
    """Change feed of the events; times as whole microseconds print alike everywhere."""
    return table(spark, sf, "events").select(
        "user_id", "event_type", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "value")


@query("latest_changes", LATEST_SQL)
def latest_changes(spark, sf):
    return dedup.latest_version(events(spark, sf), ["user_id", "event_type"], "ts_us", ["event_id", "value"])


@query("next_cursor", """
    SELECT 'orders' AS feed, CAST(max(l_shipdate) + INTERVAL 1 SECOND AS VARCHAR) AS cursor FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate >= TIMESTAMP '1998-05-15'
    UNION ALL SELECT 'sales', CAST(max(l_shipdate) + INTERVAL 1 SECOND AS VARCHAR) FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber <> 7""")
def next_cursor(spark, sf):
    """The order feed looks at kept rows only, the sale feed at all rows that name an order."""
    rows, since = feeds.lines(spark, sf), date(1998, 5, 15)
    kept = wb.recent_orders(feeds.wb_orders(rows, "o_orderdate"), since)
    known = wb.known_sales(feeds.wb_sales(rows, "o_orderdate"))
    change = iso_ts("lastChangeDate")
    one = incremental.next_cursor(kept, change, since=since).withColumn("feed", F.lit("orders"))
    two = incremental.next_cursor(known, change, since=since).withColumn("feed", F.lit("sales"))
    return one.unionByName(two)


@query("restart_point", """
    SELECT c_mktsegment AS owner, year(o_orderdate) AS year, CAST(greatest(max(struct_pack(page := l_linenumber, at := l_shipdate)).at,
        TIMESTAMP '1996-06-15') + INTERVAL 1 SECOND AS VARCHAR) AS restart_at FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def restart_point(spark, sf):
    """The line number stands for the number of the page; years before 1996 restart at the start of the range."""
    lines = feeds.owned_lines(spark, sf).withColumns({"year": F.year("o_orderdate").cast("bigint"), "no": F.col("l_linenumber")})
    each = feeds.fbo(lines, "owner", "year", "no").select("owner", "year", "no", F.explode("result.in_process_at").alias("at"))
    return incremental.restart_point(each, iso_ts("at", zulu=True, fraction=True), date(1996, 6, 15), "no", ["owner", "year"])


@query("requested_range", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '1995-04-01' AND o_orderdate < TIMESTAMP '1998-07-01'""")
def requested_range(spark, sf):
    """The orders a source is asked for, by a range of days."""
    asked = incremental.requested(table(spark, sf, "orders"), "o_orderdate", date(1995, 4, 1), date(1998, 7, 1))
    return asked.select("o_orderkey", "o_custkey", "o_totalprice")


_COUNTS = """counts AS (SELECT c_mktsegment AS owner, CASE l_linestatus WHEN 'O' THEN 'WB' ELSE 'OZON' END AS source,
    'order' AS type, count(*) AS qnt FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def _counts(spark, sf):
    rows = feeds.owned_lines(spark, sf).select(
        "owner", F.expr("if(l_linestatus = 'O', 'WB', 'OZON')").alias("source"), F.lit("order").alias("type"))
    return incremental.feed_counts(rows, ["owner", "source", "type"])


@query("feed_counts", f"WITH {_COUNTS} SELECT * FROM counts")
def feed_counts(spark, sf):
    return _counts(spark, sf)


@query("window_days", """
    WITH c AS (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey
        GROUP BY 1), q AS (SELECT c_custkey, CASE WHEN n > 3 THEN n * 300000 END AS qnt FROM c)
    SELECT c_custkey AS owner, qnt, CASE WHEN qnt IS NULL THEN 20 WHEN qnt = 0 THEN 15
        ELSE least(CAST(floor(60000.0::DOUBLE / (qnt / 45.0::DOUBLE)) AS INT), 45) END AS window_days FROM q""")
def window_days(spark, sf):
    """Customers as owners; those of few orders have no record."""
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("owner"))
    counts = incremental.feed_counts(orders, ["owner"]).filter("qnt > 3").withColumn("qnt", F.col("qnt") * 300000)
    owners = table(spark, sf, "customer").select(F.col("c_custkey").alias("owner"))
    return incremental.window_days(owners, counts, ["owner"])


def _transactions(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey as id", "if(o_orderstatus = 'F', 'COMPLETED', 'RUNNING') as status", "o_orderdate as start_date")


@query("last_transaction", "SELECT coalesce(max(o_orderkey), 0) AS id FROM orders WHERE o_orderstatus = 'F'")
def last_transaction(spark, sf):
    return incremental.last_completed(_transactions(spark, sf))


@query("key_batches", """
    WITH k AS (SELECT DISTINCT c_mktsegment AS owner, l_partkey AS sku FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        UNION ALL SELECT DISTINCT NULL, l_partkey FROM lineitem WHERE l_linestatus = 'O'),
    n AS (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY sku % 64, sku) - 1 AS place FROM k)
    SELECT owner, sku, place // 999 AS batch, CAST(place % 999 AS INT) AS position FROM n""")
def key_batches(spark, sf):
    """Open lines come without an owner as well."""
    keys = feeds.owned_lines(spark, sf).select(
        F.explode(F.expr("if(l_linestatus = 'O', array(owner, null), array(owner))")).alias("owner"), F.col("l_partkey").alias("sku"))
    return incremental.key_batches(keys, "owner", "sku", 999, spread=F.col("sku"), buckets=64)


@query("range_pieces", """
    WITH r AS (SELECT o_custkey AS owner, CAST(min(o_orderdate) AS DATE) AS first_day,
            CAST(max(o_orderdate) AS DATE) AS last_day FROM orders GROUP BY 1),
    p AS (SELECT *, unnest(generate_series(0, 60)) AS piece FROM r),
    f AS (SELECT *, CAST(first_day + to_months(CAST(3 * piece AS INT)) AS DATE) AS piece_from,
        least(CAST(first_day + to_months(CAST(3 * piece + 3 AS INT)) AS DATE), last_day) AS piece_to FROM p)
    SELECT owner, CAST(first_day AS VARCHAR) AS first_day, CAST(last_day AS VARCHAR) AS last_day,
        CAST(piece AS INT) AS piece, CAST(piece_from AS VARCHAR) AS piece_from, CAST(piece_to AS VARCHAR) AS piece_to
    FROM f WHERE piece = 0 OR piece_from < last_day""")
def range_pieces(spark, sf):
    day = F.col("o_orderdate").cast("date")
    ranges = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("owner")).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    return incremental.range_pieces(ranges, "first_day", "last_day")


@query("month_bounds", """
    SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d')
        AS first_day, strftime(last_day(o_orderdate), '%Y-%m-%d') AS last_day,
        strftime(last_day(o_orderdate) - INTERVAL 45 DAY, '%Y-%m-%d') AS window_from,
        strftime(last_day(o_orderdate) - INTERVAL 3 MONTH, '%Y-%m-%d') AS request_from FROM orders""")
def month_bounds(spark, sf):
    months = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month")).distinct()
    end = month_last("month")
    return months.select("month", month_first("month").alias("first_day"), end.alias("last_day"),
                         window_start(end).alias("window_from"), months_back(end).alias("request_from"))


@query("keyset_page", "SELECT event_id AS rrd_id, event_type, value FROM events WHERE event_id > 100"
                      " ORDER BY event_id LIMIT 40000")
def keyset_page(spark, sf):
    rows = table(spark, sf, "events").select(F.col("event_id").alias("rrd_id"), "event_type", "value")
    return incremental.keyset_page(rows, "rrd_id", 100, 40_000)


@query("merge_counts", f"""
    WITH {_COUNTS}, old AS (SELECT DISTINCT c_mktsegment AS owner, 'WB' AS source, t AS type, 1::BIGINT AS qnt
        FROM customer, (SELECT 'order' AS t UNION ALL SELECT 'sale'))
    SELECT coalesce(n.owner, o.owner) AS owner, coalesce(n.source, o.source) AS source,
        coalesce(n.type, o.type) AS type, coalesce(n.qnt, o.qnt) AS qnt
    FROM old o FULL JOIN counts n ON o.owner = n.owner AND o.source = n.source AND o.type = n.type""")
def merge_counts(spark, sf):
    owners = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("owner")).distinct()
    old = owners.select("owner", F.lit("WB").alias("source"), F.explode(F.array(F.lit("order"), F.lit("sale")))
                        .alias("type"), F.lit(1).cast("bigint").alias("qnt"))
    return state.upsert(old, _counts(spark, sf), ["owner", "source", "type"], ["qnt"])


_KINDS = """log AS (SELECT 'r' || user_id AS uuid, event_id AS seq, CASE event_type WHEN 'signup' THEN 'created'
    WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'loaded' ELSE 'polled' END AS kind,
    'own' || event_id AS owner_code, event_type AS type, 'st' || event_id AS status,
    CASE WHEN value > 50 THEN 'link' || event_id END AS link, CASE WHEN value < 20 THEN 'err' || event_id END AS error,
    'file' || event_id AS file_name FROM events)"""


@query("ledger_state", f"""
    WITH {_KINDS}, s AS (SELECT uuid, max(CASE WHEN kind = 'created' THEN seq END) AS c, max(seq) AS e,
            max(CASE WHEN kind = 'polled' THEN seq END) AS p, max(CASE WHEN kind = 'loaded' THEN seq END) AS l,
            max(CASE WHEN kind <> 'created' THEN seq END) AS x FROM log GROUP BY uuid)
    SELECT s.uuid, a.owner_code, a.type, b.status, d.link, f.error, g.file_name FROM s
        LEFT JOIN log a ON a.seq = s.c LEFT JOIN log b ON b.seq = s.e LEFT JOIN log d ON d.seq = s.p
        LEFT JOIN log f ON f.seq = s.x LEFT JOIN log g ON g.seq = s.l""")
def ledger_state(spark, sf):
    return state.request_ledger(request_log(spark, sf))


def request_log(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "concat('r', user_id) as uuid", "event_id as seq",
        "case event_type when 'signup' then 'created' when 'error' then 'failed' when 'purchase' then 'loaded'"
        " else 'polled' end as kind", "concat('own', event_id) as owner_code", "event_type as type",
        "concat('st', event_id) as status", "if(value > 50, concat('link', event_id), null) as link",
        "if(value < 20, concat('err', event_id), null) as error", "concat('file', event_id) as file_name")


@query("ledger_latest", """SELECT 'r' || user_id AS uuid, max(event_id) AS seq,
    arg_max(event_type, event_id) AS type FROM events GROUP BY 1""")
def ledger_latest(spark, sf):
    log = table(spark, sf, "events").selectExpr("concat('r', user_id) as uuid", "event_id as seq", "event_type as type")
    return state.current_state(log, "uuid", "seq")


@query("replace_slice", """
    SELECT o_custkey AS owner, o_orderkey AS id, o_totalprice AS amount FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    UNION ALL SELECT c_custkey, -1, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0""")
def replace_slice(spark, sf):
    """Owners in debt come back empty; they were asked for, so their old rows go, too."""
    old = table(spark, sf, "orders").selectExpr("o_custkey as owner", "o_orderkey as id", "o_totalprice as amount")
    asked = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").withColumn("owner", F.col("c_custkey"))
    new = asked.filter("c_acctbal > 0").selectExpr("owner", "-1L as id", "c_acctbal as amount")
    return state.replace_slice(old, new, ["owner"], asked)


_DAY_ROWS = ("SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS report_date, o_orderkey AS id,"
             " o_totalprice AS amount FROM orders")


def _day_rows(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "cast(o_orderdate as date) as report_date", "o_orderkey as id", "o_totalprice as amount")


@query("replace_day", f"""{_DAY_ROWS} WHERE o_orderdate <> TIMESTAMP '1998-06-15'
    UNION ALL SELECT '1998-06-15', c_custkey, c_acctbal FROM customer""")
def replace_day(spark, sf):
    new = table(spark, sf, "customer").selectExpr(
        "date'1998-06-15' as report_date", "c_custkey as id", "c_acctbal as amount")
    return state.replace_day(_day_rows(spark, sf), new, "report_date", date(1998, 6, 15), delete=True)


@query("replace_from", f"""{_DAY_ROWS} WHERE o_orderdate < TIMESTAMP '1998-06-15'
    UNION ALL SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR), l_partkey, l_extendedprice FROM lineitem
        WHERE l_shipdate >= TIMESTAMP '1998-06-15'""")
def replace_from(spark, sf):
    new = table(spark, sf, "lineitem").selectExpr(
        "cast(l_shipdate as date) as report_date", "l_partkey as id", "l_extendedprice as amount")
    return state.replace_from(_day_rows(spark, sf), new, "report_date", date(1998, 6, 15))


@query("delete_transaction_day", f"""{_DAY_ROWS}
    WHERE CAST(o_orderdate AS DATE) <> (SELECT CAST(o_orderdate AS DATE) - 1 FROM orders WHERE o_orderkey = 42)""")
def delete_transaction_day(spark, sf):
    return state.before_transaction(_day_rows(spark, sf), _transactions(spark, sf), "report_date", 42)


@query("insert_missing", """
    SELECT s_suppkey AS id, s_name AS name FROM supplier
    UNION ALL SELECT o_custkey, 'order ' || min(o_orderkey) FROM orders
        WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY o_custkey""")
def insert_missing(spark, sf):
    """Customers come as often as they order, and once without an id; the first order names them."""
    dim = table(spark, sf, "supplier").selectExpr("s_suppkey as id", "s_name as name")
    new = table(spark, sf, "orders").selectExpr(
        "explode(array(o_custkey, null)) as id", "concat('order ', o_orderkey) as name", "o_orderkey as at")
    return state.insert_missing(dim, new, ["id"], ["at"])
