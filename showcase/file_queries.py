"""Queries that pass whole tables through landed files and sinks.

A feed is written to a new folder below the shared one, read by the reader of
that feed and processed from there, as it is in production.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from showcase import feeds
from showcase.feed_queries import _DETAIL, OWNER, RUN, SINCE, STOCK_DAY
from showcase.registry import ORACLES, broken, fails, new_folder, query, table
from tradeloom.operators import advertising, postings, prices, products, realization, state, stock, wb
from tradeloom.sources import landing, sinks

FILE_DOCUMENTS = 200_000


def _landed(spark, df, feed: str):
    """Documents of a feed after a trip through JSON files, one document per line.

    The files are packed, as field names are most of their bytes; a packed file is read by one task, so its documents are bounded.
    """
    folder = new_folder(spark, feed)
    df.write.options(compression="gzip", maxRecordsPerFile=FILE_DOCUMENTS).json(folder)
    return landing.strict(landing.pages(spark, folder, feed, lines=True))


@query("landed_postings", ORACLES["flatten_postings"])
def landed_postings(spark, sf):
    pages = feeds.fbo(feeds.lines(spark, sf)).select("result")
    return postings.flatten_fbo(_landed(spark, pages, "fbo"), OWNER, RUN, SINCE)


@query("landed_wb_orders", ORACLES["wb_order_lines"])
def landed_wb_orders(spark, sf):
    docs = _landed(spark, feeds.wb_orders(feeds.line_items(spark, sf)), "wb_orders")
    return wb.order_lines(docs, OWNER, RUN, SINCE)


@query("landed_stock", ORACLES["ozon_stock_older"])
def landed_stock(spark, sf):
    pages = _landed(spark, feeds.analytics_stock(feeds.line_items(spark, sf)), "analytics_stock")
    return stock.older_stock_lines(pages, OWNER, STOCK_DAY)


@query("landed_prices", ORACLES["price_offers"])
def landed_prices(spark, sf):
    pages = _landed(spark, feeds.prices(feeds.line_items(spark, sf)), "prices")
    return prices.price_offers(pages, RUN, datetime(2024, 2, 1, 6), tz="Etc/GMT-3")


@query("landed_realization", ORACLES["realization_lines"])
def landed_realization(spark, sf):
    return realization.line_rows(_landed(spark, feeds.realization(table(spark, sf, "orders")), "realization"))


@query("landed_kz_stock", ORACLES["kz_stock"])
def landed_kz_stock(spark, sf):
    folder = new_folder(spark, "kz")
    feeds.kz_stock(feeds.line_items(spark, sf)).write.option("header", "true").option("escape", '"').csv(folder)
    return stock.kz_stock_lines(landing.kz_stock_file(spark, folder), OWNER, RUN, STOCK_DAY)


@query("landed_products", """
    WITH o AS (SELECT * FROM part, (SELECT 'BUILDING' AS owner UNION ALL SELECT 'MACHINERY') WHERE owner = 'BUILDING' OR p_size > 5),
    d AS (SELECT *, 1 AS day, 'bc-' AS code FROM o UNION ALL SELECT *, 2, 'late-' FROM o WHERE p_size > 25),
    e AS (SELECT owner, p_partkey, day, code, p_partkey + 1 AS sku FROM d
        UNION ALL SELECT owner, p_partkey, day, code, p_partkey + 2 FROM d WHERE p_size <= 10)
    SELECT owner, CAST(sku AS VARCHAR) AS sku, code || owner || p_partkey AS barcode FROM e
    QUALIFY row_number() OVER (PARTITION BY owner, sku ORDER BY day DESC, p_partkey DESC) = 1""")
def landed_products(spark, sf):
    """Pages of two load days in folders of day and owner; the later day repeats some products with another barcode."""
    folder, parts = new_folder(spark, "products"), feeds.owned_parts(spark, sf)
    for day, rows, code in ((1, parts, "bc-"), (2, parts.filter("p_size > 25"), "late-")):
        pages = feeds.products(rows, "owner", barcode=f"concat('{code}', owner, p_partkey)").drop("page")
        pages.withColumn("day", F.lit(day)).write.mode("append").partitionBy("day", "owner").json(folder)
    return products.sku_barcodes(landing.strict(landing.pages(spark, folder, "products", lines=True)))


@query("landed_detail", "SELECT " + ", ".join(
    f"{_DETAIL.get(k, 'CAST(NULL AS VARCHAR)')} AS {k}" for k in realization.DETAIL_LABELS) + " FROM lineitem")
def landed_detail(spark, sf):
    """Realization rows through the reader of all 61 fields; those the source left out are null."""
    folder = new_folder(spark, "detail")
    feeds.realization_detail(feeds.line_items(spark, sf)).write.json(folder)
    return landing.realization_detail(spark, folder, [*realization.DETAIL_LABELS], lines=True)


@query("landed_ad_orders", ORACLES["ad_orders"])
def landed_ad_orders(spark, sf):
    folder = new_folder(spark, "ads")
    feeds.ad_orders(feeds.line_items(spark, sf)).write.options(header="true", sep=";", escape='"').csv(folder)
    return advertising.order_rows(landing.ad_sheet(spark, folder), OWNER, "doc")


@query("staged_text", f"SELECT * REPLACE (NULLIF(sticker, '') AS sticker) FROM ({ORACLES['wb_order_lines']})")
def staged_text(spark, sf):
    """Staged rows through tab text with a fixed schema; an empty field reads as null."""
    folder = new_folder(spark, "staged")
    rows = wb.order_lines(feeds.wb_orders(feeds.line_items(spark, sf)), OWNER, RUN, SINCE)
    rows.write.options(sep="\t", escape='"').csv(folder)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return landing.good(landing.staged_text(spark, folder, schema))


_OWNED_DAYS = """SELECT c_mktsegment AS owner_code, o_orderkey AS id, o_totalprice AS amount FROM orders
    JOIN customer ON o_custkey = c_custkey"""


def _owned_orders(spark, sf):
    return table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")) \
        .selectExpr("c_mktsegment as owner_code", "o_orderkey as id", "o_totalprice as amount")


@query("replaced_files", f"""
    SELECT * FROM ({_OWNED_DAYS}) WHERE owner_code NOT IN ('BUILDING', 'MACHINERY')
    UNION ALL SELECT owner_code, id, -amount FROM ({_OWNED_DAYS}) WHERE owner_code = 'BUILDING'""")
def replaced_files(spark, sf):
    """Load all owners, then replace the slices of two of them, one of which comes back empty.

    An earlier try of that load fails half-way and leaves the slices as they were.
    """
    folder = new_folder(spark, "slices")
    rows = _owned_orders(spark, sf)
    sinks.replace_slices(rows, folder, ["owner_code"], hot_files=8)
    fresh = rows.filter("owner_code = 'BUILDING'").withColumn("amount", -F.col("amount"))
    asked = [{"owner_code": "BUILDING"}, {"owner_code": "MACHINERY"}]
    fails(lambda: sinks.replace_slices(broken(fresh, "amount"), folder, ["owner_code"], hot_files=8, slices=asked))
    sinks.replace_slices(fresh, folder, ["owner_code"], hot_files=8, slices=asked)
    return spark.read.parquet(folder)


@query("split_files", _OWNED_DAYS)
def split_files(spark, sf):
    folder = new_folder(spark, "split")
    sinks.write_split(_owned_orders(spark, sf), folder, sinks.rows_per_file(row_bytes=40), empty="no data")
    return spark.read.parquet(folder)


@query("capped_files", _OWNED_DAYS)
def capped_files(spark, sf):
    """The same in files of at most 64 KB, whatever the rows' sizes."""
    folder = new_folder(spark, "capped")
    sinks.write_capped(_owned_orders(spark, sf), folder, 64 << 10)
    assert max(r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).groupBy().max("length").collect()) <= 64 << 10
    return landing.good(landing.staged_text(spark, folder, "owner_code string, id long, amount double")).drop("piece")


@query("split_pages", f"""SELECT 'good' AS side, CAST(o_orderkey AS VARCHAR) AS id, o_custkey AS quantity FROM orders WHERE o_orderkey % 5 <> 0
    UNION ALL SELECT 'bad', CAST(o_orderkey AS VARCHAR), NULL FROM orders WHERE o_orderkey % 5 = 0""")
def split_pages(spark, sf):
    """Pages of which each fifth cannot be read: parsed once, both kinds kept in folders of their own."""
    folder = new_folder(spark, "split-pages")
    page = "'{{\"items\":[{{\"id\":\"' || o_orderkey || '\",\"quantity\":' || if(o_orderkey % 5 = 0, '[', '') || o_custkey || '}}]}}'".format()
    table(spark, sf, "orders").selectExpr(f"{page} as value").write.text(f"{folder}/landed")
    landing.split(landing.pages(spark, f"{folder}/landed", "erp_stock", lines=True), f"{folder}/good", f"{folder}/bad")
    good = spark.read.parquet(f"{folder}/good").select(F.lit("good").alias("side"), F.explode("items").alias("i"))
    bad = spark.read.parquet(f"{folder}/bad").select(
        F.lit("bad").alias("side"), F.regexp_extract(landing.CORRUPT, '"id":"([0-9]+)"', 1).alias("id"), F.lit(None).cast("bigint").alias("quantity"))
    return good.select("side", F.col("i.id").alias("id"), F.col("i.quantity").cast("bigint").alias("quantity")).unionByName(bad)


@query("exported_report", f"""SELECT owner_code AS "Организация", CAST(id AS VARCHAR) AS "Номер строки",
    CAST(amount AS VARCHAR) AS "Сумма продаж (возвратов)" FROM ({_OWNED_DAYS})""")
def exported_report(spark, sf):
    """Quoted export under report labels, read back as text."""
    folder = new_folder(spark, "export")
    labels = {"owner_code": "Организация", "id": "Номер строки", "amount": "Сумма продаж (возвратов)"}
    sinks.export(realization.labelled(_owned_orders(spark, sf), labels), folder)
    return spark.read.options(header="true", sep=";", escape='"').csv(folder)


@query("upserted_files", """
    SELECT p_partkey AS id, p_name AS name FROM part
    UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT p_partkey FROM part)""")
def upserted_files(spark, sf):
    """Upsert between two versions of a dimension folder; applied twice it changes nothing more."""
    folder = new_folder(spark, "dim")
    staged = table(spark, sf, "part").selectExpr("p_partkey as id", "p_name as name")
    sinks.load(table(spark, sf, "customer").selectExpr("c_custkey as id", "c_name as name"), f"{folder}/v1")
    sinks.load(state.upsert(spark.read.parquet(f"{folder}/v1"), staged, ["id"], ["name"]), f"{folder}/v2")
    return state.upsert(spark.read.parquet(f"{folder}/v2"), staged, ["id"], ["name"])
