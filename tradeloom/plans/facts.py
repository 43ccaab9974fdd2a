"""Conformed facts and dictionaries from staged rows.

The bodies of these merges are our own definition; see the README.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.common import as_value
from tradeloom.functions.numbers import MONEY, money
from tradeloom.functions.times import iso_ts
from tradeloom.operators.dedup import latest_version
from tradeloom.operators.state import replace_from, upsert
from tradeloom.sources import published

ORDER_KEY = ["source", "owner", "order_key", "sku"]
ORDER_COLUMNS = [
    *ORDER_KEY, "order_ts", "change_ts", "quantity", "amount", "is_cancelled", "warehouse", "region", "schema",
    "barcode",
]
STOCK_COLUMNS = ["stock_date", "source", "owner", "warehouse", "sku", "barcode", "quantity"]


def wb_orders(staged: DataFrame) -> DataFrame:
    """Staged WB orders as fact rows; the feed holds one piece per row."""
    return staged.select(
        F.lit("WB").alias("source"), F.col("owner_code").alias("owner"), F.col("srid").alias("order_key"),
        F.col("nm_id").cast("string").alias("sku"), iso_ts("date").alias("order_ts"),
        iso_ts("last_change_date").alias("change_ts"), F.lit(1).cast(MONEY).alias("quantity"),
        money("price_with_disc").alias("amount"), F.coalesce("is_cancel", F.lit(False)).alias("is_cancelled"),
        F.col("warehouse_name").alias("warehouse"), F.col("region_name").alias("region"),
        F.col("order_type").alias("schema"), "barcode",
    )


def ozon_orders(staged: DataFrame) -> DataFrame:
    """Staged postings as fact rows; lines of equal SKU in a posting are added up."""
    rows = staged.select(
        F.lit("OZON").alias("source"), F.col("owner_code").alias("owner"), F.col("posting_number").alias("order_key"),
        F.col("sku").cast("string").alias("sku"), iso_ts("created_at", zulu=True, fraction=True).alias("order_ts"),
        iso_ts("in_process_at", zulu=True, fraction=True).alias("change_ts"), money("quantity").alias("quantity"),
        (money("price") * F.col("quantity")).cast(MONEY).alias("amount"),
        F.coalesce(F.col("status") == "cancelled", F.lit(False)).alias("is_cancelled"), F.col("warehouse_name").alias("warehouse"),
        "region", "schema", F.lit(None).cast("string").alias("barcode"),
    )
    measures = ("quantity", "amount")
    return rows.groupBy(*[c for c in ORDER_COLUMNS if c not in measures]).agg(
        *[F.sum(m).cast(MONEY).alias(m) for m in measures]).select(*ORDER_COLUMNS)


def wb_sales(staged: DataFrame) -> DataFrame:
    """Staged WB sales as fact rows; amounts keep their sign."""
    return staged.select(
        F.lit("WB").alias("source"), F.col("owner_code").alias("owner"), F.col("srid").alias("order_key"),
        F.col("nm_id").cast("string").alias("sku"), iso_ts("date").alias("order_ts"),
        iso_ts("last_change_date").alias("change_ts"), F.lit(1).cast(MONEY).alias("quantity"),
        money("for_pay").alias("amount"), F.lit(False).alias("is_cancelled"),
        F.col("warehouse_name").alias("warehouse"), F.col("region_name").alias("region"),
        F.col("sale_id").alias("schema"), "barcode",
    )


def latest_orders(staged: list[DataFrame]) -> DataFrame:
    """Latest version per order key and SKU.

    Rows without an order key are nobody's version: each stays, and only rows that are equal in all
    columns, as overlapping pages bring them, are one.
    """
    rows = _union(staged)
    own = F.when(F.col("order_key").isNull(), F.struct(*rows.columns)).alias("_own")
    ties = [c for c in rows.columns if c not in (*ORDER_KEY, "change_ts")]
    by = sorted(ORDER_KEY, key=lambda c: c != "order_key")
    return latest_version(rows.select("*", own), [*by, "_own"], "change_ts", ties).drop("_own")


def apply_orders(old: DataFrame, staged: list[DataFrame], date_from) -> DataFrame:
    """New order or sales fact: days before `date_from` stay, later days hold the latest staged versions.

    Versions are ranked before the range is cut: a key whose latest version lies before `date_from`
    has left the range, and an older version of it must not come back.
    """
    day = F.col("order_ts").cast("date")
    return replace_from(old, latest_orders(staged), day, date_from)


def _load_days(path: str, new: DataFrame, day: str, first, grain: str) -> int:
    """Publish the rows of `new` from the day `first` on; days of that range without rows are cleared.

    Slices are the days, or the weeks, months, quarters or years (`grain`) of a column of that name.
    Of a longer slice that begins before `first`, the earlier days are carried over; no other old row is read.
    """
    spark, limit, at = new.sparkSession, as_value(first).cast("date"), F.col(day)
    if grain == "day":
        return published.publish(new.filter(at >= limit), path, [day], gone=at >= limit)
    start = F.trunc(limit, grain)
    rows = new.filter(at >= limit).withColumn(grain, F.trunc(at, grain))
    if published.versions(spark, path):
        rows = rows.unionByName(published.read(spark, path).filter((F.col(grain) == start) & (at < limit)))
    return published.publish(rows, path, [grain], gone=F.col(grain) >= start)


def load_orders(path: str, staged: list[DataFrame], date_from, grain: str = "day") -> int:
    """`apply_orders` on a fact published by the day of the order: only slices from `date_from` on are written.

    `grain` sets their length, see `_load_days`. Rows without a time are in no slice.
    """
    new = latest_orders(staged).withColumn("day", F.col("order_ts").cast("date"))
    return _load_days(path, new, "day", date_from, grain)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for rows in frames[1:]:
        out = out.unionByName(rows)
    return out


def wb_stock(staged: DataFrame) -> DataFrame:
    return staged.select(
        F.col("create_at").alias("stock_date"), F.lit("WB").alias("source"), F.col("owner_code").alias("owner"),
        F.col("warehouse_name").alias("warehouse"), F.col("nmId").cast("string").alias("sku"), "barcode",
        money("quantity").alias("quantity"),
    )


def ozon_stock(staged: DataFrame) -> DataFrame:
    return staged.select(
        F.col("date").alias("stock_date"), F.lit("OZON").alias("source"), "owner", "warehouse", "sku", "barcode",
        money("quantity").alias("quantity"),
    )


def erp_stock(staged: DataFrame) -> DataFrame:
    """ERP stock knows items only: no owner, one warehouse."""
    return staged.select(
        "stock_date", F.lit("1C").alias("source"), F.lit(None).cast("string").alias("owner"),
        F.lit("1C").alias("warehouse"), F.col("item_id").alias("sku"), F.lit(None).cast("string").alias("barcode"),
        money("quantity").alias("quantity"),
    )


def kz_stock(staged: DataFrame) -> DataFrame:
    return staged.select(
        "stock_date", F.lit("KZ").alias("source"), "owner", F.lit("KZ").alias("warehouse"), "sku", "barcode",
        money("qnt").alias("quantity"),
    )


def apply_stock(old: DataFrame, staged: list[DataFrame], stock_date) -> DataFrame:
    """New stock fact: the rows of one date are replaced by the staged sums of that date.

    Serves the KZ feed as well; it is staged on its own and then replaces only
    its own source, see `apply_stock_of`.
    """
    on = as_value(stock_date).cast("date")
    return old.filter(F.coalesce(F.col("stock_date") != on, F.lit(True))).unionByName(_stock_sums(_union(staged), on))


def _stock_sums(staged: DataFrame, on) -> DataFrame:
    keys = [c for c in STOCK_COLUMNS if c != "quantity"]
    return staged.filter(F.col("stock_date") == on).groupBy(*keys).agg(F.sum("quantity").cast(MONEY).alias("quantity"))


def load_stock(path: str, staged: list[DataFrame], stock_date, source: str | None = None) -> int:
    """`apply_stock` on a fact published by date and source: only the slices of that date are written.

    With `source` only those of that source, as `apply_stock_of` does. Sources of the date that were
    not staged any more are cleared. No old row is read.
    """
    on = as_value(stock_date).cast("date")
    rows, gone = _stock_sums(_union(staged), on), F.col("stock_date") == on
    if source is not None:
        mine = F.col("source").eqNullSafe(F.lit(source))
        rows, gone = rows.filter(mine), gone & mine
    return published.publish(rows, path, ["stock_date", "source"], gone=gone)


def apply_stock_of(old: DataFrame, staged: DataFrame, stock_date, source: str) -> DataFrame:
    """The same for a single source; rows of other sources stay."""
    mine = F.col("source").eqNullSafe(F.lit(source))
    return old.filter(~mine).unionByName(apply_stock(old.filter(mine), [staged], stock_date))


def apply_dictionary(items: tuple[DataFrame, DataFrame], barcodes: tuple[DataFrame, DataFrame],
                     prices: tuple[DataFrame, DataFrame], order: tuple[str, ...] = ("page", "item_no")) -> dict[str, DataFrame]:
    """Upsert the three dictionaries, each given as (old, staged); the last staged row of a key wins.

    The staged rows carry `order`, as the row functions of the feed give it with `placed`.
    """
    return {
        "item": upsert(*items, keys=["id"], order=[*order]),
        "barcode": upsert(*barcodes, keys=["barcode_id"], order=[*order]),
        "barcode_price": upsert(*prices, keys=["barcode"], order=[*order]),
    }


def apply_ads(old: DataFrame, staged: DataFrame, report_date, days: int = 60) -> DataFrame:
    """Replace advertising facts from `days` before the report date on."""
    return replace_from(old, staged, "report_date", F.date_sub(as_value(report_date).cast("date"), days))


def load_ads(path: str, staged: DataFrame, report_date, days: int = 60, grain: str = "day") -> int:
    """`apply_ads` on a fact published by `report_date`: only the slices of the window are written."""
    return _load_days(path, staged, "report_date", F.date_sub(as_value(report_date).cast("date"), days), grain)


def with_items(rows: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Add `item`: the item of the barcode, else the barcode, else the SKU.

    A barcode of several items stands for the first of them.
    """
    one = barcodes.groupBy("barcode").agg(F.min("item_id").alias("_item")).withColumn("_part", F.lit(0).cast("bigint"))
    # Rows without a barcode, which may be most and match nothing, are dealt over all tasks. They are not
    # taken apart from the others: what gives the rows, such as the ranking of a fact, would run twice.
    part = F.when(F.col("barcode").isNull(), F.xxhash64(*rows.columns)).otherwise(F.lit(0).cast("bigint"))
    found = rows.withColumn("_part", part).join(one, ["barcode", "_part"], "left")
    return found.withColumn("item", F.coalesce("_item", "barcode", "sku")).select(*rows.columns, "item")


def report_orders(fact: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Order or sales fact as the daily reports read it: with `day` and `item`.

    A fact that stores the day keeps it: limits of a stored column reach the files, those of a cast do not.
    """
    found = with_items(fact, barcodes)
    return found if "day" in fact.columns else found.withColumn("day", F.col("order_ts").cast("date"))


def report_stock(fact: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Stock fact as the daily reports read it: with `item`."""
    return with_items(fact, barcodes)
