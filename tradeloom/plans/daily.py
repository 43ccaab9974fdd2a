"""Daily stock, shortage, cluster, item and product reports.

Inputs are facts that hold an `item`: orders (day, source, owner, warehouse,
item, quantity, amount, is_cancelled) and stock (stock_date, source, owner,
warehouse, item, quantity). The definitions are ours; see the README.

Orders and stock are not joined. Both are projected to the same keys with their
own measure and grouped once as a union: one shuffle, partial sums in front of
it, and pairs that only one side knows need no outer join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.common import as_value
from tradeloom.functions.numbers import MONEY

SALE_DAYS = 30
COVER_DAYS = 14
PAIR = ["source", "owner", "warehouse", "item"]

_MEASURES = ("orders", "quantity", "amount", "cancelled", "stock")


def _zero(kind: str) -> Column:
    return F.lit(0).cast(kind)


def _kind(measure: str) -> str:
    return "bigint" if measure in ("orders", "cancelled") else MONEY


def _live() -> Column:
    """A missing flag means not cancelled."""
    return ~F.coalesce("is_cancelled", F.lit(False))


def _in_window(day: Column, on, days: int) -> Column:
    last = as_value(on).cast("date")
    return (day > F.date_sub(last, days)) & (day <= last)


def _order_part(orders: DataFrame, keys: list[str], on, days: int) -> DataFrame:
    """Orders of the last days; cancelled ones only count as cancelled."""
    live = _live()
    return orders.filter(_in_window(F.col("day"), on, days)).select(
        *keys, F.lit(1).cast("bigint").alias("orders"),
        F.when(live, F.col("quantity")).otherwise(_zero(MONEY)).cast(MONEY).alias("quantity"),
        F.when(live, F.col("amount")).otherwise(_zero(MONEY)).cast(MONEY).alias("amount"),
        F.when(live, 0).otherwise(1).cast("bigint").alias("cancelled"),
        _zero(MONEY).alias("stock"),
    )


def _stock_part(stock: DataFrame, keys: list[str], on) -> DataFrame:
    return stock.filter(F.col("stock_date") == as_value(on).cast("date")).select(
        *keys, *[_zero(_kind(m)).alias(m) for m in _MEASURES if m != "stock"],
        F.col("quantity").cast(MONEY).alias("stock"))


def _sums(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(m).cast(_kind(m)).alias(m) for m in _MEASURES])


def pair_measures(orders: DataFrame, stock: DataFrame, on, days: int = SALE_DAYS,
                  keys: list[str] | None = None) -> DataFrame:
    """Orders of the last days and stock of the day per key."""
    keys = keys or PAIR
    return _sums(_order_part(orders, keys, on, days).unionByName(_stock_part(stock, keys, on)), keys)


def _shortage(days: int, cover: int) -> Column:
    """Quantity missing for the cover time, floor zero; exact until the last division."""
    need = F.col("quantity") * cover - F.col("stock") * days
    return (F.greatest(need, F.lit(0)).cast("double") / F.lit(float(days))).alias("shortage")


def _avg_sale(days: int) -> Column:
    return (F.col("quantity").cast("double") / F.lit(float(days))).alias("avg_sale")


def _short_rows(sums: DataFrame, keys: list[str], days: int, cover: int) -> DataFrame:
    return sums.filter(F.col("quantity") > 0).select(
        *keys, "stock", _avg_sale(days), _shortage(days, cover), (F.col("stock") == 0).alias("out_of_stock"))


def daily_stock(stock: DataFrame, on) -> DataFrame:
    """Stock of the day per source, owner, warehouse and item."""
    return stock.filter(F.col("stock_date") == as_value(on).cast("date")).groupBy(*PAIR) \
        .agg(F.sum("quantity").cast(MONEY).alias("quantity"))


def stock_shortage(orders: DataFrame, stock: DataFrame, on, days: int = SALE_DAYS,
                   cover: int = COVER_DAYS) -> DataFrame:
    """Pairs that sold lately, with what they lack for the cover time."""
    return _short_rows(pair_measures(orders, stock, on, days), PAIR, days, cover)


def sales_vs_stock(sales: DataFrame, stock: DataFrame, on) -> DataFrame:
    """Sales of the day beside its stock; a pair may occur on one side only."""
    return pair_measures(sales, stock, on, 1).select(
        *PAIR, F.col("quantity").alias("sold"), F.col("amount"), F.col("stock"))


def _clusters(pairs: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Add the cluster of the warehouse; an unknown warehouse is in cluster NONE."""
    dim = warehouses.select(F.col("code").alias("warehouse"), "source", "cluster")
    return pairs.join(dim, ["warehouse", "source"], "left") \
        .withColumn("cluster", F.coalesce("cluster", F.lit("NONE")))


def cluster_shortage(orders: DataFrame, stock: DataFrame, warehouses: DataFrame, on, days: int = SALE_DAYS,
                     cover: int = COVER_DAYS) -> DataFrame:
    """Shortage per cluster and item, over the sums of the cluster."""
    keys = ["cluster", "item"]
    pairs = pair_measures(orders, stock, on, days, ["source", "warehouse", "item"])
    return _short_rows(_sums(_clusters(pairs, warehouses), keys), keys, days, cover)


def cluster_report(orders: DataFrame, stock: DataFrame, warehouses: DataFrame, on, days: int = SALE_DAYS,
                   cover: int = COVER_DAYS) -> DataFrame:
    """Totals per owner and cluster with days of cover."""
    keys = ["owner", "cluster"]
    pairs = pair_measures(orders, stock, on, days, ["source", "owner", "warehouse"])
    sale = F.nullif(F.col("quantity").cast("double"), F.lit(0.0))
    return _sums(_clusters(pairs, warehouses), keys).select(
        *keys, *_MEASURES, _shortage(days, cover),
        (F.col("stock").cast("double") * F.lit(float(days)) / sale).alias("cover_days"))


def item_shortage(orders: DataFrame, stock: DataFrame, on, days: int = SALE_DAYS,
                  cover: int = COVER_DAYS) -> DataFrame:
    """Shortage per item over all warehouses."""
    return _short_rows(pair_measures(orders, stock, on, days, ["item"]), ["item"], days, cover)


def item_report(orders: DataFrame, until, spans: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Daily quantity per item with moving sums, up to a day.

    Rows are summed per item and day first, so a window holds at most one row
    per day, however often an item sold.
    """
    live = orders.filter(_live() & (F.col("day") <= as_value(until).cast("date")))
    daily = live.groupBy("item", "day").agg(
        F.sum("quantity").cast(MONEY).alias("quantity"), F.sum("amount").cast(MONEY).alias("amount"))
    at = F.datediff(F.col("day"), F.lit("1970-01-01").cast("date"))
    by_day = Window.partitionBy("item").orderBy(at)
    return daily.select("*", *[
        F.sum("quantity").over(by_day.rangeBetween(1 - n, 0)).cast(MONEY).alias(f"quantity_{n}d") for n in spans])


def product_shortage(orders: DataFrame, stock: DataFrame, items: DataFrame, on, days: int = SALE_DAYS,
                     cover: int = COVER_DAYS) -> DataFrame:
    """Shortage per brand and category. `items` holds one row per item."""
    keys = ["brand", "category"]
    pairs = pair_measures(orders, stock, on, days, ["item"])
    return _short_rows(_sums(pairs.join(items.select("item", *keys), ["item"], "left"), keys), keys, days, cover)


def product_report(orders: DataFrame, stock: DataFrame, items: DataFrame, on, days: int = SALE_DAYS,
                   cover: int = COVER_DAYS) -> DataFrame:
    """Totals per owner and brand with sub-totals per owner and a grand total.

    The rollup runs over the finished (owner, brand) sums, not over the facts,
    which it would multiply by three.
    """
    pairs = pair_measures(orders, stock, on, days, ["owner", "item"])
    brands = _sums(pairs.join(items.select("item", "brand"), ["item"], "left"), ["owner", "brand"])
    rolled = brands.rollup("owner", "brand").agg(
        *[F.sum(m).cast(_kind(m)).alias(m) for m in _MEASURES], F.grouping_id().cast("int").alias("level"))
    return rolled.select("owner", "brand", "level", "quantity", "amount", "stock", _shortage(days, cover))


def _orders_of(orders: DataFrame, started: DataFrame, ts: str | None) -> DataFrame:
    """Orders of the day before the given start, which is at most one row.

    The day is a scalar subquery: it is known before the orders are read, so a filter on a stored
    column reaches their scan. Where the orders store a time and derive the day from it, `ts` names
    that column, and its two limits are pushed.
    """
    day = F.date_sub(F.col("start_date").cast("date"), 1)
    at = started.select(day.alias("day")).scalar()
    if ts is None:
        kept = orders.filter(F.col("day") == at)
    else:
        first, last = (started.select(d.cast("timestamp_ntz").alias("at")).scalar() for d in (day, F.date_add(day, 1)))
        kept = orders.filter((F.col(ts) >= first) & (F.col(ts) < last))
    return kept.groupBy("day", "owner", "source", "sku").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("quantity").cast(MONEY).alias("quantity"),
        F.sum("amount").cast(MONEY).alias("amount"),
        F.count(F.when(F.col("is_cancelled"), 1)).alias("cancelled"),
    ).withColumnRenamed("day", "report_date")


def committed(rows: DataFrame, transactions: DataFrame, tx: str = "transaction_id") -> DataFrame:
    """Rows that a completed transaction loaded.

    Where rows are stored in a folder per transaction, the ledger is read first and only the folders
    of completed transactions after it (dynamic partition pruning).
    """
    done = transactions.filter(F.col("status") == "COMPLETED").select(F.col("id").alias("_done"))
    return rows.join(done, rows[tx] == done["_done"], "left_semi")


def orders_by_day(orders: DataFrame, transactions: DataFrame, tx, ts: str | None = None, loaded_by: str | None = None) -> DataFrame:
    """Orders of the day before a completed transaction started, per owner, source and SKU.

    `loaded_by` names the column that holds the transaction which loaded a row; rows of transactions
    that are not completed, or that the ledger does not know, then do not count.
    """
    done = (F.col("id") == as_value(tx)) & (F.col("status") == "COMPLETED")
    kept = orders if loaded_by is None else committed(orders, transactions, loaded_by)
    return _orders_of(kept, transactions.filter(done), ts)


def orders_by_last_completed(orders: DataFrame, transactions: DataFrame, ts: str | None = None, loaded_by: str | None = None) -> DataFrame:
    """The same for the completed transaction of the highest id."""
    last = transactions.filter(F.col("status") == "COMPLETED").agg(F.max_by("start_date", "id").alias("start_date"))
    return _orders_of(orders if loaded_by is None else committed(orders, transactions, loaded_by), last, ts)
