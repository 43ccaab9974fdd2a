from datetime import date, datetime
from decimal import Decimal as D

from pyspark.sql import functions as F

from tradeloom.plans import daily, facts

DAY = date(2024, 3, 31)
ORDER = ("day date, source string, owner string, warehouse string, item string, sku string, quantity decimal(18,2),"
         " amount decimal(18,2), is_cancelled boolean")
STOCK = "stock_date date, source string, owner string, warehouse string, item string, quantity decimal(18,2)"


def order(day, item, n, cancelled=False, wh="W1", owner="A"):
    return (date(2024, 3, day), "WB", owner, wh, item, item, D(n), D(10 * n), cancelled)


def orders(spark):
    return spark.createDataFrame([
        order(31, "i", 30), order(2, "i", 30), order(1, "i", 900), order(30, "i", 500, True), order(31, "j", 6, wh="W2"),
        order(31, "k", 5, True)], ORDER)


def stock(spark):
    def row(day, item, n, wh="W1"):
        return (date(2024, 3, day), "WB", "A", wh, item, D(n))

    return spark.createDataFrame([row(31, "i", 10), row(31, "i", 5), row(30, "i", 999), row(31, "x", 7, "W3")], STOCK)


def test_daily_stock(spark, rows):
    assert rows(daily.daily_stock(stock(spark), DAY), "item", "quantity") == [("i", D(15)), ("x", D(7))]


def test_shortage_counts_live_orders_of_the_window_only(spark, rows):
    out = daily.stock_shortage(orders(spark), stock(spark), DAY)
    # i: 60 in 30 days is 2 a day, 28 for two weeks, 15 there; j: 0.2 a day, 2.8 needed, none there
    assert rows(out, "item", "stock", "avg_sale", "shortage", "out_of_stock") == [
        ("i", D(15), 2.0, 13.0, False), ("j", D(0), 0.2, 2.8, True)]


def test_shortage_has_a_floor(spark, rows):
    much = stock(spark).selectExpr("stock_date", "source", "owner", "warehouse", "item", "quantity * 100 as quantity")
    assert rows(daily.item_shortage(orders(spark), much, DAY), "item", "shortage") == [("i", 0.0), ("j", 2.8)]


def test_sales_vs_stock_keeps_both_sides(spark, rows):
    out = daily.sales_vs_stock(orders(spark), stock(spark), DAY)
    assert rows(out, "item", "sold", "stock") == [
        ("i", D(30), D(15)), ("j", D(6), D(0)), ("k", D(0), D(0)), ("x", D(0), D(7))]


def warehouses(spark):
    return spark.createDataFrame([("W1", "WB", "north"), ("W2", "WB", "north"), ("W1", "OZON", "south")],
                                 "code string, source string, cluster string")


def test_clusters(spark, rows):
    short = daily.cluster_shortage(orders(spark), stock(spark), warehouses(spark), DAY)
    assert rows(short, "cluster", "item", "shortage") == [("north", "i", 13.0), ("north", "j", 2.8)]
    report = daily.cluster_report(orders(spark), stock(spark), warehouses(spark), DAY)
    assert rows(report, "cluster", "orders", "quantity", "cancelled", "stock", "cover_days") == [
        ("NONE", 0, D(0), 0, D(7), None), ("north", 5, D(66), 2, D(15), 15 * 30 / 66)]


def test_item_report_spans(spark, rows):
    out = daily.item_report(orders(spark), DAY)
    assert rows(out.filter("item = 'i'"), "day", "quantity", "quantity_7d", "quantity_30d") == [
        (date(2024, 3, 1), D(900), D(900), D(900)), (date(2024, 3, 2), D(30), D(930), D(930)),
        (date(2024, 3, 31), D(30), D(30), D(60))]


def test_products(spark, rows):
    items = spark.createDataFrame([("i", "B", "C"), ("j", "B", "C"), ("x", "Z", "C")], "item string, brand string, category string")
    short = daily.product_shortage(orders(spark), stock(spark), items, DAY)
    assert rows(short, "brand", "category", "avg_sale", "shortage") == [("B", "C", 2.2, (66 * 14 - 15 * 30) / 30)]
    report = daily.product_report(orders(spark), stock(spark), items, DAY)
    got = {(r["owner"], r["brand"], r["level"]): (r["quantity"], r["stock"]) for r in report.collect()}
    assert got == {("A", "B", 0): (D(66), D(15)), ("A", "Z", 0): (D(0), D(7)), ("A", None, 0): (D(0), D(0)),
                   ("A", None, 1): (D(66), D(22)), (None, None, 3): (D(66), D(22))}


def test_orders_by_day(spark, rows):
    tx = spark.createDataFrame([(1, "COMPLETED", datetime(2024, 4, 1, 1)), (2, "RUNNING", datetime(2024, 4, 1, 2))],
                               "id int, status string, start_date timestamp_ntz")
    out = daily.orders_by_day(orders(spark), tx, 1)
    assert rows(out, "report_date", "sku", "orders", "quantity", "amount", "cancelled") == [
        (DAY, "i", 1, D(30), D(300), 0), (DAY, "j", 1, D(6), D(60), 0), (DAY, "k", 1, D(5), D(50), 1)]
    assert rows(daily.orders_by_day(orders(spark), tx, 2)) == []
    assert rows(daily.orders_by_last_completed(orders(spark), tx)) == rows(out)


FACT = ("source string, owner string, order_key string, sku string, order_ts timestamp_ntz, change_ts timestamp_ntz,"
        " quantity decimal(18,2), amount decimal(18,2), is_cancelled boolean, warehouse string, region string,"
        " schema string, barcode string")


def fact(spark, *data):
    return spark.createDataFrame([("WB", "A", k, "s", datetime(2024, 3, d), datetime(2024, 4, c), D(1), D(a), False,
                                   "w", None, "x", None) for k, d, c, a in data], FACT)


def test_apply_orders(spark, rows):
    old = fact(spark, ("o1", 1, 1, 1), ("o2", 10, 1, 2))
    staged = [fact(spark, ("o1", 1, 5, 9), ("o3", 10, 1, 3), ("o3", 10, 2, 4)), fact(spark, ("o4", 11, 1, 5))]
    once = facts.apply_orders(old, staged, date(2024, 3, 10))
    want = [("o1", D(1)), ("o3", D(4)), ("o4", D(5))]
    assert rows(once, "order_key", "amount") == want
    assert rows(facts.apply_orders(once, staged, date(2024, 3, 10)), "order_key", "amount") == want


def test_a_key_that_left_the_range_does_not_come_back(spark, rows):
    staged = [fact(spark, ("o1", 12, 1, 7), ("o1", 5, 2, 8), ("o2", 5, 1, 1), ("o2", 12, 2, 2))]
    once = facts.apply_orders(fact(spark, ("o0", 1, 1, 1)), staged, date(2024, 3, 10))
    assert rows(once, "order_key", "amount") == [("o0", D(1)), ("o2", D(2))]


def test_a_missing_flag_means_not_cancelled(spark, rows):
    one = orders(spark).limit(1).withColumn("is_cancelled", F.lit(None).cast("boolean"))
    assert rows(daily.item_report(one, date(2100, 1, 1)), "quantity") == rows(one, "quantity")


def test_stock_without_day_or_source_stays(spark, rows):
    schema = ("stock_date date, source string, owner string, warehouse string, sku string, barcode string,"
              " quantity decimal(18,2)")
    old = spark.createDataFrame([(None, "KZ", "A", "w", "a", None, D(1)), (date(2024, 3, 2), None, "A", "w", "b", None, D(2))], schema)
    new = spark.createDataFrame([(date(2024, 3, 2), "KZ", "A", "w", "c", None, D(3))], schema)
    assert rows(facts.apply_stock_of(old, new, date(2024, 3, 2), "KZ"), "sku") == [("a",), ("b",), ("c",)]


def test_apply_stock_replaces_its_date_and_source_only(spark, rows):
    schema = ("stock_date date, source string, owner string, warehouse string, sku string, barcode string,"
              " quantity decimal(18,2)")

    def s(*data):
        return spark.createDataFrame([(date(2024, 3, d), src, "A", "w", k, None, D(n)) for d, src, k, n in data], schema)

    old = s((1, "WB", "a", 1), (2, "WB", "a", 2), (2, "KZ", "a", 3))
    new = [s((2, "WB", "b", 4), (2, "WB", "b", 5)), s((2, "OZON", "c", 6))]
    assert rows(facts.apply_stock(old, new, date(2024, 3, 2)), "source", "sku", "quantity") == [
        ("OZON", "c", D(6)), ("WB", "a", D(1)), ("WB", "b", D(9))]
    kz = facts.apply_stock_of(old, s((2, "KZ", "z", 8)), date(2024, 3, 2), "KZ")
    assert rows(kz, "source", "sku", "quantity") == [("KZ", "z", D(8)), ("WB", "a", D(1)), ("WB", "a", D(2))]


def test_items_by_barcode(spark, rows):
    d = spark.createDataFrame([("b1", "1"), ("b2", "2"), (None, "3")], "barcode string, sku string")
    dim = spark.createDataFrame([("b1", "i2"), ("b1", "i1")], "barcode string, item_id string")
    assert rows(facts.with_items(d, dim), "sku", "item") == [("1", "i1"), ("2", "b2"), ("3", "3")]


def test_apply_ads(spark, rows):
    d = spark.createDataFrame([(date(2024, 1, 30), 1), (date(2024, 1, 31), 2)], "report_date date, n int")
    new = spark.createDataFrame([(date(2024, 1, 1), 8), (date(2024, 3, 1), 9)], "report_date date, n int")
    assert rows(facts.apply_ads(d, new, date(2024, 3, 31)), "n") == [(1,), (9,)]


def test_rows_of_open_transactions_do_not_count(spark, tmp_path, rows):
    data = [("2024-01-01", t, q) for t, q in ((1, 1), (2, 10), (3, 100), (9, 1000), (None, 5))]
    orders = spark.createDataFrame(data, "day string, transaction_id int, q int").selectExpr(
        "cast(day as date) as day", "'o' as owner", "'WB' as source", "'s' as sku", "cast(q as decimal(18,2)) as quantity",
        "cast(q as decimal(18,2)) as amount", "false as is_cancelled", "transaction_id")
    orders.write.partitionBy("transaction_id").parquet(str(tmp_path / "o"))
    ledger = spark.createDataFrame([(1, "COMPLETED"), (2, "RUNNING"), (3, "COMPLETED"), (4, "FAILED")], "id int, status string") \
        .withColumn("start_date", F.lit("2024-01-02").cast("date"))
    ledger.write.parquet(str(tmp_path / "l"))
    ledger, stored = spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "o"))
    for report in (daily.orders_by_day(stored, ledger, 3, loaded_by="transaction_id"), daily.orders_by_last_completed(stored, ledger, loaded_by="transaction_id")):
        assert rows(report.selectExpr("orders", "cast(quantity as int)")) == [(2, 101)]
        assert "dynamicpruning" in report._jdf.queryExecution().executedPlan().toString()
    assert rows(daily.orders_by_day(stored, ledger, 2, loaded_by="transaction_id")) == []
    assert rows(daily.orders_by_day(stored, ledger, 3).select("orders")) == [(5,)]
