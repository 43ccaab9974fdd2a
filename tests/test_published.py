"""Slices appear as a whole or not at all."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import lookup
from tradeloom.plans import facts
from tradeloom.sources import published

COLUMNS = "owner string, day date, n int"


def frame(spark, *data):
    return spark.createDataFrame([(o, None if d is None else date(2024, 1, d), n) for o, d, n in data], COLUMNS)


def content(df):
    return sorted((tuple(r) for r in df.selectExpr("owner", "day(day)", "n").collect()), key=str)


def files(path):
    return {f.relative_to(path): f.stat().st_mtime_ns for f in Path(path, "data").rglob("*.parquet")}


def test_only_the_slices_of_a_load_are_written(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ["owner", "day"]
    assert published.publish(frame(spark, ("007", 1, 1), ("007", 2, 2), ("b/=é", 1, 3), (None, None, 4)), path, keys) == 1
    before = files(path)
    assert published.publish(frame(spark, ("007", 2, 5), ("007", 2, 6), ("c", 9, 7)), path, keys) == 2
    after = files(path)
    assert all(after[f] == t for f, t in before.items())
    assert {f.parts[2:4] for f in after.keys() - before.keys()} == {("owner=007", "day=2024-01-02"), ("owner=c", "day=2024-01-09")}
    assert content(published.read(spark, path)) == sorted([("007", 1, 1), ("007", 2, 5), ("007", 2, 6), ("b/=é", 1, 3), ("c", 9, 7), (None, None, 4)], key=str)
    assert content(published.read(spark, path, 1)) == sorted([("007", 1, 1), ("007", 2, 2), ("b/=é", 1, 3), (None, None, 4)], key=str)


def test_a_failing_load_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(frame(spark, ("a", 1, 1), ("b", 1, 2)), path, ["owner"])
    bad = frame(spark, ("a", 1, 9)).withColumn("n", F.raise_error(F.lit("no match")).cast("int"))
    with pytest.raises(Exception, match="no match"):
        published.publish(bad, path, ["owner"], slices=[{"owner": "a"}, {"owner": "b"}])
    assert content(published.read(spark, path)) == [("a", 1, 1), ("b", 1, 2)] and published.versions(spark, path) == [1]


def test_asked_slices_that_came_back_empty_are_cleared(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(frame(spark, ("a", 1, 1), ("b", 1, 2), (None, 1, 3), ("d", 2, 4)), path, ["owner"])
    published.publish(frame(spark, ("b", 1, 8)), path, ["owner"], slices=[{"owner": "a"}, {"owner": None}, {"owner": "never"}])
    assert content(published.read(spark, path)) == [("b", 1, 8), ("d", 2, 4)]
    published.publish(frame(spark), path, ["owner"], gone=F.col("owner") >= "b")
    empty = published.read(spark, path)
    assert content(empty) == [] and [f.dataType.simpleString() for f in empty.schema] == ["string", "date", "int"]
    published.publish(frame(spark, ("z", 1, 1)), path, ["owner"])
    assert content(published.read(spark, path)) == [("z", 1, 1)]


def test_an_empty_first_load_and_other_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(frame(spark), path, ["owner"])
    assert content(published.read(spark, path)) == []
    with pytest.raises(ValueError, match="other columns"):
        published.publish(frame(spark).drop("n"), path, ["owner"])
    with pytest.raises(ValueError, match="nothing was published"):
        published.read(spark, str(tmp_path / "none"))


def test_the_second_of_two_loads_at_once_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    published.publish(frame(spark, ("a", 1, 1)), path, ["owner"])
    real = published._appear

    def late(s, source, target):
        monkeypatch.setattr(published, "_appear", real)
        published.publish(frame(spark, ("b", 1, 2)), path, ["owner"])
        real(s, source, target)

    monkeypatch.setattr(published, "_appear", late)
    with pytest.raises(published.Conflict):
        published.publish(frame(spark, ("c", 1, 3)), path, ["owner"])
    assert content(published.read(spark, path)) == [("a", 1, 1), ("b", 1, 2)]


def test_vacuum_keeps_what_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2, 3):
        published.publish(frame(spark, ("a", 1, n), ("b" if n == 1 else "c", 1, n)), path, ["owner"])
    assert len(published.vacuum(spark, path, keep=2)) == 0 and published.versions(spark, path) == [2, 3]
    assert len(published.vacuum(spark, path)) == 1
    assert content(published.read(spark, path)) == [("a", 1, 3), ("b", 1, 1), ("c", 1, 3)]


def test_filters_on_keys_reach_the_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(frame(spark, ("a", 1, 1), ("b", 2, 2)), path, ["owner", "day"])
    plan = published.read(spark, path).filter(F.col("day") >= date(2024, 1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert content(published.read(spark, path).filter("owner = 'b'")) == [("b", 2, 2)]


ORDERS = ("source string, owner string, order_key string, sku string, order_ts timestamp_ntz, change_ts timestamp_ntz, quantity decimal(18,2),"
          " amount decimal(18,2), is_cancelled boolean, warehouse string, region string, schema string, barcode string")


def orders(spark, *data):
    rows = spark.createDataFrame(data, "order_key string, day string, change int")
    return rows.selectExpr(
        "'WB' as source", "'A' as owner", "order_key", "'s' as sku", "cast(day as timestamp_ntz) as order_ts",
        "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, change) as change_ts", "cast(1 as decimal(18,2)) as quantity",
        "cast(change as decimal(18,2)) as amount", "false as is_cancelled", "'w' as warehouse", "'r' as region", "'x' as schema", "cast(null as string) as barcode")


def test_orders_by_day_equal_the_rewritten_fact(spark, tmp_path, rows):
    path, columns = str(tmp_path / "f"), ["order_key", "order_ts", "amount"]
    first = orders(spark, ("a", "2024-03-01", 1), ("b", "2024-03-02", 1), ("c", "2024-03-03", 1), ("c", "2024-03-03", 3), ("e", "2024-03-05", 1), ("n", None, 1))
    second = orders(spark, ("b", "2024-03-02", 5), ("c", "2024-03-01", 9), ("c", "2024-03-03", 7), ("d", "2024-03-04", 1))
    facts.load_orders(path, [first], date(2024, 1, 1))
    old = published.read(spark, path).drop("day")
    want = rows(facts.apply_orders(old, [second], date(2024, 3, 2)), *columns)
    before = files(path)
    facts.load_orders(path, [second], date(2024, 3, 2))
    # The key c has left the range and e was not staged again: their days are cleared.
    assert rows(published.read(spark, path), *columns) == want and [w[0] for w in want] == ["a", "b", "d"]
    assert {f.parts[2] for f in files(path).keys() - before.keys()} == {"day=2024-03-02", "day=2024-03-04"}


def test_orders_by_month_carry_the_days_before(spark, tmp_path, rows):
    path, columns = str(tmp_path / "f"), ["order_key", "order_ts", "amount"]
    first = orders(spark, ("a", "2024-02-09", 1), ("b", "2024-03-01", 1), ("c", "2024-03-20", 1), ("d", "2024-04-02", 1), ("e", "2024-05-05", 1))
    second = orders(spark, ("c", "2024-03-20", 5), ("x", "2024-03-05", 6), ("y", "2024-04-30", 7))
    facts.load_orders(path, [first], date(2024, 1, 1), "month")
    want = rows(facts.apply_orders(published.read(spark, path).drop("day", "month"), [second], date(2024, 3, 10)), *columns)
    before = files(path)
    facts.load_orders(path, [second], date(2024, 3, 10), "month")
    assert rows(published.read(spark, path), *columns) == want and [w[0] for w in want] == ["a", "b", "c", "y"]
    assert {f.parts[2] for f in files(path).keys() - before.keys()} == {"month=2024-03-01", "month=2024-04-01"}


def test_rows_without_an_order_key_are_all_kept(spark, tmp_path, rows):
    data = [("a", "2024-03-01", 1), ("a", "2024-03-01", 2), (None, "2024-03-01", 1), (None, "2024-03-01", 2), (None, "2024-03-01", 2)]
    assert rows(facts.latest_orders([orders(spark, *data)]), "order_key", "amount") == rows(orders(spark, data[1], data[2], data[3]), "order_key", "amount")


def test_stock_of_one_date_and_source(spark, tmp_path, rows):
    path = str(tmp_path / "s")

    def staged(*data):
        return spark.createDataFrame([(date(2024, 1, d), s, "o", "w", k, None, q) for d, s, k, q in data], (
            "stock_date date, source string, owner string, warehouse string, sku string, barcode string, quantity int")).selectExpr(
            "* except (quantity)", "cast(quantity as decimal(18,2)) as quantity")

    facts.load_stock(path, [staged((1, "WB", "x", 1), (2, "WB", "x", 9)), staged((1, "KZ", "x", 2))], date(2024, 1, 1))
    facts.load_stock(path, [staged((2, "WB", "x", 3), (2, "WB", "x", 4))], date(2024, 1, 2))
    facts.load_stock(path, [staged((1, "KZ", "y", 5), (1, "WB", "z", 6))], date(2024, 1, 1), source="KZ")
    got = rows(published.read(spark, path).selectExpr("day(stock_date)", "source", "sku", "cast(quantity as int)"))
    assert got == [(1, "KZ", "y", 5), (1, "WB", "x", 1), (2, "WB", "x", 7)]
    facts.load_stock(path, [staged()], date(2024, 1, 1))
    assert rows(published.read(spark, path).selectExpr("day(stock_date)", "source")) == [(2, "WB")]


def test_ads_of_the_window(spark, tmp_path, rows):
    path = str(tmp_path / "a")
    some = lambda *data: spark.createDataFrame([(date(2024, m, 1), n) for m, n in data], "report_date date, n int")
    facts.load_ads(path, some((1, 1), (4, 2), (5, 3)), date(2024, 1, 31), days=60)
    facts.load_ads(path, some((1, 8), (5, 9)), date(2024, 5, 10), days=60)
    assert rows(published.read(spark, path).selectExpr("month(report_date)", "n")) == [(1, 1), (5, 9)]


def test_a_load_with_missing_keys_names_them_and_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    left = frame(spark, ("a", 1, 1), ("b", 1, 2), ("x", 1, 3), ("x", 2, 4), ("y", 1, 5), (None, 1, 6))
    dim = spark.createDataFrame([("a", "A"), ("b", "B")], "owner string, name string")
    found, report = lookup.matched(left.filter("owner in ('a', 'b')"), dim, ["owner"])
    published.publish(found, path, ["owner"], check=report.check)
    assert report.get() == {"rows": 0, "keys": 0, "examples": []}
    found, report = lookup.matched(left, dim, ["owner"])
    with pytest.raises(lookup.MissingKeys, match="4 rows of about 3 keys have no match for owner, such as"):
        published.publish(found, path, ["owner"], check=report.check)
    assert report.get()["examples"] and set(report.get()["examples"]) <= {"x", "y", "(null)"}
    assert published.versions(spark, path) == [1] and published.read(spark, path).count() == 2
