from datetime import date, datetime

import pytest

from pyspark.sql import functions as F

from tradeloom.operators import dedup, incremental, lookup, partials, state
from tradeloom.sources import published


def df(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def test_first_and_last_wins(spark, rows):
    d = df(spark, "k string, at int, v string", ("a", 1, "x"), ("a", 2, "y"), ("b", None, "z"))
    assert rows(dedup.first_wins(d, ["k"], ["at"])) == [("a", 1, "x"), ("b", None, "z")]
    assert rows(dedup.last_wins(d, ["k"], ["at"])) == [("a", 2, "y"), ("b", None, "z")]


def test_one_row_per_key_leaves_each_task_before_the_shuffle(spark):
    d = spark.range(100000).selectExpr("id % 3 as k", "id")
    plan = dedup.last_wins(d, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_latest_version_is_idempotent(spark, rows):
    d = df(spark, "k string, ts int, v string", ("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"))
    once = dedup.latest_version(d, ["k"], "ts")
    assert rows(once) == [("a", 2, "z")] == rows(dedup.latest_version(once, ["k"], "ts"))


def test_keys_of_several_frames_meet_as_text(spark, rows):
    assert rows(dedup.distinct_keys(df(spark, "sku bigint", (1,), (2,)), df(spark, "sku string", ("1",), ("3",)))) == [
        ("1",), ("2",), ("3",)]


def test_lookups(spark, rows):
    left, dim = df(spark, "k int, n int", (1, 1), (2, 2)), df(spark, "k int, v string", (1, "a"))
    assert rows(lookup.missing(left, dim, ["k"])) == [(2,)]
    assert rows(lookup.limit_to(left, dim, ["k"])) == [(1, 1)]
    assert rows(lookup.require(left.filter("k = 1"), dim, ["k"])) == [(1, 1, "a")]
    with pytest.raises(Exception, match="no match for k: 2"):
        lookup.require(left, dim, ["k"]).select("n").collect()


def test_offers(spark, rows):
    offers = df(spark, "id string, name string", ("1", "known"))
    seen = df(spark, "offer_name string, n int", (" known ", 1), ("new", 2), ("new ", 3), (" ", 4), (None, 5))
    added = lookup.new_offers(seen, offers)
    assert rows(added, "name") == [("new",)]
    new_id = added.first()["id"]
    assert rows(lookup.offer_ids(seen, offers), "n", "offer_id") == [(1, "1"), (2, new_id), (3, new_id), (4, None), (5, None)]
    dim = lookup.insert_offers(offers, seen)
    assert rows(lookup.insert_offers(dim, seen)) == rows(dim)
    assert rows(lookup.offer_ids(seen, dim)) == rows(lookup.offer_ids(seen, offers))


def test_warehouses(spark, rows):
    dim = df(spark, "code string, source string, cluster string", ("A", "WB", "north"), ("B", "OZON", "south"))
    seen = df(spark, "warehouse_name string", ("A",), ("B",), ("B",))
    assert rows(lookup.insert_warehouses(dim, seen, "WB")) == [("A", "WB", "north"), ("B", "OZON", "south"), ("B", "WB", "NONE")]


def test_connections(spark):
    schema = "source string, owner string, subject string, connection_id string"
    links = df(spark, schema, ("WB", "B", "ORDER", "1"), ("WB", "B", "STOCK", "2"), ("OZON", "A", "ORDER", "3"))
    assert [tuple(r) for r in lookup.connections(links).collect()] == [("OZON", "A", "3", None), ("WB", "B", "1", "2")]
    with pytest.raises(Exception, match="more than one ORDER connection"):
        lookup.connections(links.unionByName(links.filter("subject = 'ORDER'"))).collect()


def test_cursor(spark, rows):
    d = df(spark, "ts timestamp_ntz, owner string", (datetime(2024, 1, 1, 0, 0, 5), "A"), (datetime(2024, 1, 1), "B"))
    assert rows(incremental.next_cursor(d, "ts")) == [(datetime(2024, 1, 1, 0, 0, 6),)]
    late = incremental.next_cursor(d, "ts", since=date(2024, 2, 1))
    assert rows(late) == [(datetime(2024, 2, 1, 0, 0, 1),)]
    assert rows(incremental.next_cursor(d.filter("owner = 'C'"), "ts", since=date(2024, 2, 1))) == [
        (datetime(2024, 2, 1, 0, 0, 1),)]
    assert rows(incremental.restart_point(d, "ts", date(2020, 1, 1), by=["owner"]), "owner", "restart_at")[1] == ("B", datetime(2024, 1, 1, 0, 0, 1))


def test_window_days(spark, rows):
    owners = df(spark, "owner string", ("none",), ("zero",), ("few",), ("many",), ("huge",))
    counts = df(spark, "owner string, qnt bigint", ("zero", 0), ("few", 45), ("many", 45 * 4000), ("huge", 45 * 7000))
    assert dict(rows(incremental.window_days(owners, counts, ["owner"]), "owner", "window_days")) == {
        "none": 20, "zero": 15, "few": 45, "many": 15, "huge": 8}


def test_last_completed(spark, rows):
    t = df(spark, "id bigint, status string", (1, "COMPLETED"), (3, "COMPLETED"), (7, "RUNNING"))
    assert rows(incremental.last_completed(t)) == [(3,)]
    assert rows(incremental.last_completed(t.filter("id = 7"))) == [(0,)]


@pytest.mark.parametrize("first, last, want", [
    (date(2024, 1, 31), date(2024, 8, 1), [("2024-01-31", "2024-04-30"), ("2024-04-30", "2024-07-31"), ("2024-07-31", "2024-08-01")]),
    (date(2024, 1, 1), date(2024, 4, 1), [("2024-01-01", "2024-04-01")]),
    (date(2024, 1, 1), date(2024, 2, 1), [("2024-01-01", "2024-02-01")]),
    (date(2024, 1, 1), date(2024, 1, 1), [("2024-01-01", "2024-01-01")]),
    (date(2023, 11, 28), date(2024, 2, 29), [("2023-11-28", "2024-02-28"), ("2024-02-28", "2024-02-29")]),
])
def test_range_pieces(spark, first, last, want):
    d = df(spark, "a date, b date", (first, last))
    got = incremental.range_pieces(d, "a", "b").orderBy("piece").collect()
    assert [(str(r["piece_from"]), str(r["piece_to"])) for r in got] == want


def test_keyset_page(spark):
    d = spark.range(10).withColumnRenamed("id", "rrd_id")
    assert [r[0] for r in incremental.keyset_page(d, "rrd_id", 3, 2).collect()] == [4, 5]


def test_replace(spark, rows):
    old, new = df(spark, "o string, n int", ("A", 1), ("B", 2)), df(spark, "o string, n int", ("A", 3), ("A", 4))
    once = state.replace_slice(old, new, ["o"])
    assert rows(once) == [("A", 3), ("A", 4), ("B", 2)] == rows(state.replace_slice(once, new, ["o"]))
    days = df(spark, "d date, n int", (date(2024, 1, 1), 1), (date(2024, 1, 2), 2))
    more = df(spark, "d date, n int", (date(2024, 1, 1), 8), (date(2024, 1, 2), 9))
    assert rows(state.replace_from(days, more, "d", date(2024, 1, 2)), "n") == [(1,), (9,)]
    assert rows(state.replace_day(days, more.filter("n = 9"), "d", date(2024, 1, 2), True), "n") == [(1,), (9,)]
    assert rows(state.replace_day(days, more.filter("n = 9"), "d", date(2024, 1, 2), False), "n") == [(1,), (2,), (9,)]


def test_upsert(spark, rows):
    old, new = df(spark, "k int, v string", (1, "z"), (2, "old")), df(spark, "k int, v string", (1, "a"), (1, "b"), (3, "c"))
    # The last staged row wins, not the one with the highest text.
    staged = new.withColumn("at", F.when(F.col("v") == "a", 9).otherwise(1))
    once = state.upsert(old, staged, ["k"], ["at"])
    assert rows(once) == [(1, "a"), (2, "old"), (3, "c")] == rows(state.upsert(once, staged, ["k"], ["at"]))
    fresh = df(spark, "k int, v string, at int", (2, "new", 1), (4, "later", 2), (4, "d", 1), (None, "x", 1))
    dim = state.insert_missing(old, fresh, ["k"], ["at"])
    assert rows(dim) == [(1, "z"), (2, "old"), (4, "d")] == rows(state.insert_missing(dim, fresh, ["k"], ["at"]))


def test_a_slice_that_came_back_empty_is_cleared(spark, rows):
    old = df(spark, "o string, n int", ("A", 1), ("B", 2), (None, 3), ("C", 4))
    new = df(spark, "o string, n int", ("B", 5), (None, 6))
    asked = df(spark, "o string", ("A",), ("B",), (None,))
    once = state.replace_slice(old, new, ["o"], asked)
    assert rows(once) == [("B", 5), ("C", 4), (None, 6)] == rows(state.replace_slice(once, new, ["o"], asked))


def test_rows_without_a_day_stay(spark, rows):
    old, new = df(spark, "d date, n int", (None, 1), (date(2024, 1, 1), 2), (date(2024, 2, 1), 3)), df(spark, "d date, n int", (date(2024, 2, 2), 4))
    assert rows(state.replace_from(old, new, "d", date(2024, 2, 1)), "n") == [(1,), (2,), (4,)]


def test_ledger(spark, rows):
    schema = ("uuid string, seq int, kind string, owner_code string, type string, status string, link string,"
              " error string, file_name string")
    log = [("u", 1, "created", "A", "T", "NOT_STARTED", None, None, None),
           ("u", 2, "polled", None, None, "OK", "/x", "slow", None),
           ("u", 3, "loaded", None, None, "LOADED", None, None, "f.xls"),
           ("w", 1, "created", "B", "T", "NOT_STARTED", None, None, None),
           ("w", 2, "failed", None, None, "ERROR_LOAD", None, "HTTP: 500", None)]
    want = [("u", "A", "T", "LOADED", "/x", None, "f.xls"), ("w", "B", "T", "ERROR_LOAD", None, "HTTP: 500", None)]
    assert rows(state.request_ledger(df(spark, schema, *log))) == want
    assert rows(state.request_ledger(df(spark, schema, *reversed(log)))) == want


def test_before_transaction(spark, rows):
    days = df(spark, "d date", (date(2024, 1, 1),), (date(2024, 1, 2),))
    tx = df(spark, "id int, start_date timestamp_ntz", (5, datetime(2024, 1, 2, 23)), (6, datetime(2024, 1, 3)))
    assert rows(state.before_transaction(days, tx, "d", 5)) == [(date(2024, 1, 2),)]
    assert len(rows(state.before_transaction(days, tx, "d", 99))) == 2


def test_a_null_owner_keeps_its_keys(spark, rows):
    data = [(o, k) for o in ("a", None) for k in range(7)] + [(None, 3), ("b", None)]
    got = incremental.key_batches(spark.createDataFrame(data, "owner string, sku int"), "owner", "sku", 3, buckets=4)
    assert rows(got, "owner", "sku") == sorted({(o, k) for o, k in data}, key=str)
    assert rows(got.filter("owner is null"), "batch", "position") == sorted([(i // 3, i % 3) for i in range(7)], key=str)


def test_a_null_warehouse_names_none(spark, rows):
    dim = spark.createDataFrame([("A", "WB", "north")], "code string, source string, cluster string")
    seen = spark.createDataFrame([(None,), ("A",), ("C",)], "warehouse_name string")
    for _ in range(2):
        dim = lookup.insert_warehouses(dim, seen, "WB")
    assert rows(dim) == [("A", "WB", "north"), ("C", "WB", "NONE")]


def test_folded_ledger(spark, tmp_path, rows):
    path, columns = str(tmp_path / "l"), "uuid string, seq int, kind string, owner_code string, type string, status string, link string, error string, file_name string"
    events = [("u", 1, "created", "o", "t", "s1", None, None, None), ("u", 2, "polled", None, None, "s2", "l", "e", None), ("v", 3, "failed", None, None, "s3", None, "x", None),
              ("u", 4, "polled", None, None, "s4", None, None, None), ("v", 5, "created", "p", "t", "s5", None, None, None), ("u", 6, "loaded", None, None, None, None, None, "f")]
    log = spark.createDataFrame(events, columns)
    want = rows(state.request_ledger(log), *partials.LEDGER)
    for n, some in enumerate(([5, 2], [1, 6], [3], [4])):
        part = partials.ledger_partial(log.filter(F.col("seq").isin(some)))
        assert partials.add(part, path, n) is not None
        partials.add(part, path, n)
        if n in (1, 2):
            assert partials.fold(spark, path, partials.ledger_merge) is not None
            assert partials.add(part, path, n) is None
            assert partials.fold(spark, path, partials.ledger_merge) is None
    assert rows(partials.ledger_state(partials.parts(spark, path)), *partials.LEDGER) == want
    # The base is one slice; only the batch behind it is beside it.
    assert rows(published.manifest(spark, path).select("batch", "is_base")) == [(2, True), (3, False)]


def test_folded_counts(spark, tmp_path, rows):
    path, lines = str(tmp_path / "c"), spark.createDataFrame([("a", n) for n in range(9)] + [(None, 9), ("b", 10)], "owner string, n int")
    for n in range(3):
        partials.add(partials.count_partial(lines.filter(F.col("n") % 3 == n), ["owner"]), path, n)
        partials.fold(spark, path, partials.count_merge)
    assert rows(partials.count_merge(partials.parts(spark, path))) == rows(incremental.feed_counts(lines, ["owner"]))
