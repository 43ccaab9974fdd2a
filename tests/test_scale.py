"""Shapes of plans and files that keep disk and memory in proportion to the input."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from showcase import fact_queries, feeds, file_queries
from showcase.registry import QUERIES
from tradeloom import session
from tradeloom.functions import times
from tradeloom.functions.common import unpacked
from tradeloom.operators import postings
from tradeloom.plans import facts
from tradeloom.session import tune
from tradeloom.sources import blocks, landing


@pytest.fixture
def sf(spark, tmp_path):
    """A few rows of the tables."""
    day = datetime(1998, 3, 1)
    tables = {
        "lineitem": ([(i, i % 5 + 1, 1, 1, 2.0, 10.0, 0.0, 0.02, "N", "O", day) for i in range(1, 41)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
                     " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "orders": ([(i, 1, "O", 10.0, day, "1-URGENT") for i in range(1, 41)], "o_orderkey long, o_custkey long, o_orderstatus string,"
                   " o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "customer": ([(1, "c", 1, 1.0, "BUILDING")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": ([(i, "p", "b", "t", 20, 1.0) for i in range(1, 7)], "p_partkey long, p_name string, p_brand string, p_type string,"
                 " p_size int, p_retailprice double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_crossing_records_are_picked_where_they_are_read(spark, tmp_path, monkeypatch, kind):
    """texts are shuffled once; those of records that cross blocks are not ordered with all others."""
    kept, keep = [], blocks._kept
    monkeypatch.setattr(blocks, "_kept", lambda df: kept.append(df) or keep(df))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200b")
    try:
        if kind == "csv":
            (tmp_path / "a.csv").write_text("".join(f'{i},"x\n""{i}"" y"\n' for i in range(60)))
            got = sorted(int(r["value"].split(",")[0]) for r in blocks.delimited_records(spark, str(tmp_path)).collect())
        else:
            (tmp_path / "a.json").write_text("[" + ",".join(f'{{"n":{i},"t":"}}{{[\\""}}' for i in range(60)) + "]")
            rows = blocks.json_rows(spark, str(tmp_path), "n int, t string", "_corrupt").collect()
            got = sorted(r["n"] for r in rows)
            assert all(r["t"] == '}{["' for r in rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(range(60))
    with_text = [df for df in kept if "value" in df.columns]
    assert with_text and all("Window" not in _plan(df, "optimizedPlan") for df in with_text)


def test_landed_documents_are_packed(spark, sf, tmp_path, monkeypatch):
    """files are a fraction of their documents' text, bounded in documents, and give all rows."""
    folder = str(tmp_path / "landed")
    monkeypatch.setattr(file_queries, "new_folder", lambda *_: folder)
    monkeypatch.setattr(file_queries, "FILE_DOCUMENTS", 500)
    lines = feeds.line_items(spark, sf).select("*", F.explode(F.sequence(F.lit(1), F.lit(100))).alias("k")) \
        .withColumn("l_orderkey", F.col("l_orderkey") * 1000 + F.col("k")).coalesce(1)
    docs = feeds.wb_orders(lines)
    got = file_queries._landed(spark, docs, "wb_orders")
    text = docs.select(F.sum(F.length(F.to_json(F.struct("*")))).alias("n")).first()["n"]
    sizes = [os.path.getsize(f"{folder}/{n}") for n in os.listdir(folder) if n.startswith("part-")]
    assert sum(sizes) < text / 5 and len(sizes) == 8
    rows = got.select("srid", "page").collect()
    assert len({r["srid"] for r in rows}) == len({r["page"] for r in rows}) == len(rows) == 4000


@pytest.mark.parametrize("name", ["ozon_stock_lines", "ozon_stock_flat"])
def test_codes_of_owners_are_not_broadcast(spark, sf, name):
    """barcodes of all owners are five times what the table's size says."""
    df = QUERIES[name](spark, sf)
    assert "ShuffledHashJoin" in _plan(df)
    assert df.count() == 40


def test_parts_are_dealt_to_tasks(spark, sf):
    """no task makes the documents of all parts of a file."""
    df = QUERIES["product_rows"](spark, sf)
    assert "REPARTITION_BY_NUM" in _plan(df)
    assert df.count() == 12


def test_place_without_search(spark, tmp_path):
    """the folder of a page is cut off, not searched for at each place of the path."""
    folder = tmp_path / "pages"
    folder.mkdir()
    (folder / "p-12.json").write_text('{"items":[]}\n{"items":[]}\n')
    got = landing.pages(spark, str(folder), "erp_stock", lines=True)
    assert "[^/]" not in _plan(got, "optimizedPlan")
    page = sorted(r["page"].split("|") for r in got.collect())
    assert [p[0].endswith("/pages/") and p[1:3] == ["12".zfill(20), "p-12.json"] for p in page] == [True, True]


def test_tasks_behind_a_shuffle_are_small(spark):
    """rows that become documents behind a shuffle come to a task in small parts."""
    assert "spark.sql.adaptive.advisoryPartitionSizeInBytes" in session.SETTINGS
    assert tune(spark).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def _ozon(spark, sf):
    return feeds.fbo(feeds.owned_lines(spark, sf), "owner")


def test_postings_are_built_once_and_shuffled_without_unread_fields(spark, sf):
    """A page is not built a second time to see whether it is empty; unread fields stay behind."""
    last = postings.latest_postings(_ozon(spark, sf), packed=False)
    rows = facts.ozon_orders(postings.flatten_fbo(last, F.col("owner"), 1, datetime(1998, 1, 1).date()))
    plan = _plan(rows, "optimizedPlan")
    assert plan.count("named_struct(order_id") == 1
    below = plan[plan.index("WindowGroupLimit"):].splitlines()[1]
    assert "posting_number" in below and "order_number" not in below and "city" not in below and "payout" not in below
    assert rows.count() == 40
    whole = postings.flatten_fbo(postings.latest_postings(_ozon(spark, sf)), F.col("owner"), 1, datetime(1998, 1, 1).date())
    assert sorted(map(str, whole.collect())) == sorted(map(str, postings.flatten_fbo(
        last, F.col("owner"), 1, datetime(1998, 1, 1).date()).collect()))


def test_lines_of_a_posting_are_added_up_where_they_lie(spark, sf):
    """No shuffle between the last version of a posting and the sums of its lines."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        last = postings.latest_postings(_ozon(spark, sf), packed=False)
        plan = _plan(facts.ozon_orders(postings.flatten_fbo(last, F.col("owner"), 1, datetime(1998, 1, 1).date())))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Exchange" not in plan[:plan.index("Window [")]


def test_moved_orders_need_no_second_read(spark, sf):
    """WB lines are read and joined once for rows and their later versions."""
    staged = fact_queries.staged_orders(spark, sf)
    plan = _plan(facts.latest_orders(staged), "optimizedPlan")
    assert sum("Relation [l_orderkey" in line for line in plan.splitlines()) == 2
    rows = spark.createDataFrame([("region 2", datetime(1999, 2, 28), datetime(1999, 3, 1)), ("region 3", datetime(1999, 2, 28), None),
                                  (None, None, datetime(1999, 3, 1))], "region string, order_ts timestamp_ntz, change_ts timestamp_ntz")
    assert sorted(map(tuple, fact_queries._with_moved(rows).collect()), key=str) == sorted([
        *map(tuple, rows.collect()), ("region 2", datetime(1995, 2, 28), datetime(2099, 1, 1))], key=str)


def test_items_are_found_in_one_pass(spark, sf, rows):
    """the fact is not derived twice, once for rows with a barcode and once for those without."""
    fact = spark.createDataFrame([("b1", "1"), (None, "2"), ("b2", "3"), (None, "2")], "barcode string, sku string")
    dim = spark.createDataFrame([("b1", "i2"), ("b1", "i1"), (None, "x")], "barcode string, item_id string")
    assert rows(facts.with_items(fact, dim), "sku", "item") == [("1", "i1"), ("2", "2"), ("2", "2"), ("3", "b2")]
    staged = facts.with_items(facts.latest_orders(fact_queries.staged_orders(spark, sf)), dim)
    assert _plan(staged, "optimizedPlan").count("Window [") == 2


def test_stored_day_is_kept(spark):
    """Limits of the report's days reach the files of a fact that stores the day."""
    dim = spark.createDataFrame([], "barcode string, item_id string")
    fact = spark.createDataFrame([("b", "1", datetime(2024, 1, 2))], "barcode string, sku string, order_ts timestamp_ntz")
    assert str(facts.report_orders(fact, dim).first()["day"]) == "2024-01-02"
    assert str(facts.report_orders(fact.withColumn("day", F.lit("2024-01-09").cast("date")), dim).first()["day"]) == "2024-01-09"


def test_unpacked_is_posexplode(spark):
    pages = spark.createDataFrame([(1, [5, None]), (2, []), (3, None), (4, [None])], "id int, a array<int>")
    assert sorted(map(str, unpacked(pages, "a", "x", "at").select("id", "at", "x").collect())) == sorted(
        map(str, pages.select("id", F.posexplode("a").alias("at", "x")).collect()))


def test_times_as_by_expression(spark):
    texts = ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05.125Z", "2024-01-02T03:04:05.Z", "2024-01-02T03:04:05", None, "1.2Z\n", "a.b", "ZZ"]
    t = spark.createDataFrame([(x,) for x in texts], "t string")
    assert t.filter(~times.drop_fraction("t").eqNullSafe(F.regexp_replace("t", r"\.\d*Z$", "Z"))).count() == 0
    good = t.filter("t like '2024%' and t not like '%.Z'")
    assert good.filter(~times.exact_ts("t").eqNullSafe(F.regexp_replace("t", "Z$", "").cast("timestamp_ntz"))).count() == 0
