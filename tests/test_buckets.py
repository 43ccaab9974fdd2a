"""Bucketed dimensions and sorted pages."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import incremental, lookup
from tradeloom.sources import buckets, published, sorted_pages


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def frame(spark, *data):
    return spark.createDataFrame([*data], "`key id` int, seq int, name string")


def dim(spark, *data):
    return frame(spark, *data).drop("seq")


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_versions_follow_each_other(spark, tmp_path):
    path, k = str(tmp_path / "it's"), ["key id"]
    assert buckets.create(frame(spark, (1, 1, "a"), (2, 1, "b"), (2, 2, "c"), (None, 1, "x")), path, k, 4, ["seq"]) == 1
    assert content(buckets.read(spark, path)) == [(1, 1, "a"), (2, 2, "c")]
    assert buckets.upsert(frame(spark, (2, 7, "d"), (2, 8, None), (3, 1, "e"), (None, 1, "x"), (3, 1, "e")), path, ["seq"]) == 2
    assert content(buckets.read(spark, path)) == [(1, 1, "a"), (2, 8, None), (3, 1, "e")]
    assert buckets.upsert(frame(spark), path, ["seq"]) == 3
    assert content(buckets.read(spark, path)) == content(buckets.read(spark, path, 2))
    assert content(buckets.read(spark, path, 1)) == [(1, 1, "a"), (2, 2, "c")]
    with pytest.raises(ValueError, match="already"):
        buckets.create(frame(spark), path, k, 4, ["seq"])
    with pytest.raises(ValueError, match="no dimension"):
        buckets.read(spark, str(tmp_path / "none"))


def test_another_session_finds_the_buckets(spark, tmp_path, no_broadcast):
    path = str(tmp_path / "d")
    buckets.create(frame(spark, *[(i, 0, f"n{i}") for i in range(100)]), path, ["key id"], 4, ["seq"])
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("dim_")]:
        spark.sql(f"DROP TABLE {name}")  # a new session knows none of them
    assert buckets.read(spark, path).count() == 100 and "Bucketed: true" in plan(buckets.read(spark, path).join(frame(spark), "key id"))


def test_the_old_side_is_not_shuffled(spark, tmp_path, no_broadcast):
    path, k = str(tmp_path / "d"), ["key id"]
    buckets.create(frame(spark, *[(i, 0, f"n{i}") for i in range(100)]), path, k, 4, ["seq"])
    staged = frame(spark, (5, 1, "five"), (500, 1, "new"))
    text = plan(buckets.merged(buckets.read(spark, path), staged, k, ["seq"]))
    head = text[: text.index("FileScan")]
    assert "Exchange" not in head and text.count("Exchange") >= 1
    buckets.upsert(staged, path, ["seq"])
    assert len(list((tmp_path / "d" / "v=000000000002").glob("*.parquet"))) <= 4
    found = lookup.require(frame(spark, (500, 1, "?")).drop("name"), buckets.read(spark, path).drop("seq"), k)
    assert content(found) == [(500, 1, "new")]
    text = plan(found)
    assert "Exchange" not in text[text.index("FileScan") - 400: text.index("FileScan")].split("Sort")[-1]


def test_a_failing_load_leaves_the_last_version(spark, tmp_path):
    path = str(tmp_path / "d")
    buckets.create(frame(spark, (1, 1, "a")), path, ["key id"], 2, ["seq"])
    with pytest.raises(Exception, match="no way"):
        buckets.upsert(frame(spark, (1, 2, "b")).withColumn("name", F.raise_error(F.lit("no way")).cast("string")), path, ["seq"])
    assert content(buckets.read(spark, path)) == [(1, 1, "a")] and buckets.versions(spark, path) == [1]


def test_of_two_loads_at_once_the_second_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "d")
    buckets.create(frame(spark, (1, 1, "a")), path, ["key id"], 2, ["seq"])
    buckets.upsert(frame(spark, (1, 2, "b")), path, ["seq"])
    monkeypatch.setattr(buckets, "versions", lambda *_: [1])  # what the second one saw
    with pytest.raises(published.Conflict):
        buckets.upsert(frame(spark, (1, 3, "c")), path, ["seq"])
    monkeypatch.undo()
    assert content(buckets.read(spark, path)) == [(1, 2, "b")]


@pytest.mark.parametrize("after, size", [(None, 7), (-1, 7), (0, 10), (49, 1), (50, 30), (97, 30), (99, 5), (500, 5)])
def test_pages_are_those_of_all_rows(spark, tmp_path, after, size):
    rows = spark.range(100).selectExpr("id as rrd_id", "id * 2 as v").unionByName(spark.sql("SELECT cast(null as bigint) rrd_id, 1L v"))
    path = str(tmp_path / "s")
    sorted_pages.write(rows, path, "rrd_id", files=10)
    want = incremental.keyset_page(rows, "rrd_id", -1 if after is None else after, size)
    got = sorted_pages.page(spark, path, "rrd_id", after, size)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert len(sorted_pages.files_behind(spark, path, after, size)) <= size / 5 + 3


def test_all_pages_in_turn(spark, tmp_path):
    path, seen, after = str(tmp_path / "s"), [], None
    sorted_pages.write(spark.range(50).selectExpr("id * 3 as k", "cast(id as string) as t").repartition(5), path, "k", files=6)
    while got := [r["k"] for r in sorted_pages.page(spark, path, "k", after, 8).collect()]:
        seen, after = seen + got, got[-1]
    assert seen == [i * 3 for i in range(50)]


def test_no_rows(spark, tmp_path):
    path = str(tmp_path / "s")
    sorted_pages.write(spark.range(0).withColumnRenamed("id", "k"), path, "k", files=3)
    assert sorted_pages.page(spark, path, "k", None, 5).collect() == [] and sorted_pages.page(spark, path, "k", 3, 5).collect() == []
