"""A stream over files that land one by one gives the batch answer."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.operators import dedup
from tradeloom.sources import published
from tradeloom.streaming import changes, late

SCHEMA = "k string, ts timestamp_ntz, v int"
T0 = datetime(2024, 1, 1)


def land(spark, folder, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def batches():
    def row(k, minutes, v):
        return (k, T0 + timedelta(minutes=minutes), v)

    return [[row("a", 1, 1), row("a", 3, 2), row("b", 2, 3)], [row("a", 2, 4), row("c", 1, 5)], [row("b", 9, 6), row("a", 3, 2)]]


def test_change_log_matches_batch(spark, tmp_path, rows):
    folder, log, check = (str(tmp_path / n) for n in ("in", "log", "check"))
    for data in batches():
        land(spark, folder, data)
        stream = changes.landed(spark, folder, SCHEMA, files_per_batch=1)
        changes.change_log(stream, log, check, ["k"], ["ts", "v"]).awaitTermination()
    now = changes.current(spark, log, ["k"], ["ts", "v"])
    want = rows(dedup.latest_version(spark.read.parquet(folder), ["k"], "ts"), "k", "ts", "v")
    assert rows(now, "k", "ts", "v") == want and len(want) == 3
    base = changes.compact(spark, log, str(tmp_path / "base"), ["k"], ["ts", "v"])
    assert rows(changes.current(spark, log, ["k"], ["ts", "v"], base), "k", "ts", "v") == want and base[1] == 2
    # Batches that are in the base are not read again; those behind it are, and a second base takes over.
    land(spark, folder, [("c", T0 + timedelta(minutes=20), 9)])
    changes.change_log(changes.landed(spark, folder, SCHEMA), log, check, ["k"], ["ts", "v"]).awaitTermination()
    want = rows(dedup.latest_version(spark.read.parquet(folder), ["k"], "ts"), "k", "ts", "v")
    assert rows(changes.current(spark, log, ["k"], ["ts", "v"], base), "k", "ts", "v") == want
    again = changes.compact(spark, log, str(tmp_path / "base2"), ["k"], ["ts", "v"], base)
    assert again[1] == 3 and rows(changes.current(spark, log, ["k"], ["ts", "v"], again), "k", "ts", "v") == want


def test_a_restart_reads_no_file_twice(spark, tmp_path, rows):
    folder, target, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    land(spark, folder, batches()[0])
    for _ in range(2):
        changes.append_run(changes.landed(spark, folder, SCHEMA), target, check).awaitTermination()
    assert spark.read.parquet(target).count() == 3


def test_repeats_are_dropped_and_versions_kept(spark, tmp_path, rows):
    folder, target, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for data in batches():
        land(spark, folder, data)
        once = changes.distinct_changes(changes.landed(spark, folder, SCHEMA), ["k"], "ts")
        changes.append_run(once, target, check).awaitTermination()
    assert rows(spark.read.parquet(target), "k", "v") == [("a", 1), ("a", 2), ("a", 4), ("b", 3), ("b", 6), ("c", 5)]


def test_late_change_inside_the_window_is_kept(spark, tmp_path, rows):
    folder, target, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for data in ([("new", T0 + timedelta(days=60), 1)], [("inside", T0 + timedelta(days=20), 2)]):
        land(spark, folder, data)
        once = changes.distinct_changes(changes.landed(spark, folder, SCHEMA), ["k"], "ts")
        changes.append_run(once, target, check).awaitTermination()
    assert rows(spark.read.parquet(target), "k") == [("inside",), ("new",)]


def test_a_run_replaces_its_earlier_try(spark, tmp_path, rows):
    more, folder, target = str(tmp_path / "more"), str(tmp_path / "in"), str(tmp_path / "out")
    for data in batches():
        land(spark, more, data)
    land(spark, folder, batches()[0])
    # The first try of run 7 had three micro-batches, the second has one; run 6 stays.
    for attempt, (source, run) in enumerate([(folder, 6), (more, 7), (folder, 7)]):
        stream = changes.landed(spark, source, SCHEMA, files_per_batch=1).selectExpr("k", "v", f"{run} as run")
        changes.replace_run(stream, target, str(tmp_path / f"try{attempt}"), "run")
    assert rows(spark.read.parquet(target), "k", "v", "run") == [
        (k, v, run) for k, v in (("a", 1), ("a", 2), ("b", 3)) for run in (6, 7)]


def test_compacting_a_log_without_rows(spark, tmp_path, rows):
    folder, log, check = (str(tmp_path / n) for n in ("in", "log", "check"))
    assert changes.compact(spark, log, str(tmp_path / "b0"), ["k"], ["ts", "v"]) is None
    land(spark, folder, [])
    changes.change_log(changes.landed(spark, folder, SCHEMA), log, check, ["k"], ["ts", "v"]).awaitTermination()
    assert changes.compact(spark, log, str(tmp_path / "b1"), ["k"], ["ts", "v"]) is None
    with pytest.raises(ValueError, match="no change was logged"):
        changes.current(spark, log, ["k"], ["ts", "v"])
    land(spark, folder, batches()[0])
    changes.change_log(changes.landed(spark, folder, SCHEMA), log, check, ["k"], ["ts", "v"]).awaitTermination()
    base = changes.compact(spark, log, str(tmp_path / "b2"), ["k"], ["ts", "v"])
    # Nothing came behind the base, so it stays, and the state is read from it alone.
    assert changes.compact(spark, log, str(tmp_path / "b3"), ["k"], ["ts", "v"], base) == base
    assert rows(changes.current(spark, log, ["k"], ["ts", "v"], base), "k", "v") == [("a", 2), ("b", 3)]


def _run(spark, source, run):
    return changes.landed(spark, source, SCHEMA, files_per_batch=1).selectExpr("k", "v", f"{run} as run")


@pytest.mark.parametrize("kind", ["replace", "publish"])
def test_pulls_that_are_empty_or_missing_or_fail(spark, tmp_path, rows, kind):
    full, empty, none, target = (str(tmp_path / n) for n in ("full", "empty", "none", "out"))
    land(spark, full, batches()[0])
    land(spark, empty, [])
    (tmp_path / "none").mkdir()
    load = changes.replace_run if kind == "replace" else changes.publish_run
    now = lambda: rows(spark.read.parquet(target) if kind == "replace" else published.read(spark, target), "k", "v", "run")
    three = lambda run: [("a", 1, run), ("a", 2, run), ("b", 3, run)]
    for run in (6, 7):
        load(_run(spark, full, run), target, str(tmp_path / f"t{run}"), "run", run)
    both = sorted(three(6) + three(7), key=str)
    assert now() == both
    load(_run(spark, none, 7), target, str(tmp_path / "t8"), "run", 7)
    assert now() == both
    failing = _run(spark, full, 7).withColumn("v", F.raise_error(F.lit("broken pull")).cast("int"))
    with pytest.raises(Exception, match="broken pull"):
        load(failing, target, str(tmp_path / "t9"), "run", 7)
    assert now() == both
    load(_run(spark, empty, 7), target, str(tmp_path / "t10"), "run", 7)
    assert now() == three(6)


LATE_SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("ts", T.TimestampType()), T.StructField("v", T.IntegerType())])


def _late_land(spark, folder, *data):
    some = [(k, None if d is None else T0 + timedelta(days=d, minutes=m), v) for k, d, m, v in data]
    spark.createDataFrame(some, LATE_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_late_rows_go_to_their_own_side(spark, tmp_path, rows):
    folder, work = str(tmp_path / "in"), str(tmp_path / "w")
    landings = [
        [("a", 50, 0, 1), ("b", 1, 0, 2), ("n", None, 0, 3), ("a", 50, 0, 1)],  # the first batch has no mark, so nothing in it is late
        [("a", 50, 0, 1), ("edge", 5, 0, 4), ("in", 5, 1, 5), ("b", 1, 0, 2), ("n", None, 0, 3)],
        [("c", 60, 0, 6), ("in", 5, 1, 5)],
        [("d", 15, 0, 7), ("d", 15, 1, 8), ("c", 60, 0, 6)],
    ]
    for landing in landings:
        _late_land(spark, folder, *landing)
        stream = changes.landed(spark, folder, LATE_SCHEMA)
        kept, target = late.distinct_run(stream, work, ["k"], "ts", days=45)
    # Nothing new has landed: both sides stay.
    late.distinct_run(changes.landed(spark, folder, LATE_SCHEMA), work, ["k"], "ts", days=45)
    assert rows(spark.read.parquet(kept).filter("ts is not null"), "k", "v") == [("a", 1), ("b", 2), ("c", 6), ("d", 8), ("in", 5)]
    assert rows(late.late_rows(spark, target, LATE_SCHEMA), "k", "v", "batch") == [("b", 2, 1), ("d", 7, 3), ("edge", 4, 1)]


def test_a_batch_that_runs_again_splits_alike(spark, tmp_path, rows):
    folder, work = str(tmp_path / "in"), str(tmp_path / "w")
    for landing in ([("a", 50, 0, 1)], [("b", 1, 0, 2), ("c", 60, 0, 3)]):
        _late_land(spark, folder, *landing)
        late.split(changes.landed(spark, folder, LATE_SCHEMA), f"{work}/s", f"{work}/c", "ts").awaitTermination()
    before = rows(late.late_rows(spark, f"{work}/s", LATE_SCHEMA))
    (tmp_path / "w" / "c" / "commits" / "1").unlink()  # the driver was lost before batch 1 was noted as done
    for crc in (tmp_path / "w" / "c" / "commits").glob(".1.crc"):
        crc.unlink()
    late.split(changes.landed(spark, folder, LATE_SCHEMA), f"{work}/s", f"{work}/c", "ts").awaitTermination()
    assert rows(late.late_rows(spark, f"{work}/s", LATE_SCHEMA)) == before and len(before) == 1
    assert spark.read.parquet(f"{work}/s").count() == 3


def test_no_late_rows(spark, tmp_path):
    folder, work = str(tmp_path / "in"), str(tmp_path / "w")
    (tmp_path / "in").mkdir()
    kept, target = late.distinct_run(changes.landed(spark, folder, LATE_SCHEMA), work, ["k"], "ts")
    assert late.late_rows(spark, target, LATE_SCHEMA).count() == 0
