"""Queries that run a stream over the landed events and read what it wrote.

The events land as several files, so a stream runs in several micro-batches.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from showcase.registry import broken, fails, new_folder, query, table
from showcase.state_queries import LATEST_SQL
from tradeloom.sources import published
from tradeloom.streaming import changes, late


def _land(spark, sf: str, folder: str, part: int | None = None, rows=None):
    """Write the events, or those of one of two parts, as files of a landing folder; return the stream over it.

    Each part has as many files as the table is read in; a micro-batch takes half of a part.
    """
    events = table(spark, sf, "events")
    for half in (0, 1) if part is None else (part,):
        some = F.pmod(F.xxhash64("event_id"), F.lit(2)) == half
        (rows if rows is not None else events).filter(some).write.mode("append").parquet(folder)
    return changes.landed(spark, folder, events.schema, files_per_batch=max(1, len(events.inputFiles()) // 2))


@query("stream_upsert", LATEST_SQL)
def stream_upsert(spark, sf):
    """The log is moved into a base after the first half has landed; the state is base and later batches."""
    work, keys, order = new_folder(spark, "upsert"), ["user_id", "event_type"], ["ts", "event_id"]
    log, checkpoint = f"{work}/log", f"{work}/checkpoint"
    changes.change_log(_land(spark, sf, f"{work}/landed", 0), log, checkpoint, keys, order).awaitTermination()
    base = changes.compact(spark, log, f"{work}/base", keys, order)
    changes.change_log(_land(spark, sf, f"{work}/landed", 1), log, checkpoint, keys, order).awaitTermination()
    now = changes.current(spark, log, keys, order, base)
    return now.select("user_id", "event_type", "event_id",
                      F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "value")


_ROWS = "SELECT event_id, user_id, event_type, CAST(epoch_us(ts) AS BIGINT) AS ts_us, value FROM events"


@query("stream_dedup", _ROWS)
def stream_dedup(spark, sf):
    """Every event lands twice, in different files and micro-batches, as it does where pages overlap."""
    work = new_folder(spark, "dedup")
    for _ in range(2):
        stream = _land(spark, sf, f"{work}/landed")
    once = changes.distinct_changes(stream, ["event_id"], "ts", late="3650 days")
    changes.append_run(once, f"{work}/rows", f"{work}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{work}/rows").select(
        "event_id", "user_id", "event_type", F.unix_micros("ts").alias("ts_us"), "value")


@query("stream_price_run", """
    SELECT CAST(event_id AS BIGINT) AS event_id, value, 12 AS run FROM events
    UNION ALL SELECT CAST(event_id AS BIGINT), value, 11 FROM events""")
def stream_price_run(spark, sf):
    """Run 12 is tried four times: with more rows, without a file, with a field that cannot be read, and right.

    Run 11 stays; run 13 is pulled again without a row, which clears it.
    """
    work = new_folder(spark, "run")
    stream = _land(spark, sf, f"{work}/landed").select("event_id", "value")
    more = _land(spark, sf, f"{work}/more")
    more = _land(spark, sf, f"{work}/more").select("event_id", (F.col("value") + 1).alias("value"))
    table(spark, sf, "events").limit(0).write.parquet(f"{work}/empty")
    empty = changes.landed(spark, f"{work}/empty", table(spark, sf, "events").schema).select("event_id", "value")
    published.make_folder(spark, f"{work}/none")
    none = changes.landed(spark, f"{work}/none", table(spark, sf, "events").schema).select("event_id", "value")

    def pull(number, rows, run):
        return changes.publish_run(rows.withColumn("run", F.lit(run)), f"{work}/rows", f"{work}/try{number}", "run", run)

    for number, (rows, run) in enumerate([(stream, 11), (more, 12), (stream, 13)]):
        pull(number, rows, run)
    assert pull(3, none, 12) is None
    fails(lambda: pull(4, broken(stream, "value"), 12))
    pull(5, empty, 13)
    pull(6, stream, 12)
    return published.read(spark, f"{work}/rows").select("event_id", "value", "run")


_LIMIT = "(max(epoch_us(ts)) // 1000 - 45::BIGINT * 86400000) * 1000"
_SHIFTED = "SELECT event_id + 1000000000 AS event_id, user_id, ts - to_days(CAST(event_id % 7 * 10 AS INT)) AS ts, value FROM events"


@query("stream_late", f"""
    WITH again AS (SELECT event_id, user_id, ts, value FROM events UNION ALL {_SHIFTED}), l AS (SELECT {_LIMIT} AS lim FROM events)
    SELECT 'late' AS side, event_id, user_id, CAST(epoch_us(ts) AS BIGINT) AS ts_us, value FROM again, l WHERE epoch_us(ts) <= lim
    UNION ALL SELECT 'kept', event_id, user_id, CAST(epoch_us(ts) AS BIGINT), value FROM events
    UNION ALL SELECT 'kept', event_id, user_id, CAST(epoch_us(ts) AS BIGINT), value FROM ({_SHIFTED}), l WHERE epoch_us(ts) > lim""")
def stream_late(spark, sf):
    """A window of 45 days: all events land, then land again beside copies that are up to 60 days older.

    Repeats in time are dropped; what lies behind the window goes to the late side.
    """
    work, events = new_folder(spark, "late"), table(spark, sf, "events")
    rows = events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    older = rows.select((F.col("event_id") + 1_000_000_000).alias("event_id"), "user_id",
                        (F.col("ts") - F.make_dt_interval((F.col("event_id") % 7 * 10).cast("int"))).alias("ts"), "value")
    for landing in ([rows], [rows, older]):
        for some in landing:
            some.write.mode("append").parquet(f"{work}/landed")
        stream = changes.landed(spark, f"{work}/landed", rows.schema, files_per_batch=1_000_000)
        kept, split = late.distinct_run(stream, work, ["event_id"], "ts")
    columns = ["event_id", "user_id", F.unix_micros("ts").alias("ts_us"), "value"]
    return spark.read.parquet(kept).select(F.lit("kept").alias("side"), *columns) \
        .unionByName(late.late_rows(spark, split, rows.schema).select(F.lit("late").alias("side"), *columns))
