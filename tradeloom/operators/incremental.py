"""Cursors, batches and windows that plan the next load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.common import as_col, as_value

# Load planning defaults.
LOOK_BACK_DAYS = 45
ROWS_PER_WINDOW = 60_000
DAYS_WITHOUT_RECORD = 20
DAYS_WITHOUT_ROWS = 15
STEP = "interval 1 second"


def next_cursor(df: DataFrame, ts: Column | str, by: list[str] | None = None, since=None,
                step: str = STEP) -> DataFrame:
    """Where the next read starts: one step past the highest change time.

    The cursor never falls behind `since`, the start of the range.
    """
    top = F.max(as_col(ts))
    if since is not None:
        top = F.greatest(top, as_value(since).cast("timestamp_ntz"))
    return df.groupBy(*(by or [])).agg((top + F.expr(step)).alias("cursor"))


def requested(df: DataFrame, ts: Column | str, since, until=None) -> DataFrame:
    """Rows of the range a source is asked for: from `since` on and, where given, before `until`.

    The limits are plain values beside the bare column, so they reach the scan.
    """
    at, stamp = as_col(ts), lambda v: as_value(v).cast("timestamp_ntz")
    kept = df.filter(at >= stamp(since))
    return kept if until is None else kept.filter(at < stamp(until))


def restart_point(df: DataFrame, ts: Column | str, since, page: str | None = None, by: list[str] | None = None,
                  step: str = STEP) -> DataFrame:
    """Start of the range that follows pages cut off at the offset limit.

    The highest time of the last page decides where `page` numbers the pages, else that of all
    rows; the start never falls behind `since`, the start of the range that was asked for.
    """
    if page is not None:
        top = F.max(F.struct(F.col(page).alias("page"), as_col(ts).alias("at")))["at"]
    else:
        top = F.max(as_col(ts))
    start = F.greatest(top, as_value(since).cast("timestamp_ntz"))
    return df.groupBy(*(by or [])).agg((start + F.expr(step)).alias("restart_at"))


def feed_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per feed and owner."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("qnt"))


def window_days(owners: DataFrame, counts: DataFrame, keys: list[str], days: int = LOOK_BACK_DAYS,
                rows: int = ROWS_PER_WINDOW) -> DataFrame:
    """Days to ask for at once, so that a reply holds about `rows` rows."""
    rate = F.col("qnt") / F.lit(float(days))
    fitting = F.least(F.floor(F.lit(float(rows)) / rate).cast("int"), F.lit(days))
    chosen = F.when(F.col("qnt").isNull(), DAYS_WITHOUT_RECORD).when(rate == 0, DAYS_WITHOUT_ROWS).otherwise(fitting)
    return owners.join(counts.select(*keys, "qnt"), keys, "left").select(*keys, "qnt", chosen.alias("window_days"))


def key_batches(df: DataFrame, owner: str, key: str, size: int, spread: Column | None = None,
                buckets: int = 1024) -> DataFrame:
    """Number the distinct keys of each owner into batches of exactly `size` keys.

    A plain row number would sort all keys of an owner in one task. Keys are
    numbered inside `buckets` hash buckets instead and shifted by the number of
    keys in the buckets before; only those counts, at most `buckets` per owner,
    are ever put in one order. Choose `buckets` so that a bucket of the largest owner
    fits a task, as one chooses the number of shuffle partitions.

    The counts are made where the rows are numbered, so both sides of the join are
    one plan down to the same shuffle, which runs once. A null owner is an owner like any other.
    """
    place_of = F.pmod(spread if spread is not None else F.xxhash64(key), F.lit(buckets)).cast("int")
    # never null, so the join below adds no filter to one side and both sides share one shuffle of the keys
    keys = df.select(owner, key).distinct().withColumns({"_bucket": F.coalesce(place_of, F.lit(0)), "_owner": F.struct(owner)})
    slot = Window.partitionBy("_owner", "_bucket")
    numbered = keys.withColumns({"_row": F.row_number().over(slot.orderBy(key)), "_n": F.count(F.lit(1)).over(slot)})
    before = Window.partitionBy("_owner").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = numbered.filter("_row = 1").select("_owner", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    # a struct of a null is no null, so a plain join finds it
    return numbered.join(shift, ["_owner", "_bucket"]).select(owner, key, F.expr(f"(_shift + _row - 1) div {int(size)}").alias("batch"),
                           F.expr(f"cast((_shift + _row - 1) % {int(size)} as int)").alias("position"))


def range_pieces(ranges: DataFrame, first: str, last: str, months: int = 3) -> DataFrame:
    """Split each date range into pieces of some months; neighbours share their boundary day.

    Pieces are counted from the start of the range and the last one ends with it.
    """
    most = F.ceil(F.months_between(F.col(last), F.col(first)) / months).cast("int")
    piece = F.explode(F.sequence(F.lit(0), F.greatest(most, F.lit(0)))).alias("piece")
    start = F.add_months(F.col(first), F.col("piece") * months)
    stop = F.least(F.add_months(F.col(first), (F.col("piece") + 1) * months), F.col(last))
    return ranges.select("*", piece).withColumns({"piece_from": start, "piece_to": stop}) \
        .filter((F.col("piece") == 0) | (F.col("piece_from") < F.col(last)))


def keyset_page(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """Next page behind a key."""
    return df.filter(F.col(key) > as_value(after)).orderBy(key).limit(size)


def last_completed(transactions: DataFrame) -> DataFrame:
    """Highest id of a completed transaction, zero where there is none."""
    return transactions.filter(F.col("status") == "COMPLETED") \
        .agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint").alias("id"))
