"""Table states as rewrites: old rows and staged rows in, new state out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.common import as_value
from tradeloom.operators.dedup import first_wins, last_wins


def _outside(old: DataFrame, slices: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `old` in none of the slices; a null key is a slice like any other."""
    gone = slices.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return old.join(gone, same, "left_anti")


def replace_slice(old: DataFrame, new: DataFrame, keys: list[str], slices: DataFrame | None = None) -> DataFrame:
    """Drop the old rows of every slice present in `new`, or listed in `slices`, then add `new`.

    List the slices that were asked for: one that came back empty is cleared, too.
    """
    gone = new.select(*keys) if slices is None else new.select(*keys).unionByName(slices.select(*keys))
    return _outside(old, gone, keys).unionByName(new)


def replace_from(old: DataFrame, new: DataFrame, day: Column | str, start) -> DataFrame:
    """Rows before `start`, or without a day, from `old`; rows from `start` on from `new`."""
    at = F.col(day) if isinstance(day, str) else day
    limit = as_value(start).cast("date")
    return old.filter(F.coalesce(at < limit, F.lit(True))).unionByName(new.filter(at >= limit))


def replace_day(old: DataFrame, new: DataFrame, day: str, on, delete: bool) -> DataFrame:
    """Add a computed day; with `delete` the old rows of that day go first."""
    kept = old.filter(~F.coalesce(F.col(day) == as_value(on).cast("date"), F.lit(False))) if delete else old
    return kept.unionByName(new)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Staged rows replace old rows of the same key; the last one by `order` wins among staged repeats.

    `order` names what tells when a row was staged, such as its page and place in it, and must be
    unique within a key. The columns are those of `old`.

    The old side is only filtered: where the staged keys are few, Spark
    broadcasts them and the old rows are not shuffled at all.
    """
    return _outside(old, new, keys).unionByName(last_wins(new, keys, order).select(*old.columns))


def insert_missing(dim: DataFrame, new: DataFrame, on: list[str], order: list) -> DataFrame:
    """Dimension with the rows it does not hold yet; known rows stay as they are.

    The first new row of a key by `order` is taken; a row with a null in its key names nothing.
    """
    named = new.dropna(subset=on)
    return dim.unionByName(first_wins(named.join(dim.select(*on), on, "left_anti"), on, order).select(*dim.columns))


def request_ledger(log: DataFrame, key: str = "uuid", at: str = "seq") -> DataFrame:
    """Current state of report requests from their event log.

    Each kind of event sets its own columns and leaves the others:
    created - status; polled - status, link, error; loaded - status, error,
    file; failed - status, error. A later event of a kind that sets a column
    overwrites it, also with null.
    """
    def last(column: str, *kinds: str) -> Column:
        return F.max_by(column, F.when(F.col("kind").isin(*kinds), F.col(at)))

    every = ("created", "polled", "loaded", "failed")
    return log.groupBy(key).agg(
        last("owner_code", "created").alias("owner_code"), last("type", "created").alias("type"),
        last("status", *every).alias("status"), last("link", "polled").alias("link"),
        last("error", "polled", "loaded", "failed").alias("error"), last("file_name", "loaded").alias("file_name"),
    )


def current_state(log: DataFrame, key: str, ts: str) -> DataFrame:
    """Latest whole row per key."""
    return last_wins(log, [key], [ts, *[c for c in log.columns if c not in (key, ts)]])


def before_transaction(days: DataFrame, transactions: DataFrame, day: str, tx: int) -> DataFrame:
    """Rows that are not of the day before transaction `tx` started."""
    gone = transactions.filter(F.col("id") == tx).select(F.date_sub(F.col("start_date").cast("date"), 1)).scalar()
    return days.filter(F.coalesce(F.col(day) != gone, F.lit(True)))
