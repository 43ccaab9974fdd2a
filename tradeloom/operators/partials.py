"""States that are folded: a batch leaves partial aggregates, and partials merge into a base.

A partial holds, for each key, what later batches need to go on: the last value of each column with
the place it came from, or a count. Partials of different batches merge in any order, so the state
is their merge, and the log itself is read once, batch by batch. They are a table published by batch;
folding puts all of them into one slice, the base, and clears theirs in the same step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.sources import published

BATCH, BASE = "batch", "is_base"

#: Columns of a request and the kinds of events that set them, see `state.request_ledger`.
LEDGER = {
    "owner_code": ("created",), "type": ("created",), "status": ("created", "polled", "loaded", "failed"), "link": ("polled",),
    "error": ("polled", "loaded", "failed"), "file_name": ("loaded",),
}


def ledger_partial(log: DataFrame, key: str = "uuid", at: str = "seq", columns: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Per key and column the last value set and its place `<column>_at`; null places where nothing set it."""
    out = []
    for name, kinds in (columns or LEDGER).items():
        when = F.when(F.col("kind").isin(*kinds), F.col(at))
        out += [F.max_by(name, when).alias(name), F.max(when).alias(f"{name}_at")]
    return log.groupBy(key).agg(*out)


def ledger_merge(parts: DataFrame, key: str = "uuid") -> DataFrame:
    """One partial per key of several."""
    names = [c[:-3] for c in parts.columns if c.endswith("_at") and c[:-3] in parts.columns]
    return parts.groupBy(key).agg(*[f for c in names for f in (F.max_by(c, f"{c}_at").alias(c), F.max(f"{c}_at").alias(f"{c}_at"))])


def ledger_state(parts: DataFrame, key: str = "uuid") -> DataFrame:
    """Current state of the requests, equal to `state.request_ledger` over all their events."""
    merged = ledger_merge(parts, key)
    return merged.select(key, *[c[:-3] for c in merged.columns if c.endswith("_at") and c[:-3] in merged.columns])


def count_partial(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("qnt"))


def count_merge(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*[c for c in parts.columns if c != "qnt"]).agg(F.sum("qnt").alias("qnt"))


def _folded(slices: DataFrame) -> int | None:
    return slices.filter(BASE).agg(F.max(BATCH)).first()[0]


def add(part: DataFrame, path: str, batch: int) -> int | None:
    """Publish the partial of a batch. One that runs again replaces its own; one that the base holds is left out."""
    spark = part.sparkSession
    if published.versions(spark, path):
        upto = _folded(published.manifest(spark, path))
        if upto is not None and batch <= upto:
            return None
    rows = part.withColumns({BATCH: F.lit(batch), BASE: F.lit(False)})
    return published.publish(rows, path, [BATCH, BASE], slices=[{BATCH: batch, BASE: False}])


def parts(spark: SparkSession, path: str) -> DataFrame:
    """Base and later partials, to be merged."""
    return published.read(spark, path).drop(BATCH, BASE)


def fold(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame]) -> int | None:
    """Merge all partials into the base. Readers see the state before or after; both are equal.

    Batches must be added in the order of their numbers: a fold closes all numbers up to the highest one.
    """
    slices = published.manifest(spark, path)
    upto, open_ = slices.agg(F.max(BATCH), F.count_if(~F.col(BASE))).first()
    if not open_:
        return None
    base = merge(parts(spark, path)).withColumns({BATCH: F.lit(upto), BASE: F.lit(True)})
    return published.publish(base, path, [BATCH, BASE], gone=F.col(BATCH) <= upto)
