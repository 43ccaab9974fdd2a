"""Helpers of several operators: work tables, numbering without large groups, words."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Characters that part words: space, tab to carriage return. `bytes.split()` parts at the same ones.
WORD = r"[^\x20\x09-\x0D]+"


def work_dir(spark: SparkSession) -> str:
    """The shared folder of `spark.checkpoint.dir`; where it is unset, one beside the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}-work").rstrip("/")


def written(df: DataFrame, name: str, rows: int = 500) -> DataFrame:
    """`df` as a table written once in a new shared folder: it cuts lineage and outlives executors.

    Meanwhile Python tasks get at most `rows` rows at once, as these may be long texts, which take
    room in the JVM's buffers and in Python; afterwards the session's own number holds again.
    """
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    path, before = f"{work_dir(spark)}/llm-{name}-{uuid.uuid4().hex}", spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until `df` has no column of that name in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unit(key: Column, seed: str) -> Column:
    """Number in (0, 1) that depends on the text of `key` and the seed alone."""
    head = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("|" + seed)).cast("binary")), 1, 12)
    return (F.conv(head, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 48))


def numbered(df: DataFrame, group: list[str], order: list[str], name: str, sums: tuple[str, ...] = ()) -> DataFrame:
    """Add `_nr` (0, 1, ... within `group`, by `order`) and `_before_<c>` for each column c of `sums`:
    its sum over the earlier rows of the group.

    Rows are dealt by ranges of (group, order), so a group with a third of all rows lies in many
    partitions. The dealt rows are written with their partition; numbers run inside (partition,
    group) and are shifted by the totals of the partitions before. Ties are numbered in any order.
    """
    spark, n = df.sparkSession, parts(df.sparkSession)
    by = [F.col(c).asc_nulls_last() for c in group + order]
    dealt = written(df.repartitionByRange(n, *by).withColumn("_pid", F.spark_partition_id()), name)
    slot, keys = [F.col("_pid")] + [F.col(c) for c in group], ["_pid", *group]
    totals = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in sums])
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select(*keys, *[
        F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_at{c}") for c in ["_n", *[f"_sum_{c}" for c in sums]]
    ])
    inner = Window.partitionBy(*slot).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    rows = dealt.withColumns({
        "_nr": F.row_number().over(inner) - 1,
        **{f"_before_{c}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in sums},
    })
    shift = shift.toDF(*[f"_r{c}" if c in keys else c for c in shift.columns])
    on = [F.col(c).eqNullSafe(F.col(f"_r{c}")) for c in keys]
    joined = rows.join(shift, on=_all(on), how="left")
    return joined.select(
        *[F.col(c) for c in df.columns], (F.col("_nr") + F.col("_at_n")).cast("long").alias("_nr"),
        *[(F.col(f"_before_{c}") + F.col(f"_at_sum_{c}")).alias(f"_before_{c}") for c in sums],
    )


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts of `rows` rows, so that few texts are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def in_executor() -> None:
    """Settings of libraries inside a Python worker: one thread for each task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
