"""Change feeds as streams over landed files.

The checkpoint takes the place of a polling cursor: it records which files were
read, so a restart neither skips nor repeats one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeloom.operators.dedup import last_wins
from tradeloom.sources import published, sinks

BATCH = "batch"
LATE = "45 days"


def landed(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int = 1000,
           **options: str) -> DataFrame:
    """Stream of the files in a landing folder, or of a single file."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch) \
        .options(**options).load(path)


def change_log(changes: DataFrame, log: str, checkpoint: str, keys: list[str], order: list) -> StreamingQuery:
    """Append the last change per key of every micro-batch to a log partitioned by batch.

    A batch overwrites only its own partition, so a batch that runs again after a
    lost executor or driver leaves no repeats. The state as a whole is not
    rewritten per batch; `compact` moves the log into a base from time to time.
    """
    def write(batch: DataFrame, number: int) -> None:
        last_wins(batch, keys, order).withColumn(BATCH, F.lit(number)).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(log)

    return changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()


def batches(spark: SparkSession, log: str) -> list[int]:
    """Numbers of the batches that left rows in a log, by its folders."""
    head = f"{BATCH}="
    return sorted(int(n[len(head):]) for n in published.names(spark, log) if n.startswith(head))


def _versions(spark: SparkSession, log: str, base: tuple[str, int] | None) -> DataFrame:
    """Rows of the base, if any, and of the log's batches behind it; the folders before are not read."""
    known = batches(spark, log)
    if base is None:
        if not known:
            raise ValueError(f"no change was logged at {log}")
        return spark.read.parquet(log)
    path, upto = base
    rows = spark.read.parquet(path)
    if not known or known[-1] <= upto:
        return rows
    later = spark.read.parquet(log)
    return rows.select(*later.columns).unionByName(later.filter(F.col(BATCH) > upto))


def current(spark: SparkSession, log: str, keys: list[str], order: list, base: tuple[str, int] | None = None) -> DataFrame:
    """Last change per key over the base and the log behind it.

    `base` is what `compact` returned: a folder, and the last batch that is in it.
    """
    return last_wins(_versions(spark, log, base), keys, [*order, BATCH]).drop(BATCH)


def compact(spark: SparkSession, log: str, target: str, keys: list[str], order: list,
            base: tuple[str, int] | None = None) -> tuple[str, int] | None:
    """Write the state up to the newest batch of the log as a new base in the folder `target`.

    Later reads need the new base and later batches only; the log's older partitions
    and the base before it can then be removed by whoever owns the folders. Where the log holds
    nothing behind the base, the base stays as it is, which is none at the start.
    """
    known = batches(spark, log)
    if not known or (base is not None and known[-1] <= base[1]):
        return base
    rows = _versions(spark, log, base).filter(F.col(BATCH) <= known[-1])
    last_wins(rows, keys, [*order, BATCH]).write.mode("overwrite").parquet(target)
    return target, known[-1]


def distinct_changes(changes: DataFrame, keys: list[str], change: str, late: str = LATE) -> DataFrame:
    """Drop repeats of the same version of a row that arrive within the late-data window.

    The version is part of the key; without it later changes of a row would be
    taken for repeats. State older than the window is dropped, so it is bounded
    by the changes of that window.
    """
    return changes.withColumn(change, F.col(change).cast("timestamp")).withWatermark(change, late) \
        .dropDuplicatesWithinWatermark([*keys, change])


def append_run(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has landed so far, then stop."""
    return rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint) \
        .outputMode("append").trigger(availableNow=True).start()


def _pulled(rows: DataFrame, checkpoint: str) -> DataFrame | None:
    """All rows of one pull, staged beside its checkpoint; None where no file had landed.

    A batch that runs again replaces itself there. Batches are counted by marks of their own, so a
    pull whose files hold no row is told from one without files, also after the driver was lost.
    """
    staged, marks = f"{checkpoint.rstrip('/')}-rows", f"{checkpoint.rstrip('/')}-batches"
    spark = rows.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn(BATCH, F.lit(number)).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(staged)
        spark.range(1).write.mode("overwrite").parquet(f"{marks}/{BATCH}={number}")

    rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start().awaitTermination()
    if not batches(spark, marks):
        return None
    if not batches(spark, staged):
        return spark.createDataFrame([], rows.schema)
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema.fields)}, {BATCH} int"
    return spark.read.schema(schema).parquet(staged).drop(BATCH)


def replace_run(rows: DataFrame, target: str, checkpoint: str, run: str, value=None) -> None:
    """Load one pull and replace what earlier tries of the same run left behind.

    The micro-batches are staged beside the checkpoint, which is that of this try. When all have
    arrived, the runs that were staged are overwritten in the target as a whole, so batches of an
    earlier try that had more of them do not stay. With `value`, the run that was asked for, a
    pull whose files hold no row clears that run. A pull without files changes nothing.
    """
    staged = _pulled(rows, checkpoint)
    if staged is not None:
        sinks.replace_slices(staged, target, [run], slices=None if value is None else [{run: value}])


def publish_run(rows: DataFrame, path: str, checkpoint: str, run: str, value=None) -> int | None:
    """`replace_run` on a published table: readers see the old run or the new one, never a part.

    Returns the version, or None where no file had landed. A pull that fails publishes nothing.
    """
    staged = _pulled(rows, checkpoint)
    return None if staged is None else published.publish(staged, path, [run], slices=None if value is None else [{run: value}])
