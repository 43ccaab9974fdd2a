"""Late changes: told apart from those in time, and kept beside them.

The built-in operators drop a row behind the watermark without a trace. Here a first stream splits
what lands by the same rule, batch after batch: rows in time go on to the operators with state, whose
watermark is never ahead of the split's, and late ones to a folder of their own.

    <target>/late=false/batch=<n>/...   rows in time
    <target>/late=true/batch=<n>/...    late rows
    <target>-marks/batch=<n>/...        highest change time up to the batch, in microseconds
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradeloom.streaming import changes
from tradeloom.streaming.changes import BATCH

LATE_DAYS = 45
LATE = "late"


def _mark(spark: SparkSession, marks: str, number: int) -> int | None:
    """Highest change time before a batch; one folder is read, however many batches there were."""
    before = [n for n in changes.batches(spark, marks) if n < number]
    return spark.read.parquet(f"{marks}/{BATCH}={before[-1]}").first()[0] if before else None


def split(rows: DataFrame, target: str, checkpoint: str, change: str, days: int = LATE_DAYS) -> StreamingQuery:
    """Write the changes of a stream in two parts: in time, and more than `days` behind the highest
    change time of the batches before.

    A batch that runs again finds the same mark and overwrites its own folders, so a lost driver or
    executor neither moves a row to the other side nor repeats it. Rows without a change time
    are in time. A row exactly at the limit is late, as it is for Spark's watermark, which counts whole
    milliseconds.
    """
    marks = f"{target.rstrip('/')}-marks"

    def write(batch: DataFrame, number: int) -> None:
        spark, at, seen = batch.sparkSession, F.unix_micros(F.col(change).cast("timestamp")), Observation()
        before = _mark(spark, marks, number)
        late = F.lit(False) if before is None else F.coalesce(at <= (before // 1000 - days * 86_400_000) * 1000, F.lit(False))
        batch.observe(seen, F.max(at).alias("top")).withColumns({LATE: late, BATCH: F.lit(number)}).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy(LATE, BATCH).parquet(target)
        tops = [t for t in (before, seen.get["top"]) if t is not None]
        if tops:
            spark.createDataFrame([(max(tops),)], "top long").write.mode("overwrite").parquet(f"{marks}/{BATCH}={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def in_time(spark: SparkSession, target: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """Stream of the rows in time."""
    stored = T.StructType([*schema.fields, T.StructField(BATCH, T.IntegerType())])
    return changes.landed(spark, f"{target}/{LATE}=false", stored, files_per_batch=files_per_batch).drop(BATCH)


def late_rows(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The late rows so far, as they came, with the batch that brought them."""
    stored = T.StructType([*schema.fields, T.StructField(LATE, T.BooleanType()), T.StructField(BATCH, T.IntegerType())])
    if not changes.batches(spark, f"{target}/{LATE}=true"):
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(BATCH, T.IntegerType())]))
    return spark.read.schema(stored).option("basePath", target).parquet(f"{target}/{LATE}=true").drop(LATE)


def distinct_run(rows: DataFrame, work: str, keys: list[str], change: str, days: int = LATE_DAYS) -> tuple[str, str]:
    """Everything that has landed so far through the split and the dedup; returns the folders of both outputs.

    The first folder holds each version of a row once, as `changes.distinct_changes` keeps it within
    the window; `late_rows` reads the second one. Run it again when more has landed: the
    checkpoints below `work` remember what was read.
    """
    spark, schema = rows.sparkSession, rows.schema
    target, kept = f"{work}/split", f"{work}/kept"
    split(rows, target, f"{work}/split-checkpoint", change, days).awaitTermination()
    if changes.batches(spark, f"{target}/{LATE}=false"):
        once = changes.distinct_changes(in_time(spark, target, schema), keys, change, f"{days} days")
        changes.append_run(once, kept, f"{work}/kept-checkpoint").awaitTermination()
    return kept, target
