"""Rows sorted by a key over files, with an index of each file's range.

    <path>/data/...     files of neighbouring keys, sorted
    <path>/index/...    (file, least and greatest key, rows) of each file

A page behind a key is then read from the few files that hold it, however many there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.functions.common import as_value
from tradeloom.operators.incremental import keyset_page


def write(df: DataFrame, path: str, key: str, files: int | None = None) -> None:
    """Write rows sorted by `key` and the index of their files; rows without a key are on no page and left out.

    The ranges come from a sample of the keys, `files` of them or as many as the session shuffles to. A key
    lies in one file whatever its rows are, as pages are made for keys that name a row.
    """
    named = df.filter(F.col(key).isNotNull())
    ranged = named.repartitionByRange(files, key) if files else named.repartitionByRange(key)
    ranged.sortWithinPartitions(key).write.mode("overwrite").parquet(f"{path}/data")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/data")
    index = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("least"), F.max(key).alias("greatest"), F.count(F.lit(1)).alias("rows"))
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}/index")  # one row a file


def files_behind(spark: SparkSession, path: str, after, size: int) -> list[str]:
    """The files that hold the next `size` rows behind a key, no more.

    Of the file that the key itself lies in it is not known how many rows follow, so none are counted on.
    """
    index = spark.read.parquet(f"{path}/index")
    some = index if after is None else index.filter(F.col("greatest") > as_value(after))
    sure = F.col("rows") if after is None else F.when(F.col("least") > as_value(after), F.col("rows")).otherwise(0)
    before = Window.orderBy("least", "file").rowsBetween(Window.unboundedPreceding, -1)  # over files, not rows
    needed = some.withColumn("before", F.coalesce(F.sum(sure).over(before), F.lit(0))).filter(F.col("before") < size)
    return [r[0] for r in needed.select("file").collect()]  # at most size + 1: every file holds rows


def page(spark: SparkSession, path: str, key: str, after, size: int) -> DataFrame:
    """Next page behind a key, or the first page where `after` is None; equal to `keyset_page` over all rows."""
    stored = spark.read.parquet(f"{path}/data")
    chosen = files_behind(spark, path, after, size)
    if not chosen:
        return spark.createDataFrame([], stored.schema)
    rows = spark.read.schema(stored.schema).parquet(*chosen)
    return rows.orderBy(key).limit(size) if after is None else keyset_page(rows, key, after, size)
