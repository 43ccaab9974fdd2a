"""Sinks: slice replacement, dimension inserts and delimited exports.

All of them can run again after a failure: a slice is written whole, never added to.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def load(df: DataFrame, path: str) -> None:
    """Truncate and load."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def replace_slices(df: DataFrame, path: str, keys: list[str], hot_files: int | None = None,
                   slices: list[dict] | None = None) -> None:
    """Replace the slices (owner, transaction, day) present in `df`; others stay.

    `slices` lists those that were asked for, by their key values: one that came back empty is
    cleared, after the rows are written, so a load that fails leaves the old rows. Between the two
    steps a reader may see rows of an emptied slice; `published.publish` shows all slices of a load at
    once. A slice is spread over `hot_files` writers where given, so one owner with
    most of the rows does not end up in a single task.
    """
    if hot_files:
        spread = [F.col(k) for k in keys] + [F.pmod(F.xxhash64(*df.columns), F.lit(hot_files))]
        df = df.repartition(*spread)
    seen = Observation()
    if slices:
        matched = [F.when(reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(one[k])) for k in keys]), F.lit(i)) for i, one in enumerate(slices)]
        # Rows count as theirs once each; no more numbers than slices were asked for are gathered.
        df = df.observe(seen, F.collect_set(F.coalesce(*matched)).alias("found"))
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    found = set(seen.get["found"]) if slices else set()
    for i, one in enumerate(slices or []):
        if i not in found and not any(slices[j] == one for j in found):
            _clear(df.sparkSession, path, {k: one[k] for k in keys})


def _clear(spark: SparkSession, path: str, values: dict) -> None:
    """Remove the folder of one slice, named as Spark's writer names it."""
    jvm, hidden = spark._jvm, "__HIVE_DEFAULT_PARTITION__"
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    names = [f"{escape(k)}={hidden if v is None else escape(str(v))}" for k, v in values.items()]
    folder = jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *names]))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def export(df: DataFrame, path: str, sep: str = ";", rows_per_file: int | None = None) -> None:
    """Delimited export with a header row and every field quoted."""
    options = {"sep": sep, "quoteAll": "true", "header": "true", "escape": '"', "emptyValue": "", "nullValue": ""}
    if rows_per_file:
        options["maxRecordsPerFile"] = str(rows_per_file)
    df.write.mode("overwrite").options(**options).csv(path)


def export_sections(sections: list[DataFrame], path: str, sep: str = ";") -> None:
    """Report of several sections, one folder per section, in the given order."""
    for i, section in enumerate(sections):
        export(section, f"{path}/section={i}", sep)


def export_labelled(sections: list[tuple[DataFrame, list[str]]], path: str, sep: str = ";") -> None:
    """Report of several sections, each a row of labels and then its rows, all fields quoted.

    Labels may repeat, so they are no column names: they are written as a row, in a file that sorts
    before those of the rows.
    """
    options = {"sep": sep, "quoteAll": "true", "escape": '"', "emptyValue": "", "nullValue": ""}
    for i, (rows, labels) in enumerate(sections):
        schema = ", ".join(f"`{c}` string" for c in rows.columns)
        head = rows.sparkSession.createDataFrame([tuple(labels)], schema)
        head.write.mode("overwrite").options(**options).csv(f"{path}/section={i}/part=0")
        rows.write.mode("overwrite").options(**options).csv(f"{path}/section={i}/part=1")


def write_split(df: DataFrame, path: str, rows_per_file: int, empty: str | None = None) -> None:
    """Write files of a bounded number of rows; every row lands in one of them.

    With `empty`, the job fails with that message where there was no row. Rows are counted as they
    are written, so the plan runs once.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
    if empty is not None and not seen.get["rows"]:
        raise ValueError(empty)


def write_capped(df: DataFrame, path: str, file_bytes: int = 30 << 20, sep: str = "\t") -> None:
    """Delimited text without header in files of at most `file_bytes` bytes; every row lands in one of them.

    A row's size is that of its encoded line. Within each partition of `df` the sizes are summed up
    as the rows come, and the sum numbers the pieces, so no task sees more than the rows of some
    partitions and none of them is counted first. Rows are cut apart by size, as a piece may pass its
    mark by one row: those of up to a tenth of the limit go into pieces of nine tenths, those of up to
    a half into pieces of a half, and larger ones lie alone. A row above the limit fails the job.
    """
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"sep": sep, "escape": '"', "emptyValue": "", "nullValue": ""})
    sized = df.select(line.alias("value"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    size = F.octet_length("value").cast("long") + 1
    problem = F.raise_error(F.concat(F.lit(f"a row is larger than {file_bytes} bytes: "), F.left("value", F.lit(200)))).cast("long")
    sized = sized.withColumn("size", F.when(size <= file_bytes, size).otherwise(problem))
    kind = F.when(F.col("size") * 10 <= file_bytes, 0).when(F.col("size") * 2 <= file_bytes, 1).otherwise(2)
    before = Window.partitionBy("part", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    sums = sized.withColumn("kind", kind).withColumns({
        "sum": F.coalesce(F.sum("size").over(before), F.lit(0)), "nr": F.row_number().over(Window.partitionBy("part", "kind").orderBy("at"))})
    step = F.when(F.col("kind") == 0, file_bytes - file_bytes // 10).otherwise(file_bytes - file_bytes // 2)
    number = F.when(F.col("kind") == 2, F.col("nr")).otherwise(F.floor(F.col("sum") / step))
    named = sums.select("value", F.concat_ws("-", "part", "kind", number).alias("piece"))
    named.write.mode("overwrite").partitionBy("piece").text(path)


def rows_per_file(row_bytes: int, file_bytes: int = 30 << 20) -> int:
    """Rows of about `row_bytes` that make a file of about `file_bytes`."""
    return max(1, file_bytes // max(1, row_bytes))
