"""Readers of landed files.

A landed file is one page as a marketplace delivered it, so its size is bounded
by the page size of that feed. Files may lie in `owner=<code>` folders; Spark
then adds the owner as a partition column and prunes folders on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.files import report_period, report_scheme
from tradeloom.sources import blocks
from tradeloom.sources.schemas import AD_SHEET, FEEDS

CORRUPT = "_corrupt"


def pages(spark: SparkSession, path: str, feed: str, lines: bool = False, split: bool = False) -> DataFrame:
    """Rows of a JSON feed plus `page`, which orders them: see `ordinal`.

    Set `lines` where a file holds one document per line; such files are split
    between tasks. Set `split` for large files of one array; they are split as well, but owner folders
    become no column. Unreadable documents keep their text in `_corrupt`.
    """
    schema, whole_file = FEEDS[feed]
    if split:
        return blocks.json_rows(spark, path, schema, CORRUPT)
    reader = spark.read.schema(f"{schema}, {CORRUPT} string").options(
        mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, multiLine=str(whole_file and not lines).lower()
    )
    return reader.json(path).withColumn("page", ordinal())


def ordinal() -> Column:
    """Text that sorts documents as they were delivered, unique for each document.

    It is made of the folder, the last number in the file name as a number (page 9 comes before
    page 10), the file name, where the block that was read starts in the file, and the place in it:
    rows of a block come from one task, in order.
    """
    path, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    # Every row of a file goes through this; a regular expression for the folder would try each place of the path.
    folder = F.left(path, F.length(path) - F.length(F.substring_index(path, "/", -1)))
    number = F.regexp_extract(name, r"(\d+)\D*$", 1)
    padded = lambda c: F.lpad(c.cast("string"), 20, "0")
    return F.concat_ws("|", folder, padded(number), name, padded(F.col("_metadata.file_block_start")),
                       padded(F.monotonically_increasing_id()))


def split(df: DataFrame, good_path: str, bad_path: str) -> None:
    """Parse once: write the readable and the unreadable rows of `pages` to folders of their own."""
    staged = f"{good_path.rstrip('/')}-parsed"
    df.withColumn("_readable", F.col(CORRUPT).isNull()).write.mode("overwrite").partitionBy("_readable").parquet(staged)
    parsed = df.sparkSession.read.schema(df.withColumn("_readable", F.lit(True)).schema).parquet(staged)
    parsed.filter("_readable").drop("_readable", CORRUPT).write.mode("overwrite").parquet(good_path)
    parsed.filter("not _readable").select("page", CORRUPT).write.mode("overwrite").parquet(bad_path)


def good(df: DataFrame) -> DataFrame:
    """Readable rows only. Spark wants at least one data column read beside this test."""
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad(df: DataFrame) -> DataFrame:
    """Unreadable rows: the page and its text. Spark wants the pages written first; `split` writes both kinds."""
    return df.filter(F.col(CORRUPT).isNotNull()).select("page", CORRUPT)


def strict(df: DataFrame) -> DataFrame:
    """Readable rows; the job fails at the first unreadable one."""
    problem = F.raise_error(F.concat(F.lit("unreadable page: "), F.col("page")))
    return df.filter(F.when(F.col(CORRUPT).isNull(), True).otherwise(problem.cast("boolean"))).drop(CORRUPT)


def kz_stock_file(spark: SparkSession, path: str, split: bool = False) -> DataFrame:
    """KZ stock export: comma separated, header with Russian names, all text.

    With `split`, a large file is read by several tasks; the plain reader gives the names only.
    """
    whole = spark.read.options(header="true", quote='"', escape='"', multiLine="true").csv(path)
    return blocks.delimited(spark, path, whole.columns) if split else whole


def labelled_section(spark: SparkSession, path: str, section: int, schema: str, sep: str = ";") -> DataFrame:
    """A section of a labelled report, all text, its row of labels first."""
    return spark.read.schema(schema).options(sep=sep, quote='"', escape='"').csv(f"{path}/section={section}/part=*")


def report_files(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Posting reports: semicolons, header skipped, every column as text.

    Adds scheme and period from the file name and drops files of other names.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    raw = spark.read.schema(schema).options(sep=";", quote='"', escape='"', header="true", enforceSchema="true") \
        .csv(path)
    name = F.col("_metadata.file_path")
    first, last = report_period(name)
    return raw.withColumns({"scheme": report_scheme(name), "period_from": first, "period_to": last}) \
        .filter(F.col("scheme").isNotNull())


def report_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids in the tenth column of all CSV files of a folder."""
    columns = [f"c{i}" for i in range(10)]
    schema = ", ".join(f"{c} string" for c in columns)
    raw = spark.read.schema(schema).options(
        sep=";", quote='"', escape='"', header="true", enforceSchema="true", pathGlobFilter="*.csv"
    ).csv(path)
    return raw.select(F.col("c9").alias("id")).distinct()


def staged_text(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab text with a fixed schema; rows that do not fit keep their text in `_corrupt`.

    An empty field is null, quoted or not.
    """
    return spark.read.schema(f"{schema}, {CORRUPT} string").options(
        sep="\t", quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, header="false"
    ).csv(path)


def ad_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Advertising sheet as a delimited export; the first row is skipped."""
    return spark.read.schema(AD_SHEET).options(header="true", enforceSchema="true", sep=";", quote='"', escape='"') \
        .csv(path)


def realization_detail(spark: SparkSession, path: str, fields: list[str], lines: bool = False) -> DataFrame:
    """Realization rows, all text; a field the source left out reads as null."""
    schema = ", ".join(f"{f} string" for f in fields)
    return spark.read.schema(schema).options(multiLine=str(not lines).lower()).json(path)


def control_table(spark: SparkSession, source: str, table: str | None = None, **options: str) -> DataFrame:
    """Control table: a Parquet folder, or a database table where `table` is given."""
    if table is None:
        return spark.read.parquet(source)
    return spark.read.format("jdbc").options(url=source, dbtable=table, **options).load()
