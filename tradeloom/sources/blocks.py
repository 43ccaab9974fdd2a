"""Records of large files whose records may hold the record separator.

A delimited file with line breaks in quotes, or one JSON array, cannot be cut into records at any
byte: whether a quote opens or closes a text depends on all bytes before it. Here the file is cut into
pieces at a separator, which Spark does for every byte block by itself, and each piece is summed up by
what it does to a reader that comes to it outside a quoted text and to one that comes inside. These
effects are put together in order, first the pieces of a block, where they are read, then the blocks of a file
(one row a block), so every piece learns how a reader of the whole file comes to it. The files are read three times:
for the effects of the blocks, for what of records crosses blocks (at most two parts of a block), and for all other
records, which are put together where they are read. No text is shuffled but that of records that cross blocks. What the
first two find is small and written to the shared folder; the effects are broadcast, one row a block.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.session import shared_dir
from tradeloom.sources import pieces

_PART = "value string, _file string, _block long, _at long, _head boolean, _end boolean"


def _pieces(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Pieces of the files with their place; those of a block come from one task, in order."""
    return spark.read.option("lineSep", sep).text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_block_length").alias("_length"), F.monotonically_increasing_id().alias("_at"))


def _kept(df: DataFrame) -> DataFrame:
    """The rows by way of a written table: what they come from is computed once."""
    folder = f"{shared_dir(df.sparkSession)}/blocks-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _turned(df: DataFrame, within: list[str], order: str) -> DataFrame:
    """Add `_from_out` and `_from_in`: the state before a row, if the group was entered outside or inside.

    `_out` and `_in` say whether a reader that comes to a row outside or inside leaves it inside. A row either
    leaves the state, turns it, or sets it whatever it was; so the state is what was set last, turned as
    often as rows turned it since.
    """
    before = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("_out") & ~F.col("_in")).cast("long")
    df = df.withColumn("_turns", F.coalesce(F.sum(turns).over(before), F.lit(0)))
    setting = F.when(F.col("_out") == F.col("_in"), F.struct(F.col("_out").alias("to"), F.col("_turns").alias("turns")))
    df = df.withColumn("_set", F.last(setting, ignorenulls=True).over(before))
    odd = (F.col("_turns") - F.coalesce(F.col("_set.turns"), F.lit(0))) % 2 == 1
    state = lambda entered: F.coalesce(F.col("_set.to"), F.lit(entered)) != odd
    return df.withColumns({"_from_out": state(False), "_from_in": state(True)}).drop("_turns", "_set")


def _entered(read: DataFrame, effects: Callable) -> DataFrame:
    """Add `_entry`, `_base` and `_final`: whether a reader of the whole file comes to the block inside a quoted text,
    the depth it has there, and whether the block is the last one of its file.

    The join is broadcast, as pieces must stay in order. Files that are cut into other blocks than before fail the job.
    """
    row = "_file string, _block long, _length long, _out boolean, _in boolean, _sum_out long, _sum_in long"
    blocks = _kept(read.drop("_at").mapInArrow(pieces.block_effects(effects), row))
    up = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    entry = _turned(blocks, ["_file"], "_block").withColumnRenamed("_from_out", "_entry")
    entry = entry.withColumn("_all", F.when(F.col("_entry"), F.col("_sum_in")).otherwise(F.col("_sum_out"))).select(
        "_file", "_block", "_length", "_entry", F.coalesce(F.sum("_all").over(up), F.lit(0)).alias("_base"),
        (F.col("_block") == F.max("_block").over(Window.partitionBy("_file"))).alias("_final"))
    cut = F.raise_error(F.lit("the files are cut into other blocks than before")).cast("boolean")
    return read.join(F.broadcast(_kept(entry)), ["_file", "_block", "_length"], "left").drop("_length") \
        .withColumn("_entry", F.when(F.col("_entry").isNull(), cut).otherwise(F.col("_entry")))


def _records(read: DataFrame, effects: Callable) -> DataFrame:
    """Whole records (`value` with the separator at its end, place of the first piece) of pieces that end with it.

    `_head` tells the record of a header, `_end` the one with the last piece of a file.
    """
    known = _entered(read, effects)
    inner = known.mapInArrow(pieces.records(effects, True), _PART)
    # The pieces at a block's head belong to the last record that began in the blocks before.
    crossing = _kept(known.mapInArrow(pieces.records(effects, False), _PART).withColumnRenamed("_at", "_from"))
    ends = crossing.filter("_from is not null").select("_file", F.col("_block").alias("_began"), "_from")
    heads = crossing.filter("_from is null").select("_file", "_block")
    up = Window.partitionBy("_file").orderBy("_began", "_kind").rowsBetween(Window.unboundedPreceding, -1)
    marks = ends.withColumn("_kind", F.lit(1)).unionByName(
        heads.select("_file", F.col("_block").alias("_began"), F.lit(None).cast("long").alias("_from"), F.lit(0).alias("_kind")))
    record = F.struct(F.col("_began").alias("_block"), F.col("_from").alias("_at"))
    carried = marks.withColumn("_carried", F.last(F.when(F.col("_kind") == 1, record), ignorenulls=True).over(up)) \
        .filter("_kind = 0").select("_file", F.col("_began").alias("_block"), "_carried")
    own = F.when(F.col("_from").isNotNull(), F.struct("_block", F.col("_from").alias("_at")))
    outer = crossing.join(carried, ["_file", "_block"], "left").withColumn("_record", F.coalesce(own, "_carried"))
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_block", "value"))), lambda p: p["value"]), "")
    outer = outer.groupBy("_file", "_record").agg(texts.alias("value"), F.max("_head").alias("_head"), F.max("_end").alias("_end"))
    return inner.unionByName(outer.select("_file", "_record.*", "value", "_head", "_end"))


def _bare(name: str) -> Column:
    """The text without the separator at its end."""
    return F.substring(name, F.lit(1), F.length(name) - 1)


def delimited_records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Records of delimited files as text: `value`, `_file`, `_block`, `_at` that order them, `_head` for the first of a file.

    Quotes are `"`, doubled inside a quoted field. A quote opens a field only at its start, so one amid an
    unquoted field is text. Line breaks inside a field become `\\n`; blank lines between records are dropped.
    A field that is never closed takes the rest of its file, as it does for a reader of the whole file.
    """
    d = re.escape(sep)
    text = '(?:[^"]++|"")*+'
    rest = f'(?:(?:"{text}"[^{d}]*+|[^"{d}][^{d}]*+|){d})*+"{text}'  # whole fields, then one that stays open
    lines, quoted = _pieces(spark, path, "\n"), F.contains("value", F.lit('"'))
    lines = lines.withColumn("value", F.when(F.contains("value", F.lit("\r")), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value")))
    mark = (F.col("_block") == 0) & F.startswith("value", F.lit("\ufeff"))
    lines = lines.withColumn("value", F.when(mark, F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value")))
    lines = lines.withColumns({
        "_out": quoted & F.col("value").rlike(rf"\A{rest}\z"), "_in": ~quoted | F.col("value").rlike(rf'\A{text}(?:"[^{d}]*+{d}{rest})?\z'),
        "value": F.concat("value", F.lit("\n"))})
    return _records(lines, pieces.given).withColumn("value", _bare("value")).filter("value <> ''").drop("_end")


def delimited(spark: SparkSession, path: str, columns: list[str], sep: str = ",", header: bool = True) -> DataFrame:
    """Rows of delimited files, all text; with `header`, the first record of each file is left out."""
    rows = delimited_records(spark, path, sep)
    rows = rows.filter("not _head") if header else rows
    schema = ", ".join(f"`{c}` string" for c in columns)
    return rows.select(F.from_csv("value", schema, {"sep": sep, "quote": '"', "escape": '"'}).alias("row")).select("row.*")


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """Elements of top-level JSON arrays of objects as text: `value`, and `_file`, `_block`, `_at` that order them.

    Files are cut at closing braces, so an array in one line is split like one in many. An array that is cut
    off gives its whole elements and, as the last one, the rest as it is. A file of one object is one element.
    """
    read = _pieces(spark, path, "}").withColumn("value", F.concat("value", F.lit("}")))  # no escape is cut apart: none ends with a brace
    whole = _records(read, pieces.of_json)
    cut_off = F.col("_end") & F.col("value").rlike(r"\A[\x{feff}\s]*+[\[,]")  # an array does not end with a brace
    text = F.when(cut_off, _bare("value")).otherwise(F.col("value"))
    text = F.regexp_replace(text, r"\A[\x{feff}\s,\[]*+", "")
    return whole.withColumn("value", text).filter("startswith(value, '{')").drop("_head", "_end")


def json_rows(spark: SparkSession, path: str, schema: str, corrupt: str) -> DataFrame:
    """Rows of top-level JSON arrays; an element that cannot be read keeps its text in `corrupt`.

    `page` orders them as they were delivered, unique for each.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    padded = lambda c: F.lpad(F.col(c).cast("string"), 20, "0")
    place = F.concat_ws("|", "_file", padded("_block"), padded("_at"))
    rows = json_records(spark, path).select(place.alias("page"), F.from_json("value", f"{schema}, `{corrupt}` string", options).alias("row"))
    # One row each. Filters stay above it; below, they would read the text once more for every field they ask for.
    rows = rows.select("page", F.inline(F.array("row")))
    return rows.select(*rows.columns[1:], "page")
