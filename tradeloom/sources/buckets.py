"""Dimensions bucketed by their key: an upsert or a lookup shuffles the staged side only.

Every version of a dimension is a folder of its own that appears by one rename when it is complete, so a
load that fails changes nothing and of two loads that run at once the second one is refused.

    <path>/v=<number>/...    one file a bucket, rows sorted by key in it

A session knows a version as a table over its folder; the folder alone holds the data, so a new session
finds it again. The number of buckets is chosen once, with the first version: as many as the dimension has
partitions when it is read, at the size it will grow to.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.operators.dedup import last_wins
from tradeloom.sources import published

_LAYOUT = "_buckets"  # beside the versions; names keys and number of buckets


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions, in order."""
    return sorted(int(n[2:]) for n in published.names(spark, path) if n.startswith("v="))


def _folder(path: str, version: int) -> str:
    return f"{path}/v={version:012d}"


def _table(path: str) -> str:
    return "dim_" + hashlib.md5(path.encode()).hexdigest()


def _quoted(names: list[str]) -> str:
    return ", ".join("`" + n.replace("`", "``") + "`" for n in names)


def _layout(spark: SparkSession, path: str) -> tuple[list[str], int]:
    row = spark.read.schema("keys array<string>, buckets int").json(f"{path}/{_LAYOUT}").first()
    return list(row["keys"]), row["buckets"]


def _write(df: DataFrame, path: str, keys: list[str], buckets: int) -> int:
    spark, known = df.sparkSession, versions(df.sparkSession, path)
    number = known[-1] + 1 if known else 1
    draft = f"{path}/.draft-{uuid.uuid4().hex}"
    name = _table(draft)
    # a table that is made over a path stays there when the session forgets the table
    df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", draft).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    published._appear(spark, draft, _folder(path, number))
    return number


def create(df: DataFrame, path: str, keys: list[str], buckets: int, order: list) -> int:
    """First version: the last row of each key by `order`; a row with a null in its key names nothing."""
    spark = df.sparkSession
    if versions(spark, path):
        raise ValueError(f"{path} holds a dimension already")
    layout = spark.createDataFrame([(keys, buckets)], "keys array<string>, buckets int").coalesce(1)
    layout.write.mode("overwrite").json(f"{path}/{_LAYOUT}")
    return _write(last_wins(df.dropna(subset=keys), keys, order).repartition(buckets, *keys), path, keys, buckets)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of a version, the last one by default; joins on the keys do not shuffle them."""
    known = versions(spark, path)
    if not known:
        raise ValueError(f"there is no dimension at {path}")
    folder = _folder(path, known[-1] if version is None else version)
    keys, buckets = _layout(spark, path)
    name = _table(folder)
    if not spark.catalog.tableExists(name):
        schema = spark.read.parquet(folder).schema
        columns = ", ".join(f"{_quoted([f.name])} {f.dataType.simpleString()}" for f in schema.fields)
        place = folder.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({_quoted(keys)}) SORTED BY ({_quoted(keys)}) "
                  f"INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def merged(old: DataFrame, staged: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Old rows and the last staged row of each key in one full join; a staged row replaces the whole old one.

    One join keeps the buckets, so the result is written without another shuffle. Both sides hold a key once.
    """
    new = last_wins(staged.dropna(subset=keys), keys, order).select(*keys, F.struct(*[F.col(f"`{c}`") for c in old.columns]).alias("_new"))
    was = old.select(*keys, F.struct(*[F.col(f"`{c}`") for c in old.columns]).alias("_was"))
    row = F.coalesce("_new", "_was")
    return was.join(new, keys, "full_outer").select(*[row[c].alias(c) for c in old.columns])


def upsert(staged: DataFrame, path: str, order: list) -> int:
    """Next version: the last staged row of each key by `order` replaces the old one or is added."""
    spark = staged.sparkSession
    keys, buckets = _layout(spark, path)
    return _write(merged(read(spark, path), staged, keys, order), path, keys, buckets)
