"""Tables that are published slice by slice.

A slice is the set of rows of one combination of the key columns, such as a day, an owner or a run.
Every load writes its rows into a folder of its own. A manifest names, for every slice, the load that
holds it; it is a small table of its own, and each of its versions appears by one rename after the
load's rows are complete. So a load that fails changes nothing, readers see all slices of a load or
none, a load writes only its own slices and reads no old row, and of two loads that run at once the
second one is refused.

    <path>/data/_load=<id>/<key>=<value>/...    rows of a load
    <path>/manifest/v=<number>/...              (key ..., _load) of every live slice
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD = "_load"
_SCHEMA = "table"


class Conflict(RuntimeError):
    """Another load was published meanwhile."""


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    at, fs = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def make_folder(spark: SparkSession, path: str) -> None:
    """An empty folder, where nothing has landed yet."""
    at, fs = _hadoop(spark, path)
    fs.mkdirs(at)


def _appear(spark: SparkSession, source: str, target: str) -> None:
    """Rename that fails where the target is there already."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    src, dst = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(dst.toUri(), spark._jsc.hadoopConfiguration())
    none = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(src, dst, none)
    except Exception as x:
        if "FileAlreadyExists" in str(x) or "already exists" in str(x):
            raise Conflict(f"{target} was published by another load") from x
        raise


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions, in order."""
    return sorted(int(n[2:]) for n in names(spark, f"{path}/manifest") if n.startswith("v="))


def _manifest_path(path: str, version: int) -> str:
    return f"{path}/manifest/v={version:012d}"


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(key ..., _load) of every live slice of a version, the last one by default."""
    known = versions(spark, path)
    if not known:
        raise ValueError(f"nothing was published at {path}")
    return spark.read.parquet(_manifest_path(path, known[-1] if version is None else version))


def _table_schema(slices: DataFrame) -> T.StructType:
    """The table's schema is written with the manifest, so a table without rows has one, too."""
    return T.StructType.fromJson(json.loads(slices.schema[LOAD].metadata[_SCHEMA]))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def _any_of(slices: list[dict], keys: list[str]) -> Column:
    """Whether a row's keys are those of one of the slices."""
    one = [reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(s[k])) for k in keys]) for s in slices]
    return reduce(lambda a, b: a | b, one, F.lit(False))


def publish(df: DataFrame, path: str, keys: list[str], gone: Column | None = None, slices: list[dict] | None = None,
            check: Callable[[], None] | None = None) -> int:
    """Publish the rows of `df` as the new content of their slices; return the version.

    Slices that `gone`, a condition over the keys, holds for and those listed in `slices` are
    cleared as well where the load brings no rows for them. All others stay as they are and are not
    read. Rows are spread over writers by their slice; AQE gives a large slice several of them and puts
    small ones together. A null key is a slice of its own, and so is an empty text, which reads as null.

    `check` runs when the rows are written and nothing is published yet; what it raises stops the load.
    """
    spark, known = df.sparkSession, versions(df.sparkSession, path)
    number = known[-1] + 1 if known else 1
    old = manifest(spark, path, known[-1]) if known else None
    if old is not None and [(f.name, f.dataType) for f in _table_schema(old)] != [(f.name, f.dataType) for f in df.schema]:
        raise ValueError(f"{path} holds other columns")
    load = f"{number:012d}-{uuid.uuid4().hex}"
    target = f"{path}/data/{LOAD}={load}"
    df.hint("rebalance", *keys).write.partitionBy(*keys).parquet(target)
    if check is not None:
        check()

    written = spark.read.schema(df.schema).parquet(target).select(*keys).distinct()
    label = F.lit(load).alias(LOAD, metadata={_SCHEMA: df.schema.json()})
    now = written.select(*keys, label)
    if old is not None:
        kept = old.filter(~F.coalesce(gone if gone is not None else F.lit(False), F.lit(False)) & ~_any_of(slices or [], keys))
        kept = kept.join(written, _same(kept, written, keys), "left_anti")
        now = kept.select(*keys, F.col(LOAD).alias(LOAD, metadata={_SCHEMA: df.schema.json()})).unionByName(now)
    draft = f"{path}/manifest/.draft-{load}"
    now.write.parquet(draft)
    _appear(spark, draft, _manifest_path(path, number))
    return number


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of the live slices, of the last version or an earlier one.

    Only folders of loads that still hold a slice are listed; filters on keys prune their slices.
    """
    live = manifest(spark, path, version)
    schema, keys = _table_schema(live), [c for c in live.columns if c != LOAD]
    loads = sorted(r[0] for r in live.select(LOAD).distinct().collect())  # loads, not slices or rows
    if not loads:
        return spark.createDataFrame([], schema)
    everything = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
    rows = spark.read.schema(everything).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{LOAD}={x}" for x in loads])
    return rows.join(live, _same(rows, live, [LOAD, *keys]), "left_semi").select(*[F.col(f"`{f.name}`") for f in schema.fields])


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove manifests before the last `keep` versions, and loads that none of the kept ones name.

    Nobody may be loading, nor reading an earlier version, meanwhile. Returns the loads that went.
    """
    known = versions(spark, path)
    used = {r[0] for v in known[-keep:] for r in manifest(spark, path, v).select(LOAD).distinct().collect()}
    for v in known[:-keep]:
        at, fs = _hadoop(spark, _manifest_path(path, v))
        fs.delete(at, True)
    dead = [n for n in names(spark, f"{path}/data") if n.split("=")[-1] not in used]
    for n in dead:
        at, fs = _hadoop(spark, f"{path}/data/{n}")
        fs.delete(at, True)
    return dead
