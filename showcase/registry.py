"""Registry of queries and their SQL checks."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.session import shared_dir, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """New folder per run below the shared one; nothing is ever cleared."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


BROKEN = "a field of this load cannot be read"


def broken(df: DataFrame, column: str) -> DataFrame:
    """Rows whose column cannot be read: a load of them fails while it is written."""
    return df.withColumn(column, F.raise_error(F.lit(BROKEN)).cast(df.schema[column].dataType))


def fails(load: Callable[[], object]) -> None:
    """Run a load of broken rows; it must not get through."""
    try:
        load()
    except Exception as x:
        if BROKEN not in str(x):
            raise
    else:
        raise AssertionError("a broken load got through")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text: types every client prints alike."""
    def one(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        return c.alias(field.name)

    return df.select(*[one(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register a query under `name`, with the SQL that must give the same rows."""
    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(tune(spark), sf_dir))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return add
