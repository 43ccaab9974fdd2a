"""Distinct keys and keep-one-row-per-key operators.

Keep-one rows are ranked inside their key. Spark puts a group limit in front of
the shuffle for such a rank, so each task sends on one row per key and a key that
holds a third of all rows costs one task no more than any other key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.common import as_col

_RANK = "_rank"


def _keep_one(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    spec = Window.partitionBy(*[as_col(k) for k in keys]).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(spec)).filter(F.col(_RANK) == 1).drop(_RANK)


def first_wins(df: DataFrame, keys: list, order: list) -> DataFrame:
    """Row with the lowest `order` per key; `order` must be unique within a key."""
    return _keep_one(df, keys, [as_col(o).asc_nulls_last() for o in order])


def last_wins(df: DataFrame, keys: list, order: list) -> DataFrame:
    """Row with the highest `order` per key; `order` must be unique within a key."""
    return _keep_one(df, keys, [as_col(o).desc_nulls_last() for o in order])


def latest_version(df: DataFrame, keys: list[str], change: str, ties: list[str] | None = None) -> DataFrame:
    """Latest row per business key by change time; all other columns break ties."""
    rest = ties if ties is not None else [c for c in df.columns if c not in keys and c != change]
    return last_wins(df, keys, [change, *rest])


def distinct_keys(*frames: DataFrame, key: str = "sku") -> DataFrame:
    """Set union of the keys of several frames, compared as text.

    One distinct over the union: equal keys already meet on the map side.
    """
    parts = [frame.select(F.col(key).cast("string").alias(key)) for frame in frames]
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()
