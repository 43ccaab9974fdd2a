"""Rendezvous hashing of stable keys over weighted shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import numbered


def shard_of(key: Column, weights: list[float]) -> Column:
    """Number of the shard with the best score for `key` (null keys are one key).

    A shard's score is -ln(u) / weight, where u in (0, 1) is a hash of key and shard number; the
    lowest wins. So a shard gets keys in proportion to its weight, and a shard added at the end
    takes keys only into itself, because the scores of the others stay. A weight of 0 takes none.
    """
    if not any(w > 0 for w in weights):
        raise ValueError("a shard of positive weight is needed")
    # 53 bits of the hash, so that u is an exact double and never 0.
    scores = [
        F.struct((-F.log((F.shiftrightunsigned(F.xxhash64(F.coalesce(key.cast("string"), F.lit("")), key.isNull(), F.lit(i)), 11)
                          + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(float(w))).alias("score"), F.lit(i).alias("shard"))
        for i, w in enumerate(weights) if w > 0
    ]
    return (F.least(*scores) if len(scores) > 1 else scores[0])["shard"]


def shard(docs: DataFrame, weights: list[float], grown: list[float] | None = None, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Rows of `docs` with `_size`, `_crc32`, `_shard`, `_slot` and, with `grown` weights, `_grown_shard`.

    The key and the weights alone decide the shard. `_slot` numbers the rows of a shard from 0
    without gaps by (key, checksum, size); repeated rows get slots of their own. A null text has
    size 16 and the checksum of the empty text; a null key is hashed like any other. Other columns
    are passed through, also such as are named like inputs of this function's callers; names that
    begin with an underscore are ours.
    """
    bytes_ = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.withColumns({
        "_size": (F.octet_length(bytes_) + 16).cast("long"), "_crc32": F.crc32(bytes_),
        "_shard": shard_of(F.col(key), weights),
        "_grown_shard": shard_of(F.col(key), grown) if grown else F.lit(None).cast("int"),
    })
    return rows


def slots(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """`rows` of `shard` with `_slot`, narrow: select what is needed before, as all columns are shuffled."""
    return numbered(rows, ["_shard"], [key, "_crc32", "_size"], "slots").withColumnRenamed("_nr", "_slot")
