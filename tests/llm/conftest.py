import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from edges import SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, source[, lang]]), over several partitions, with columns of clashing names."""
    def build(rows, clash=True, parts=3):
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(parts)
        if clash:
            for c in ("size", "n", "node", "scope", "item", "score", "target", "copies", "th", "token", "own", "block", "p", "host",
                      "_scope", "_SCOPE2", "_text", "_spans", "_r1", "_r2", "_th", "_i", "_s", "_t", "_n", "_copy", "_id", "_y0"):
                df = df.withColumn(c, F.lit("x"))
        return df

    return build
