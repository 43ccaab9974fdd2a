"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import written


def stars(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b) but the roots: the smallest node of its component.

    Each round hangs the larger neighbours of a node on its smallest one, then does the same among
    the smaller ones; the number of rounds grows with the logarithm of a path's length. Minima are
    pre-aggregated and joined back, so a node with very many edges does not sit in one task. A round
    ends in a written table.
    """
    e = edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, mark = written(e, "edges"), None
    while True:
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(now)
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = written(small.select("u", "m").union(small.filter("v != m").select("v", "m")).toDF("u", "v").distinct(), "edges")
