"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import WORD, numbered, unit


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """(source, source_size) with `target`: the total shared by weight, at most `most` times a source's size.

    Sources by code point, null last, have the weights in turn. The fair share per unit of weight
    is found in one pass: sources ordered by the share at which they are full; the first k are
    full, the rest share what is left, for the smallest k whose share does not fill the next one.
    The window is over one row per source, not over documents.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("w", w)
    full = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    every = full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({
        "total": F.sum("source_size").over(every),
        "full_before": F.coalesce(F.sum("source_size").over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "w_left": F.sum("w").over(full.rowsBetween(0, Window.unboundedFollowing)),
    })
    # Whole numbers up to the one division, so every engine gets the same double.
    left = F.col("total") - most * F.col("full_before")
    rows = rows.withColumns({"left": left, "open": most * F.col("source_size") * F.col("w_left") >= left * F.col("w")})
    first = full.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("share", F.first(F.when(F.col("open"), F.struct("left", "w_left")), ignorenulls=True).over(first))
    target = F.when(F.col("share").isNull(), (most * F.col("source_size")).cast("double")).otherwise(
        (F.col("share.left") * F.col("w")).cast("double") / F.col("share.w_left"))
    return rows.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def systematic(rows: DataFrame, group: str, copies: str, order: list[str], seed: str) -> DataFrame:
    """Add `_copies`: how often systematic sampling emits a row.

    The expected copies are summed up in order within the group, one random offset of the group is
    added, and a row is emitted once per whole number that its step crosses. So a row with e
    expected copies comes floor(e) or ceil(e) times, and a group's count is its expected sum,
    rounded down or up. The offset depends on the group's text and the seed: reruns agree.
    """
    run = numbered(rows, [group], order, "mix", sums=(copies,))
    offset = unit(F.col(group), seed)
    low = F.col(f"_before_{copies}") + offset
    return run.withColumn("_copies", (F.floor(low + F.col(copies)) - F.floor(low)).cast("long")).drop("_nr", f"_before_{copies}")


def mix(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: str = "mix") -> DataFrame:
    """(doc_id, source, size) with `source_size`, `target` and `copies` of each row.

    All documents of a source have the same expected copies, target / source size. They are laid
    out by size, so that small and large ones are hit alike and the words taken come near the
    target. The running sum of equal steps is position times step, which is exact where repeated
    addition is not. No row comes more than `most` times. Documents without words have nothing to
    take and come 0 or more times like others; a source without words has target 0 and gives none.
    Null sources are one source; repeated rows are rows of their own.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sizes, weights, most).withColumnRenamed("source", "_source")
    run = numbered(sized, ["source"], ["size", "doc_id"], "mix")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = unit(F.col("source"), seed)
    copies = F.floor((F.col("_nr") + 1) * rate + offset) - F.floor(F.col("_nr") * rate + offset)
    rows = run.join(goal, F.col("source").eqNullSafe(F.col("_source")), "left")
    return rows.withColumn("copies", copies.cast("long")).drop("_nr", "_source")
