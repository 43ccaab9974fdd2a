"""Lookups against dimensions.

No join carries a broadcast hint: Catalyst and AQE broadcast a side whose
measured size is below the threshold and otherwise shuffle, splitting hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tradeloom.functions.text import is_blank, name_id

_HIT = "_hit"


def require(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner lookup of a unique key; the job fails at a left row without a match."""
    joined = left.join(right.withColumn(_HIT, F.lit(True)), on, "left")
    key = F.concat_ws("/", *[F.col(c).cast("string") for c in on])
    problem = F.raise_error(F.concat(F.lit(f"no match for {'/'.join(on)}: "), key)).cast("boolean")
    return joined.filter(F.coalesce(F.col(_HIT), problem)).drop(_HIT)


class MissingKeys(LookupError):
    """Rows of a finished load had no match."""


class Report:
    """What a `matched` lookup found missing; known when its rows have been written.

    rows: rows without a match; keys: about how many different keys they had (exact below some
    hundred); examples: some of the keys, at most as many as were asked for, in order.
    """

    def __init__(self, on: list[str], seen: Observation):
        self.on, self._seen = on, seen

    def get(self) -> dict:
        """Waits for the rows to be written, once."""
        got = self._seen.get
        some = sorted({v for k, v in got.items() if k.startswith("example") and v is not None})
        return {"rows": got["rows"], "keys": max(got["keys"], len(some)), "examples": some}

    def check(self) -> None:
        """Fail with all that is known, where anything was missing."""
        got = self.get()
        if got["rows"]:
            raise MissingKeys(f"{got['rows']} rows of about {got['keys']} keys have no match for {'/'.join(self.on)}, "
                              f"such as {', '.join(got['examples'])}")


def matched(left: DataFrame, right: DataFrame, on: list[str], examples: int = 10) -> tuple[DataFrame, Report]:
    """Inner lookup of a unique key, and a report of the left rows that found none.

    The rows are counted in the pass that writes them. Examples are the least key of each of
    `examples` hash classes, so the report's size does not grow with the data. Hand `Report.check` to
    `published.publish`, and a load with missing keys names them and publishes nothing. The report is
    that of the first action on the rows.
    """
    joined = left.join(right.withColumn(_HIT, F.lit(True)), on, "left")
    key = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("(null)")) for c in on])
    lost, seen = F.when(F.col(_HIT).isNull(), key), Observation()
    kinds = [F.min(F.when(F.pmod(F.xxhash64(lost), F.lit(examples)) == i, lost)).alias(f"example{i}") for i in range(examples)]
    joined = joined.observe(seen, F.count(lost).alias("rows"), F.approx_count_distinct(lost).alias("keys"), *kinds)
    return joined.filter(F.col(_HIT)).drop(_HIT), Report(on, seen)


def missing(left: DataFrame, dim: DataFrame, on: list[str]) -> DataFrame:
    """Distinct keys of `left` that the dimension does not hold yet."""
    return left.select(*on).distinct().join(dim.select(*on), on, "left_anti")


def limit_to(left: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is listed."""
    return left.join(keys.select(*on), on, "left_semi")


def new_offers(rows: DataFrame, offers: DataFrame, name: str = "offer_name") -> DataFrame:
    """Offers seen in `rows` but not in the dimension, with a derived id; blanks are skipped."""
    seen = rows.filter(~is_blank(name)).select(F.trim(F.col(name)).alias("name"))
    return missing(seen, offers, ["name"]).select(name_id("name").alias("id"), "name")


def insert_offers(offers: DataFrame, rows: DataFrame, name: str = "offer_name") -> DataFrame:
    """Offer dimension with the new offers of `rows`."""
    return offers.select("id", "name").unionByName(new_offers(rows, offers, name))


def offer_ids(rows: DataFrame, offers: DataFrame, name: str = "offer_name") -> DataFrame:
    """Add `offer_id` by trimmed offer name; a blank name has none.

    An offer the dimension does not hold yet gets the id it will be inserted
    with. That id follows from the name, so the rows need not wait for the insert
    nor be read twice. Blank names, which may be many, are spread over keys that
    match nothing.
    """
    blank = is_blank(name)
    nowhere = F.concat(F.lit(" "), F.xxhash64(*rows.columns).cast("string"))
    dim = offers.select(F.col("id").alias("_id"), F.col("name").alias("_key"))
    found = rows.withColumn("_key", F.when(blank, nowhere).otherwise(F.trim(F.col(name)))).join(dim, ["_key"], "left")
    return found.withColumn("offer_id", F.when(~blank, F.coalesce("_id", name_id(name)))).drop("_key", "_id")


def new_warehouses(rows: DataFrame, dim: DataFrame, source: str, code: str = "warehouse_name") -> DataFrame:
    """Warehouses seen in `rows` but not in the dimension; their cluster is NONE. A null code names none."""
    seen = rows.filter(F.col(code).isNotNull()).select(F.col(code).alias("code"), F.lit(source).alias("source"))
    return missing(seen, dim, ["code", "source"]).withColumn("cluster", F.lit("NONE"))


def insert_warehouses(dim: DataFrame, rows: DataFrame, source: str, code: str = "warehouse_name") -> DataFrame:
    """Warehouse dimension with the new warehouses of `rows`."""
    return dim.select("code", "source", "cluster").unionByName(new_warehouses(rows, dim, source, code))


def connections(links: DataFrame) -> DataFrame:
    """One row per (source, owner) with its order and stock connection, by owner.

    More than one connection for a subject is an error, as it is in a scalar subquery.
    """
    def only(subject: str) -> Column:
        mine = F.when(F.col("subject") == subject, F.col("connection_id"))
        count = F.count(F.when(F.col("subject") == subject, F.lit(1)))
        problem = F.raise_error(F.lit(f"more than one {subject} connection")).cast("string")
        return F.when(count > 1, problem).otherwise(F.max(mine).cast("string"))

    return links.groupBy("source", "owner").agg(
        only("ORDER").alias("order_connection_id"), only("STOCK").alias("stock_connection_id")
    ).orderBy("owner", "source")
