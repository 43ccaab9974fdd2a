"""Ozon postings, nested pages to one row per product line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.common import as_value, unpacked
from tradeloom.functions.text import upper_or_none
from tradeloom.functions.times import day_start, exact_ts, iso_ts
from tradeloom.operators.dedup import last_wins
from tradeloom.operators.products import owner_columns

# Columns of the staged order rows, in order.
COLUMNS = [
    "owner_code", "order_id", "order_number", "posting_number", "status", "created_at", "in_process_at", "sku",
    "name", "quantity", "offer_id", "price", "region", "city", "warehouse_name", "warehouse_id",
    "commission_amount", "commission_percent", "payout", "product_id", "old_price", "total_discount_value",
    "total_discount_percent", "client_price", "transaction_id", "schema",
]


_NUMBER = "_posting_number"


def _fields(postings: DataFrame) -> DataFrame:
    """The posting's fields as columns of their own, so that those nobody reads are dropped in front of a sort and shuffle."""
    posting = F.col("posting")
    flat = {f"_{f.name}": posting[f.name] for f in postings.schema["posting"].dataType.fields}
    place, rows = flat.pop("_analytics_data"), flat.pop("_financial_data")["products"]
    flat.update({f"_place_{n}": place[n] for n in ("region", "city", "warehouse_name", "warehouse_id")})
    others = [c for c in postings.columns if c not in ("posting", _NUMBER)]
    if _NUMBER in postings.columns:
        flat[_NUMBER] = F.col(_NUMBER)
    return postings.select(*others, *[c.alias(n) for n, c in flat.items()],
                           rows.alias("_fin_rows"), rows["product_id"].alias("_fin_ids"))


def _lines(postings: DataFrame, keep: Column, strict: bool) -> DataFrame:
    """Explode the kept postings; the posting's fields, `line` and `fin` per product.

    `fin` is the last financial row of the posting with the product's id. Its
    place is searched in the reversed ids and counted from the end: unlike a map
    this needs no key policy, and unlike a lambda it stays in generated code.
    """
    lines = _fields(postings.filter(keep)).select("*", F.explode("_products").alias("line"))
    lines = lines.withColumn("back", F.array_position(F.reverse("_fin_ids"), F.col("line.sku")))
    if strict:
        what = F.concat(F.lit("no financial row for sku "), F.col("line.sku").cast("string"),
                        F.lit(" of posting "), F.col("_posting_number"))
        lines = lines.filter(F.when(F.col("back") > 0, True).otherwise(F.raise_error(what).cast("boolean")))
    return lines.withColumn("fin", F.try_element_at("_fin_rows", -F.nullif(F.col("back"), F.lit(0)).cast("int")))


def _row(lines: DataFrame, scheme: str, owner, run_id, created: Column, warehouse: Column) -> DataFrame:
    values = {
        "owner_code": as_value(owner), "created_at": created, "warehouse_name": warehouse,
        "transaction_id": as_value(run_id), "schema": F.lit(scheme),
    }
    groups = (
        ("_", ("order_id", "order_number", "posting_number", "status", "in_process_at")),
        ("line.", ("sku", "name", "quantity", "offer_id", "price")),
        ("_place_", ("region", "city", "warehouse_id")),
        ("fin.", ("commission_amount", "commission_percent", "payout", "product_id", "old_price",
                  "total_discount_value", "total_discount_percent", "client_price")),
    )
    for parent, names in groups:
        values.update({n: F.col(parent + n) for n in names})
    return lines.select(*[values[c].alias(c) for c in COLUMNS])


def _postings(pages: DataFrame, inside: str) -> DataFrame:
    """One row per posting; an empty page gives a null one. Postings that are no pages any more stay as they are."""
    if "posting" in pages.columns:
        return pages
    return pages.select("*", F.explode_outer(inside).alias("posting")).drop("result")


def flatten_fbo(pages: DataFrame, owner, run_id, since, strict: bool = True) -> DataFrame:
    """FBO postings created on or after `since`; time texts are passed on unchanged.

    An empty page gives a null posting, which the date filter drops.
    """
    postings = _postings(pages, "result")
    keep = iso_ts("posting.created_at", zulu=True, fraction=True) >= day_start(since)
    lines = _lines(postings, keep, strict)
    return _row(lines, "FBO", owner, run_id, F.col("_created_at"), upper_or_none("_place_warehouse_name"))


def flatten_fbs(pages: DataFrame, owner, run_id, since, strict: bool = True) -> DataFrame:
    """FBS postings in process on or after `since`; a fraction in the time is an error."""
    postings = _postings(pages, "result.postings")
    keep = iso_ts("posting.in_process_at", zulu=True).cast("date") >= as_value(since).cast("date")
    lines = _lines(postings, keep, strict)
    return _row(lines, "FBS", owner, run_id, F.col("_in_process_at"), F.lit("FBS"))


def latest_postings(pages: DataFrame, inside: str = "result", keys: list[str] | None = None, packed: bool = True) -> DataFrame:
    """One posting per owner and number, the last version, as pages of a single posting.

    Overlapping pages, also of different load days, repeat postings. `keys` are the page columns that
    tell postings of one number apart; other columns are those of the version that is kept. Versions
    are told apart by their time, fractions included, then by page and place in it. This must run
    before lines of equal SKU are added up, because afterwards a repeat looks like a second line.

    Without `packed` the postings are not put back into pages: `posting` stands beside the page columns,
    which the flatten functions take as well. Catalyst then sees which fields are read, and only those
    are sorted and shuffled; through an array it does not. It also knows that the lines of a posting lie
    in one task, so adding them up needs no shuffle.
    """
    others = [c for c in pages.columns if c not in ("result", "page")]
    by = owner_columns(pages) if keys is None else keys
    each = unpacked(pages.select(*others, "page", "result"), inside, "posting", "at").withColumn(_NUMBER, F.col("posting.posting_number"))
    last = last_wins(each, [_NUMBER, *by], [exact_ts("posting.in_process_at"), "page", "at"])
    if not packed:
        return last.select(*others, "page", "posting", _NUMBER)
    one = F.array("posting")
    if inside != "result":
        one = F.struct(F.lit(False).alias("has_next"), one.alias(inside.split(".")[1]))
    return last.select(*others, "page", one.alias("result"))
