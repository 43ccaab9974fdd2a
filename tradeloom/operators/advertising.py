"""Advertising statistics: two sheet layouts to staged rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.common import as_value
from tradeloom.functions.numbers import whole
from tradeloom.functions.text import blank_to_null, pair_part

# Staged column -> (sheet column, how it is read). Sheet column 11 of traffic is unused.
TRAFFIC = {
    "date": (0, "day"), "source": (1, "first"), "medium": (1, "second"), "campaign": (2, "text"),
    "content": (3, "text"), "term": (4, "text"), "sessions": (5, "whole"), "followers": (6, "whole"),
    "add_to_basket": (7, "whole"), "add_to_favorites": (8, "whole"), "cancel": (9, "whole"),
    "session_duration": (10, "whole"), "ordered_qnt": (12, "whole"), "sum_cost": (13, "money"),
    "sum_price": (14, "money"), "range_attr_qnt": (15, "whole"), "range_attr_sum_cost": (16, "money"),
    "range_attr_sum_price": (17, "money"), "report_date": (0, "day"),
}
ORDERS = {
    "report_date": (0, "day"), "id_com_category": (1, "whole"), "category_name": (2, "text"), "sku": (3, "first"),
    "name": (3, "second"), "seller_id": (4, "whole"), "seller_name": (5, "text"), "brand_id": (6, "whole"),
    "brand_name": (7, "text"), "source": (8, "first"), "medium": (8, "second"), "campaign": (9, "text"),
    "content": (10, "text"), "term": (11, "text"), "ordered_qnt": (12, "whole"), "sum_price": (13, "money"),
    "sum_cost": (14, "money"), "range_attr_qnt": (15, "whole"), "range_attr_sum_price": (16, "money"),
    "range_attr_sum_cost": (17, "money"), "date": (0, "day"),
}


def _read(how: str, c: Column, strict: bool) -> Column:
    if how == "first":
        return pair_part(c, 1, strict)
    if how == "second":
        return pair_part(c, 2, strict)
    if how == "whole":
        return whole(c)
    if how == "money":
        return blank_to_null(c).cast("double")
    if how == "day":
        return F.to_date(c, "yyyy-MM-dd")
    return blank_to_null(c)


def _rows(sheet: DataFrame, layout: dict, owner, doc, strict: bool) -> DataFrame:
    return sheet.select(
        *[_read(how, F.col(f"c{i}"), strict).alias(name) for name, (i, how) in layout.items()],
        as_value(owner).alias("owner_code"), as_value(doc).alias("doc_uuid"),
    )


def traffic_rows(sheet: DataFrame, owner, doc, strict: bool = True) -> DataFrame:
    """Traffic sources in 21 columns. Strict fails where a pair lacks its second part."""
    return _rows(sheet, TRAFFIC, owner, doc, strict)


def order_rows(sheet: DataFrame, owner, doc, strict: bool = True) -> DataFrame:
    """Advertised orders in 23 columns. Strict fails where a pair lacks its second part."""
    return _rows(sheet, ORDERS, owner, doc, strict)
