"""Landed feeds derived from the given tables.

One row of a table gives one document with a handful of array entries. Nothing
is collected per order or owner, so a key that holds a third of the rows gives
many documents and never a big one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showcase.registry import table
from tradeloom.sources import schemas

CENTS = "cast(cast({} as decimal(18,2)) as string)"


def shaped(df: DataFrame, schema: str) -> DataFrame:
    """The one landed column in its declared type; other columns stay.

    A cast that only changes nullability would rebuild every document, so it is left out.
    """
    name, kind = schema.split(" ", 1)
    name, declared = name.strip("`"), T.DataType.fromDDL(kind)
    if df.schema[name].dataType.simpleString() == declared.simpleString():
        return df
    return df.withColumn(name, F.col(name).cast(declared))


def line_items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with their order."""
    return line_items(spark, sf).join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))


def owned_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with order and owner."""
    return lines(spark, sf) \
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")) \
        .withColumn("owner", F.col("c_mktsegment"))


_FINANCE_ROW = (
    "named_struct('product_id', {sku}, 'commission_amount', {amount}, 'commission_percent', {percent},"
    " 'payout', l_extendedprice, 'old_price', l_extendedprice, 'total_discount_value', l_discount,"
    " 'total_discount_percent', l_tax, 'client_price', _cents)"
)
_PRODUCT = (
    "named_struct('sku', {sku}, 'name', concat('part ', {sku}), 'quantity', cast({qty} as int),"
    " 'offer_id', concat('of-', l_partkey), 'price', {price})"
)


def _posting(with_created: bool, number: str) -> Column:
    """A posting of none to three product lines; line 7 is empty and has no financial data."""
    main = _PRODUCT.format(sku="l_partkey", qty="l_quantity", price="_cents")
    side = _PRODUCT.format(sku="l_partkey + 1", qty="1", price=CENTS.format("l_tax"))
    again = _PRODUCT.format(sku="l_partkey", qty="2", price=CENTS.format("l_discount"))
    products = (
        f"case when l_linenumber = 7 then array() when l_linenumber = 3 then array({main}, {side})"
        f" when l_linenumber = 4 then array({main}, {again}) when l_linenumber = 6 then array({main}, {side}, {main})"
        f" else array({main}) end"
    )
    finance = ", ".join([
        _FINANCE_ROW.format(sku="l_partkey", amount="l_tax", percent="1.0D"),
        _FINANCE_ROW.format(sku="l_partkey + 1", amount="l_quantity", percent="2.0D"),
        _FINANCE_ROW.format(sku="l_partkey", amount="l_discount", percent="3.0D"),
    ])
    created = (
        "'created_at', concat(date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\"),"
        " if(l_linenumber in (1, 3, 5), '.125Z', 'Z')),"
    )
    return F.expr(f"""named_struct(
        'order_id', l_orderkey, 'order_number', concat(o_custkey, '-', l_orderkey),
        'posting_number', {number},
        'status', case o_orderstatus when 'F' then 'delivered' when 'O' then 'awaiting' else 'cancelled' end,
        {created if with_created else ''}
        'in_process_at', date_format(l_shipdate, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        'products', {products},
        'analytics_data', named_struct('region', o_orderpriority, 'city', nullif(l_returnflag, 'N'),
            'warehouse_name', if(l_tax = 0, null, concat('wh ', l_suppkey)), 'warehouse_id', l_suppkey),
        'financial_data', if(l_linenumber = 7, null, named_struct('products', array({finance})))
    )""")


def _priced(df: DataFrame) -> DataFrame:
    """Lines with their price as text, which a posting holds up to six times; an empty posting has none."""
    return df.withColumn("_cents", F.expr(f"if(l_linenumber = 7, null, {CENTS.format('l_extendedprice')})"))


LINE_NUMBER = "concat(l_orderkey, '-', l_linenumber)"
# Orders the documents of equal number; holds every column that tells them apart.
PAGE = (
    "concat_ws('-', lpad(l_partkey, 12, '0'), lpad(l_suppkey, 12, '0'), lpad(cast(l_quantity as int), 4, '0'),"
    " lpad(cast(round(l_extendedprice * 100) as bigint), 15, '0'), l_returnflag, l_linestatus,"
    " cast(round(l_discount * 100) as int), cast(round(l_tax * 100) as int))"
)


def fbo(df: DataFrame, *keep: str) -> DataFrame:
    pages = _priced(df).select(*keep, F.expr(PAGE).alias("page"), F.array(_posting(True, LINE_NUMBER)).alias("result"))
    return shaped(pages, schemas.FBO_PAGE)


def fbs(df: DataFrame, *keep: str) -> DataFrame:
    page = F.struct(F.lit(False).alias("has_next"), F.array(_posting(False, LINE_NUMBER)).alias("postings"))
    return shaped(_priced(df).select(*keep, page.alias("result")), schemas.FBS_PAGE)


_TIME = "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss\")"
_WB_PLACE = "if(l_tax = 0, null, concat('wh ', l_suppkey)) as warehouseName"
_WB_ITEM = (
    "concat('art-', l_partkey) as supplierArticle", "cast(l_linenumber as string) as techSize",
    "lpad(l_partkey, 13, '0') as barcode", "l_returnflag as category", "l_linestatus as subject",
    "concat('b', l_linenumber) as brand", "l_partkey as nmId",
)
_WB_MONEY = (
    "l_extendedprice as totalPrice", "l_discount as discountPercent", "l_tax as spp",
    "l_extendedprice * (1 - l_discount) as finishedPrice", "l_extendedprice as priceWithDisc",
)


def _documents(df: DataFrame, exprs: list[str], schema: str, keep: tuple[str, ...]) -> DataFrame:
    """Flat documents with the declared fields in the declared order and types."""
    fields = [part.strip().split(" ") for part in schema.split(",")]
    return df.selectExpr(*keep, *exprs).select(*keep, *[F.col(n).cast(kind).alias(n) for n, kind in fields])


def wb_orders(df: DataFrame, date: str = "l_shipdate", change: str = "l_shipdate", *keep: str) -> DataFrame:
    return _documents(df, [
        f"{_TIME.format(date)} as date", f"{_TIME.format(change)} as lastChangeDate", _WB_PLACE, *_WB_ITEM, *_WB_MONEY,
        "concat('region ', l_linenumber) as regionName", "l_orderkey as incomeID", "nullif(l_returnflag, 'A') = 'R' as isCancel",
        f"if(l_returnflag = 'R', {_TIME.format(change)}, '0001-01-01T00:00:00') as cancelDate",
        "concat('g', l_orderkey) as gNumber", "'' as sticker", "concat('o', l_orderkey) as srid",
        "'client' as orderType", "'RU' as countryName", "concat('okrug ', l_linenumber) as oblastOkrugName",
    ], schemas.WB_ORDER, keep)


def wb_sales(df: DataFrame, date: str = "l_shipdate", change: str = "l_shipdate", *keep: str) -> DataFrame:
    """Sales; those of line 7 name no order, their `srid` is the number zero; that of line 6 is the text "0"."""
    return _documents(df, [
        f"{_TIME.format(date)} as date", f"{_TIME.format(change)} as lastChangeDate", _WB_PLACE, *_WB_ITEM, *_WB_MONEY,
        "'RU' as countryName", "concat('okrug ', l_linenumber) as oblastOkrugName",
        "concat('region ', l_linenumber) as regionName", "l_orderkey as incomeID", "l_linestatus = 'O' as isSupply",
        "l_returnflag = 'A' as isRealization",
        "if(l_returnflag = 'R', -l_extendedprice, l_extendedprice) as forPay",
        "concat(if(l_returnflag = 'R', 'R', 'S'), l_orderkey) as saleID", "'' as sticker",
        "concat('g', l_orderkey) as gNumber",
        "parse_json(case l_linenumber when 7 then '0' when 6 then '\"0\"' else concat('\"o', l_orderkey, '\"') end) as srid",
    ], schemas.WB_SALE, keep)


def wb_stock(df: DataFrame, *keep: str) -> DataFrame:
    return _documents(df, [
        f"{_TIME.format('l_shipdate')} as lastChangeDate", _WB_PLACE, *_WB_ITEM,
        "cast(l_quantity as int) as quantity", "l_linenumber as inWayToClient", "0 as inWayFromClient",
        "cast(l_quantity as int) + l_linenumber as quantityFull", "l_extendedprice as Price", "l_discount as Discount",
        "l_linestatus = 'O' as isSupply", "l_returnflag = 'A' as isRealization",
    ], schemas.WB_STOCK, keep)


def seller_stock(df: DataFrame, *keep: str) -> DataFrame:
    """SKUs with none to two warehouse cells; line 7 has none, lines 3 and 6 have two."""
    cell = (
        "named_struct('quantity', cast({} as int), 'warehouse', named_struct('name', {}, 'region', l_returnflag,"
        " 'id', {}))"
    )
    one = cell.format("l_quantity", "if(l_tax = 0, null, concat('wh ', l_suppkey))", "cast(l_suppkey as string)")
    two = cell.format("l_linenumber", "'reserve'", "null")
    item = F.expr(f"""named_struct(
        'sku', cast(l_partkey as string), 'method', l_linestatus, 'category', named_struct('name', l_returnflag),
        'price', named_struct('currency', 'RUB', 'base_price', l_extendedprice, 'discount_price', l_discount,
            'premium_price', l_tax, 'ozon_card_price', cast(null as double)),
        'info', named_struct('name', concat('part ', l_partkey), 'brand', l_linestatus, 'seller', 's'),
        'stock', case when l_linenumber = 7 then array() when l_linenumber in (3, 6) then array({one}, {two})
            else array({one}) end)""")
    return shaped(df.select(*keep, F.array(item).alias("result")), schemas.SELLER_STOCK_PAGE)


def analytics_stock(df: DataFrame, *keep: str) -> DataFrame:
    row = F.expr("""named_struct('sku', cast(l_partkey as string), 'item_code', concat('c', l_partkey),
        'item_name', concat('part ', l_partkey), 'free_to_sell_amount', cast(l_quantity as int),
        'promised_amount', l_linenumber, 'reserved_amount', 0,
        'warehouse_name', if(l_tax = 0, null, concat('wh ', l_suppkey)))""")
    return shaped(df.select(*keep, F.struct(F.array(row).alias("rows")).alias("result")),
                  schemas.ANALYTICS_STOCK_PAGE)


def owned_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of two owners: one sells all of them, the other the larger ones, so they share SKUs."""
    owners = F.explode(F.array(F.lit("BUILDING"), F.lit("MACHINERY")))
    return table(spark, sf, "part").withColumn("owner", owners).filter("owner = 'BUILDING' or p_size > 5")


def products(df: DataFrame, *keep: str, barcode: str = "concat('bc-', p_partkey)") -> DataFrame:
    """Product pages; small sizes have no SKU of their own but an FBO and an FBS SKU.

    The FBS SKU is the SKU of the next product, so SKUs repeat over the pages.
    """
    item = F.expr(f"""named_struct(
        'id', p_partkey + 1000000000, 'sku', if(p_size <= 10, 0, p_partkey + 1),
        'fbo_sku', p_partkey + 1, 'fbs_sku', p_partkey + 2, 'barcode', {barcode}, 'created_at', '2024-01-01T00:00:00Z',
        'marketing_price', {CENTS.format('p_retailprice')}, 'min_ozon_price', '', 'min_price', '',
        'offer_id', concat('of-', p_partkey), 'old_price', {CENTS.format('p_retailprice + 10')},
        'premium_price', '', 'price', {CENTS.format('p_retailprice')}, 'name', p_name)""")
    pages = df.select(*keep, F.expr("lpad(p_partkey, 12, '0')").alias("page"),
                      F.struct(F.array(item).alias("items")).alias("result"))
    return shaped(pages, schemas.PRODUCT_PAGE)


def attributes(df: DataFrame, key: str = "id", *keep: str) -> DataFrame:
    """Attribute entries: the brand twice, once empty for large sizes; small sizes lack the category."""
    def entry(no: int, values: str) -> str:
        return f"named_struct('{key}', {no}L, 'values', {values})"

    def one(value: str) -> str:
        return f"array(named_struct('value', {value}))"

    none = "cast(array() as array<struct<value:string>>)"
    entries = F.expr(f"""case
        when p_size > 40 then array({entry(85, one('p_brand'))}, {entry(8229, one('p_type'))}, {entry(85, none)})
        when p_size <= 5 then array({entry(85, one("'old'"))}, {entry(85, one('p_brand'))})
        else array({entry(8229, one("'old'"))}, {entry(85, one('p_brand'))}, {entry(8229, one('p_type'))}) end""")
    item = F.struct((F.col("p_partkey") + 1000000000).alias("id"), entries.alias("attributes"))
    pages = df.select(*keep, F.expr("lpad(p_partkey, 12, '0')").alias("page"), F.array(item).alias("result"))
    return shaped(pages, schemas.ATTRIBUTE_PAGE if key == "id" else schemas.ATTRIBUTE_PAGE_OLDER)


def prices(df: DataFrame) -> DataFrame:
    """Price monitor pages: per line a product with none to two sources and none to two offers each."""
    seen = "cast(unix_timestamp(cast(l_shipdate as timestamp)) as bigint)"
    card = "array(named_struct('key', 'note', 'value', 'x'), named_struct('key', 'card_price', 'value', {}))"
    offer = (
        "named_struct('price', l_extendedprice, 'in_stock', l_linenumber, 'discount_type', {kind},"
        " 'discount', l_discount, 'offer', {name}, 'date', " + seen + ", 'last_check_date', " + seen +
        " + 3600, 'data', {data})"
    )
    with_card = offer.format(kind="0", name="concat(' shop ', l_suppkey)", data=card.format(CENTS.format("l_tax")))
    no_card = offer.format(kind="1", name="if(l_tax = 0, '  ', concat('shop ', l_suppkey, ' '))",
                           data="cast(null as array<struct<key:string,value:string>>)")
    source = (
        "named_struct('company_id', {company}, 'company_name', concat('company ', l_suppkey), 'region_name',"
        " l_returnflag, 'price', {price}, 'in_stock', 1, 'discount_type', 1, 'discount', l_tax, 'offers', {offers})"
    )
    none = f"cast(array() as array<{schemas.PRICE_OFFER}>)"
    full = source.format(company="cast(l_suppkey + 1 as string)", price="l_extendedprice",
                         offers=f"array({with_card}, {no_card})")
    bare = source.format(company="cast(null as string)", price="if(l_returnflag = 'N', null, l_extendedprice)",
                         offers=none)
    nobody = source.format(company="if(l_linestatus = 'O', 'false', '0')", price="l_extendedprice",
                           offers=f"array({with_card})")
    sources = (
        f"case l_linenumber when 7 then null when 6 then array({full}, {bare}) when 5 then array({nobody}, {bare})"
        f" else array({full}) end"
    )
    obj = F.expr(f"""named_struct('client_code', lpad(l_partkey, 13, '0'), 'name', concat('part ', l_partkey),
        'articul', concat('art-', l_partkey), 'category_name', l_returnflag, 'brand_name', l_linestatus,
        'default_price', l_extendedprice, 'sources', {sources})""")
    page = F.struct(F.expr("named_struct('pages_cnt', 1, 'page', 1)").alias("pagination"),
                    F.array(obj).alias("objects"))
    return shaped(df.select(page.alias("result")), schemas.PRICE_PAGE)


def erp_prices(df: DataFrame) -> DataFrame:
    """Price list: two barcodes per part, the second padded and shared with the next part.

    Parts of the ECONOMY type carry an obsolete mark in mixed case.
    """
    entry = F.expr("""named_struct(
        'Номенклатура', if(p_type = 'ECONOMY', concat(p_name, ' (УстАрел)'), p_name),
        'РРЦ', p_retailprice, 'Дистр', p_retailprice - 1, 'Себестоимость', p_retailprice - 2,
        'Штрихкоды', array(concat('bc-', p_partkey), concat(' bc-', p_partkey + 1, ' '), ' ', null,
            concat('bc-', p_partkey)))""")
    pages = df.select(F.expr("lpad(p_partkey, 12, '0')").alias("page"), F.array(entry).alias("Данные"))
    return shaped(pages, schemas.ERP_PRICE_PAGE)


def erp_pages(df: DataFrame, item: str, schema: str) -> DataFrame:
    return shaped(df.select(F.array(F.expr(item)).alias("items")), schema)


def kz_stock(df: DataFrame) -> DataFrame:
    """KZ export: all text, numbers with a decimal comma."""
    comma = "replace(" + CENTS + ", '.', ',')"
    exprs = {
        "Наименование": "concat('part ', l_partkey)", "Штрихкод": "lpad(l_partkey, 13, '0')",
        "SKU": "if(l_linenumber = 7, 'NODASH', concat('ORG', l_suppkey, '-', l_partkey, '-', l_linenumber))",
        "ID товара": "cast(l_partkey as string)", "К отправке": "cast(l_linenumber as string)",
        "В продаже": "'1'", "Возврат": "'0'", "Брак": "'0'",
        "Себест. (руб.)": comma.format("l_tax"), "Стоимость продажи (руб.)": comma.format("l_extendedprice"),
        "Общий остаток": "cast(cast(l_quantity as int) as string)",
        "Общая сумма остатков (руб.)": comma.format("l_extendedprice + 1"),
        "Себест. (сумма) (руб.)": comma.format("l_extendedprice + 2"),
        "Стоимость продажи (сумма) (руб.)": comma.format("l_extendedprice + 3"),
        "Остаток на СДХ": "' 4 '", "Остаток на фотостудии": "'0'",
        "Остаток на СДХ (сумма) (руб.)": comma.format("l_discount"), "Доступно к отправке": "'2'",
    }
    return df.select(*[F.expr(e).alias(name) for name, e in exprs.items()])


def ad_traffic(df: DataFrame) -> DataFrame:
    """Traffic sheet of the events: whole numbers as floats, texts with two slashes."""
    whole = "concat(cast({} as bigint), '.0')"
    cells = [
        "date_format(ts, 'yyyy-MM-dd')", "concat(event_type, '/', 'cpc', if(user_id < 50, '/x', ''))",
        "concat('campaign ', user_id)", "if(event_type = 'view', ' ', event_type)",
        "if(event_type = 'click', null, 'term')", whole.format("user_id"), whole.format("event_id"),
        whole.format("value"), "'2.0'", "'3.0'", whole.format("value * 2"), "'unused'", "'1.0'",
        CENTS.format("value"), CENTS.format("value + 1"), "'5.0'", "''", CENTS.format("value + 2"),
    ]
    return df.select(*[F.expr(e).cast("string").alias(f"c{i}") for i, e in enumerate(cells)])


def ad_orders(df: DataFrame) -> DataFrame:
    """Order sheet of the order lines."""
    whole = "concat({}, '.0')"
    cells = [
        "date_format(l_shipdate, 'yyyy-MM-dd')", whole.format("l_linenumber"), "l_returnflag",
        "concat(l_partkey, '/part ', l_partkey)", whole.format("l_suppkey"), "concat('seller ', l_suppkey)",
        whole.format("l_partkey"), "concat('brand ', l_partkey)", "concat(l_linestatus, '/organic')",
        "'c'", "if(l_tax = 0, '', 'content')", "'term'", whole.format("cast(l_quantity as int)"),
        CENTS.format("l_extendedprice"), CENTS.format("l_tax"), whole.format("l_linenumber"),
        CENTS.format("l_discount"), "''",
    ]
    return df.select(*[F.expr(e).cast("string").alias(f"c{i}") for i, e in enumerate(cells)])


def realization(df: DataFrame) -> DataFrame:
    """Monthly reports, one page per order with two lines."""
    line = (
        "named_struct('row_number', {n}, 'product_id', o_custkey, 'product_name', concat('p', o_custkey),"
        " 'barcode', lpad(o_custkey, 13, '0'), 'offer_id', concat('of-', o_custkey), 'commission_percent', 5.0D,"
        " 'price', o_totalprice, 'price_sale', o_totalprice, 'sale_amount', o_totalprice, 'sale_commission', 0.0D,"
        " 'sale_discount', 0.0D, 'sale_price_seller', o_totalprice, 'sale_qty', {n}, 'return_sale', 0.0D,"
        " 'return_amount', 0.0D, 'return_commission', 0.0D, 'return_discount', 0.0D, 'return_price_seller', 0.0D,"
        " 'return_qty', 0)"
    )
    day = "date_format({}, 'yyyy-MM-dd')"
    head = f"""named_struct('num', cast(o_orderkey as string), 'doc_date', {day.format('o_orderdate')},
        'contract_date', '2020-01-01', 'contract_num', concat('c', o_custkey), 'currency_code', 'RUB',
        'doc_amount', o_totalprice, 'vat_amount', o_totalprice, 'payer_inn', '1', 'payer_kpp', '2',
        'payer_name', 'payer', 'rcv_inn', '3', 'rcv_kpp', '4', 'rcv_name', concat('customer ', o_custkey),
        'start_date', {day.format("trunc(o_orderdate, 'MM')")}, 'stop_date', {day.format('last_day(o_orderdate)')})"""
    page = F.expr(f"named_struct('header', {head}, 'rows', array({line.format(n=1)}, {line.format(n=2)}))")
    return shaped(df.select(page.alias("result")), schemas.REALIZATION_PAGE)


def realization_detail(df: DataFrame) -> DataFrame:
    """Realization rows; most of the 61 fields are left out by the source."""
    return df.selectExpr(
        "cast(l_orderkey as string) as realizationreport_id", "date_format(l_shipdate, 'yyyy-MM-dd') as rr_dt",
        "cast(l_partkey as string) as nm_id", "lpad(l_partkey, 13, '0') as barcode",
        "l_returnflag as doc_type_name", "cast(cast(l_quantity as int) as string) as quantity",
        CENTS.format("l_extendedprice") + " as retail_amount", "concat('wh ', l_suppkey) as office_name",
        "cast(l_linenumber as string) as rrd_id", "cast(l_orderkey as string) as srid",
    )
