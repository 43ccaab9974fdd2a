"""Monthly realization reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Field -> report label, in report order.
DETAIL_LABELS = {
    "realizationreport_id": "Номер отчёта.",
    "date_from": "Дата начала отчётного периода",
    "date_to": "Дата конца отчётного периода",
    "create_dt": "Дата формирования отчёта",
    "currency_name": "Валюта отчёта",
    "suppliercontract_code": "Договор",
    "rrd_id": "Номер строки",
    "gi_id": "Номер поставки",
    "subject_name": "Предмет",
    "nm_id": "Артикул WB",
    "brand_name": "Бренд",
    "sa_name": "Артикул продавца",
    "ts_name": "Размер",
    "barcode": "Баркод",
    "doc_type_name": "Тип документа",
    "quantity": "Количество",
    "retail_price": "Цена розничная",
    "retail_amount": "Сумма продаж (возвратов)",
    "sale_percent": "Согласованная скидка",
    "commission_percent": "Процент комиссии",
    "office_name": "Склад",
    "supplier_oper_name": "Обоснование для оплаты",
    "order_dt": "Дата заказа.",
    "sale_dt": "Дата продажи.",
    "rr_dt": "Дата операции.",
    "shk_id": "Штрих-код",
    "retail_price_withdisc_rub": "Цена розничная с учетом согласованной скидки",
    "delivery_amount": "Количество доставок",
    "return_amount": "Количество возвратов",
    "delivery_rub": "Стоимость логистики",
    "gi_box_type_name": "Тип коробов",
    "product_discount_for_report": "Согласованный продуктовый дисконт",
    "supplier_promo": "Промокод",
    "rid": "Уникальный идентификатор заказа",
    "ppvz_spp_prc": "Скидка постоянного покупателя",
    "ppvz_kvw_prc_base": "Размер кВВ без НДС, % базовый",
    "ppvz_kvw_prc": "Итоговый кВВ без НДС, %",
    "sup_rating_prc_up": "Размер снижения кВВ из-за рейтинга",
    "is_kgvp_v2": "Размер снижения кВВ из-за акции",
    "ppvz_sales_commission": "Вознаграждение с продаж до вычета услуг поверенного, без НДС",
    "ppvz_for_pay": "К перечислению продавцу за реализованный товар",
    "ppvz_reward": "Возмещение за выдачу и возврат товаров на ПВЗ",
    "acquiring_fee": "Возмещение издержек по эквайрингу.",
    "acquiring_bank": "Наименование банка-эквайера",
    "ppvz_vw": "Вознаграждение WB без НДС",
    "ppvz_vw_nds": "НДС с вознаграждения WB",
    "ppvz_office_id": "Номер офиса",
    "ppvz_office_name": "Наименование офиса доставки",
    "ppvz_supplier_id": "Номер партнера",
    "ppvz_supplier_name": "Партнер",
    "ppvz_inn": "ИНН партнера",
    "declaration_number": "Номер таможенной декларации",
    "bonus_type_name": "Обоснование штрафов и доплат.",
    "sticker_id": "Цифровое значение стикера",
    "site_country": "Страна продажи",
    "penalty": "Штрафы",
    "additional_payment": "Доплаты",
    "rebill_logistic_cost": "Возмещение издержек по перевозке.",
    "rebill_logistic_org": "Организатор перевозки.",
    "kiz": "Код маркировки.",
    "srid": "Уникальный идентификатор заказа.",
}
# Field -> label of the header section, in report order.
HEADER_LABELS = [
    ("num", "Номер отчёта о реализации."),
    ("doc_date", "Дата формирования отчёта."),
    ("contract_date", "Дата заключения договора оферты."),
    ("contract_num", "Номер договора оферты."),
    ("currency_code", "Валюта ваших цен."),
    ("doc_amount", "Сумма к начислению."),
    ("vat_amount", "Сумма к начислению с НДС."),
    ("payer_inn", "ИНН плательщика."),
    ("payer_kpp", "КПП плательщика."),
    ("payer_name", "Название плательщика."),
    ("rcv_inn", "ИНН получателя."),
    ("rcv_kpp", "КПП получателя."),
    ("rcv_name", "Название получателя."),
    ("start_date", "Начало периода в отчёте."),
    ("stop_date", "Конец периода в отчёте."),
]
# Field -> label of the line section, in report order.
LINE_LABELS = [
    ("row_number", "Номер строки в отчёте."),
    ("product_id", "Идентификатор товара."),
    ("product_name", "Наименование товара."),
    ("barcode", "Штрихкод товара."),
    ("offer_id", "Код товара продавца — артикул."),
    ("commission_percent", "Комиссия за продажу по категории."),
    ("price", "Цена продавца с учётом его скидки."),
    ("price_sale", "Цена реализации"),
    ("sale_amount", "Реализовано на сумму."),
    ("sale_commission", "Комиссия за реализованный товар с учётом скидок и наценки."),
    ("sale_discount", "Доплата за счёт Ozon."),
    ("sale_price_seller", "Итого к начислению за реализованный товар."),
    ("sale_qty", "Количество товара"),
    ("return_sale", "Цена реализации"),
    ("return_amount", "Возвращено на сумму."),
    ("return_commission", "Комиссия с учётом количества товара"),
    ("return_discount", "Доплата за счёт Ozon."),
    ("return_price_seller", "Итого возвращено."),
    ("return_qty", "Количество возвращённого товара."),
]


def labelled(rows: DataFrame, labels: dict[str, str] | None = None) -> DataFrame:
    """Columns under their report labels; a field the rows lack is null."""
    labels = labels or DETAIL_LABELS
    have = set(rows.columns)
    return rows.select(*[(F.col(k) if k in have else F.lit(None).cast("string")).alias(v) for k, v in labels.items()])


def header_rows(pages: DataFrame) -> DataFrame:
    """Header section, one row per report."""
    return pages.select(*[F.col("result.header").getField(k).alias(k) for k, _ in HEADER_LABELS])


def line_rows(pages: DataFrame) -> DataFrame:
    """Line section, one row per product line, after its report number."""
    lines = pages.select(F.col("result.header.num").alias("num"), F.explode("result.rows").alias("line"))
    return lines.select("num", *[F.col("line").getField(k).alias(k) for k, _ in LINE_LABELS])


def section_labels(labels: list[tuple[str, str]]) -> list[str]:
    """Labels of a section in order. Some repeat, so they are a row and not column names."""
    return [label for _, label in labels]
