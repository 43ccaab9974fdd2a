from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tradeloom.functions import files, numbers, text, times


def one(spark, column, **values):
    """Value of a column expression over one row."""
    schema = ", ".join(f"{k} {kind}" for k, (_, kind) in values.items()) or "x int"
    data = [tuple(v for v, _ in values.values()) or (1,)]
    return spark.createDataFrame(data, schema).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("given, want", [("Moscow", "MOSCOW"), (None, "NONE"), ("", "")])
def test_upper_or_none(spark, given, want):
    assert one(spark, text.upper_or_none("c"), c=(given, "string")) == want


@pytest.mark.parametrize("given, want", [
    ("2024-01-02T03:04:05.678Z", datetime(2024, 1, 2, 3, 4, 5)), ("2024-01-02T03:04:05Z", datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02T03:04:05.Z", datetime(2024, 1, 2, 3, 4, 5)), (None, None),
])
def test_fraction_is_dropped(spark, given, want):
    assert one(spark, times.iso_ts("c", zulu=True, fraction=True), c=(given, "string")) == want


def test_fraction_without_drop_is_an_error(spark):
    with pytest.raises(Exception, match="(?i)parse|timestamp"):
        one(spark, times.iso_ts("c", zulu=True), c=("2024-01-02T03:04:05.678Z", "string"))


@pytest.mark.parametrize("given", ["2024-01-02 03:04:05", "2024-01-02", "2024-13-02T03:04:05", "2024-01-02T03:04+03", "x"])
def test_other_time_texts_are_errors(spark, given):
    with pytest.raises(Exception, match="(?i)parse|cast|timestamp"):
        one(spark, times.iso_ts("c"), c=(given, "string"))


@pytest.mark.parametrize("given, first, second", [("a/b", "a", "b"), ("a/b/c", "a", "b"), ("/b", "", "b"), ("a/", "a", "")])
def test_pair_part(spark, given, first, second):
    assert one(spark, text.pair_part("c", 1), c=(given, "string")) == first
    assert one(spark, text.pair_part("c", 2), c=(given, "string")) == second


def test_pair_without_separator(spark):
    assert one(spark, text.pair_part("c", 2, strict=False), c=("alone", "string")) is None
    with pytest.raises(Exception, match="no part 2 in value: alone"):
        one(spark, text.pair_part("c", 2), c=("alone", "string"))


@pytest.mark.parametrize("given, want", [("ORG-12-3", "ORG"), ("NODASH", "NODASH"), ("-x", "")])
def test_before(spark, given, want):
    assert one(spark, text.before("c"), c=(given, "string")) == want


@pytest.mark.parametrize("given, want", [("12,50", 12.5), ("7", 7.0), ("", 0.0), ("  ", 0.0), (None, 0.0)])
def test_comma_number_or_zero(spark, given, want):
    assert one(spark, text.comma_number_or_zero("c"), c=(given, "string")) == want


def test_bad_number_is_an_error(spark):
    with pytest.raises(Exception, match="(?i)cast"):
        one(spark, text.comma_number("c"), c=("12,5x", "string"))


def test_small_text_helpers(spark):
    assert one(spark, text.unquoted("c"), c=(' "ab"c" ', "string")) == "abc"
    assert one(spark, text.blank_to_null("c"), c=("  ", "string")) is None
    assert one(spark, text.blank_to_null("c"), c=(" a", "string")) == " a"
    assert one(spark, text.names_any("c", ["Не использовать", "устарел"]), c=("Чай (УСТАРЕЛ)", "string")) is True
    assert one(spark, text.names_any("c", ["устарел"]), c=("Чай", "string")) is False


def test_name_id_has_uuid_shape_and_ignores_outer_blanks(spark):
    a = one(spark, text.name_id("c"), c=(" shop ", "string"))
    assert a == one(spark, text.name_id("c"), c=("shop", "string"))
    assert [len(p) for p in a.split("-")] == [8, 4, 4, 4, 12]


@pytest.mark.parametrize("month, first, last", [
    ("2023-12", date(2023, 12, 1), date(2023, 12, 31)), ("2024-02", date(2024, 2, 1), date(2024, 2, 29))])
def test_month_bounds(spark, month, first, last):
    assert one(spark, times.month_first("c"), c=(month, "string")) == first
    assert one(spark, times.month_last("c"), c=(month, "string")) == last


def test_windows(spark):
    assert one(spark, times.window_start(date(2024, 3, 1))) == date(2024, 1, 16)
    assert one(spark, times.months_back(date(2024, 5, 31))) == date(2024, 2, 29)


def test_epoch_is_shown_in_the_given_zone(spark):
    assert one(spark, times.epoch_local("c", "Europe/Moscow"), c=(1700000000, "bigint")) == datetime(2023, 11, 15, 1, 13, 20)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert one(spark, times.epoch_local("c", "UTC"), c=(1700000000, "bigint")) == datetime(2023, 11, 14, 22, 13, 20)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("kind, want", [(0, 110.0), (1, 110.0), (2, 110.0), (None, 110.0)])
def test_price_before_discount(spark, kind, want):
    got = one(spark, numbers.price_before_discount("p", "k", "d"), p=(100.0, "double"), k=(kind, "int"), d=(10.0, "double"))
    assert got == pytest.approx(want)


def test_price_before_discount_tells_shares_from_amounts(spark):
    args = dict(p=(200.0, "double"), d=(10.0, "double"))
    assert one(spark, numbers.price_before_discount("p", "k", "d"), k=(0, "int"), **args) == pytest.approx(220.0)
    assert one(spark, numbers.price_before_discount("p", "k", "d"), k=(1, "int"), **args) == 210.0


@pytest.mark.parametrize("given, want", [(1, True), (0, False), (2, False), (None, False)])
def test_available(spark, given, want):
    assert one(spark, numbers.available("c"), c=(given, "int")) is want


@pytest.mark.parametrize("given, want", [("5.0", 5), ("5.9", 5), ("-5.9", -5), (None, None)])
def test_whole(spark, given, want):
    assert one(spark, numbers.whole("c"), c=(given, "string")) == want


def test_max_or_zero(spark):
    df = spark.createDataFrame([(3,), (None,)], "c bigint")
    assert df.agg(numbers.max_or_zero("c")).first()[0] == 3
    assert df.filter("c > 5").agg(numbers.max_or_zero("c")).first()[0] == 0


def test_file_name_facts(spark):
    path = F.lit("file:/x/orders_fbs_20240101_20240331.csv")
    assert one(spark, files.report_scheme(path)) == "FBS"
    first, last = files.report_period(path)
    assert (one(spark, first), one(spark, last)) == (date(2024, 1, 1), date(2024, 3, 31))
    assert one(spark, files.report_scheme(F.lit("/x/returns_fbs.csv"))) is None
    assert one(spark, files.report_period(F.lit("/x/orders_fbo.csv"))[0]) is None
