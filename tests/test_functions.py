import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from facetmill.functions import dates, keys, money, prices, text, urls


def values(spark, ddl, data, *columns):
    df = spark.createDataFrame(data, ddl)
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize(
    "written, expected",
    [
        ("1.234,56", "1234.56"), ("1,234.56", "1234.56"), ("1'234.56", "1234.56"), ("1234,00", "1234"),
        ("1234٫00", "1234"), ("12.00", "12"), ("", None), ("  ", None), ("1,234", "1234"), ("99.5", "99.5"),
        ("1.234.567,89", "1234567.89"), ("1,234,567.89", "1234567.89"), (None, None), (" 12.50 ", "12.50"),
        ("12٫50", None), ("1 234", None),
    ],
)
def test_price_parse(spark, written, expected):
    [(got,)] = values(spark, "p string", [(written,)], prices.parse_price("p"))
    assert got == (None if expected is None else Decimal(expected))


def test_price_rule_order_keeps_lone_decimal_comma_as_thousands_d15(spark):
    [(loose, strict)] = values(
        spark, "p string", [("1234,50",)], prices.parse_price("p"), prices.parse_price("p", True)
    )
    assert (loose, strict) == (Decimal("123450"), Decimal("1234.50"))


def test_unreadable_prices_are_rejects_not_errors(spark):
    got = values(
        spark, "p string", [("12٫50",), ("1 234",), ("",), (None,), ("5",)], prices.is_price_reject("p")
    )
    assert [g[0] for g in got] == [True, True, False, False, False]


def test_order_id_digits(spark):
    got = values(spark, "s string", [("123.0",), ("77",), ("abc",), (None,), (" 5.0",)], prices.leading_digits("s"))
    assert [g[0] for g in got] == ["123", "77", None, None, "5"]


RULES = urls.StoreUrlRules()


@pytest.mark.parametrize(
    "url, is_store, address",
    [
        ("https://www.shop.de/x", True, "www.shop.de"),
        ("https://www.shop.co.uk./", True, "www.shop.co.uk"),
        ("http://shop.local/stus/p/1", True, "shop.local/stus"),
        ("https://www.google.de/?q=www.shop.de", False, None),
        ("https://test.www.shop.de/", False, None),
        ("https://other.example/", False, None),
        ("https://www.ring-paradise.fr/a", True, "www.ring-paradise.fr"),
    ],
)
def test_store_addresses(spark, url, is_store, address):
    [(hit, got)] = values(
        spark, "u string", [(url,)], urls.is_store_url("u", RULES), urls.store_address("u", RULES)
    )
    assert hit is is_store
    if is_store:
        assert got == address


def test_country_from_address(spark):
    got = values(
        spark, "h string", [("www.shop.de",), ("shop.local/stus",), ("localhost",), (None,)],
        urls.top_level_domain("h"), urls.last_segment_tail("h"),
    )
    assert got == [("de", "de"), (None, "us"), (None, "st"), (None, None)]


def test_bad_url_has_no_host(spark):
    got = values(spark, "u string", [("ht tp:// not a url",), ("http://.a.b./c",)], urls.url_host("u"))
    assert got[0] == (None,)


def test_calendar_attributes_sunday_is_one_d10(spark):
    data = [(dt.date(2020, 6, 6),), (dt.date(2020, 6, 7),), (dt.date(2020, 12, 31),)]
    got = spark.createDataFrame(data, "d date").select(*dates.calendar_attributes("d")).collect()
    assert [(r.day_of_week, r.is_weekend) for r in got] == [(7, True), (1, True), (5, False)]
    assert [r.full_day_name for r in got] == ["Saturday", "Sunday", "Thursday"]
    assert got[2].quarter_name == "Quarter 4" and got[2].date_key == 20201231
    assert got[2].full_month_name == "December" and got[2].year_month == "2020-12"


def test_date_key_round_trip(spark):
    got = values(
        spark, "k bigint", [(20200229,), (20190229,), (None,)], dates.date_from_key("k"),
        dates.date_key(dates.date_from_key("k")),
    )
    assert got == [(dt.date(2020, 2, 29), 20200229), (None, None), (None, None)]


def test_local_time_parses_without_zone(spark):
    got = values(spark, "s string", [(" 2020-01-02 03:04:05 ",), ("bad",), (None,)], dates.local_datetime("s"))
    assert [g[0] for g in got] == [dt.datetime(2020, 1, 2, 3, 4, 5), None, None]


def test_hour_slices_grow_with_time(spark):
    data = [(dt.datetime(1969, 12, 31, 23, 59),), (dt.datetime(1970, 1, 1),), (dt.datetime(2020, 3, 29, 2, 30),)]
    got = values(spark, "t timestamp_ntz", data, dates.hour_slice("t"))
    assert [g[0] for g in got] == [-1, 0, 18350 * 24 + 2]


def test_surrogate_keys(spark):
    [(a, b, c, null, single)] = values(
        spark, "x string, y string", [("1", "23")],
        keys.surrogate_key("x", "y"), keys.surrogate_key(F.lit("12"), F.lit("3")),
        keys.surrogate_key("x", "y"), keys.surrogate_key("x", F.lit(None)), keys.surrogate_key(F.lit("abc")),
    )
    assert a != b, "parts are delimited (D3)"
    assert a == c and null is None and a >= 0
    assert single == int("900150983cd24fb", 16)


def test_unknown_key_needs_every_part_unknown(spark):
    got = values(
        spark, "a string, b string", [("Unknown", "Unknown"), ("Unknown", "x")],
        keys.unknown_if_all(F.lit(7).cast("bigint"), "a", "b"),
    )
    assert got == [(-1,), (7,)]


def test_text_defaults(spark):
    got = values(
        spark, "s string", [("-",), (None,), ("x",), ("  ",)],
        text.sentinel_to_default("s"), text.blank_to_null("s"), text.has_text("s"),
    )
    assert got == [
        ("Unknown", "-", True), ("Unknown", None, False), ("x", "x", True), ("  ", None, False)
    ]
    assert values(spark, "s string", [("'Ha'noi'",)], text.strip_char("s", "'")) == [("Ha'noi",)]


def test_value_if_keeps_old_on_unknown_condition(spark):
    got = values(
        spark, "a int", [(1,), (2,), (None,)], text.value_if(F.col("a") == 1, F.lit("new"), F.lit("old"))
    )
    assert got == [("new",), ("old",), ("old",)]


def test_like_any_and_not_like_all(spark):
    got = values(
        spark, "s string", [("abc",), ("xyz",), (None,)],
        text.like_any("s", ["a%", "%q"]), text.not_like_all("s", ["a%", "%q"]),
    )
    assert got == [(True, False), (False, True), (None, None)]


def test_namibia_repair(spark):
    got = values(
        spark, "c string, n string", [(None, "Namibia"), ("NA", "Namibia"), (None, "Chad"), ("TD", "Chad")],
        text.country_code_repair("c", "n"),
    )
    assert got == [("NA",), ("NA",), (None,), ("TD",)]


def test_sale_currency(spark):
    got = values(
        spark, "s string, c string", [("68", "VND"), ("1", "LTL"), ("1", "VND"), ("1", None), (None, None)],
        money.sale_currency("s", "c"),
    )
    assert [g[0] for g in got] == ["USD", "EUR", "VND", None, None]


def test_amounts_are_exact_to_nine_decimals(spark):
    [(amount, dollars, none, zero)] = values(
        spark, "q bigint, p decimal(18,6), r decimal(38,9)", [(3, Decimal("0.333333"), Decimal("3"))],
        money.times("q", "p"), money.in_dollars("p", "r"), money.in_dollars("p", F.lit(None)),
        money.in_dollars("p", F.lit(0)),
    )
    assert (amount, dollars, none, zero) == (Decimal("0.999999"), Decimal("0.111111000"), None, None)
