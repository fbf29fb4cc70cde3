import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.functions import scalars as S
from tickloom.functions.html import element_markup, markup_text


def values(spark, type_name, inputs, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {type_name}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("v")).alias("out")).collect()]


def test_rounding_scales_then_rounds_half_even(spark):
    given = [1.005, 1.015, 2.675, 0.125, 0.375, 1.115, -0.125, 2.345]
    assert values(spark, "double", given, S.round2) == [
        1.0, 1.01, 2.68, 0.12, 0.38, 1.12, -0.12, 2.35,
    ]


def test_number_text(spark):
    given = ["1,234.5", " 7 ", "1e3", "abc", "", "1.0d", "2f", None, "nan", "inf", "\n 8.5\t", "-.5"]
    assert values(spark, "string", given, S.parse_price) == [
        1234.5, 7.0, 1000.0, None, None, None, None, None, None, None, 8.5, -0.5,
    ]


def test_name_text(spark):
    given = ["Acme, Inc. (ACM)", None, "Plain", "(X)"]
    assert values(spark, "string", given, S.parse_name) == ["Acme, Inc.", "N/A", "Plain", ""]


def test_day_text_is_strict(spark):
    given = ["2024-01-05", None, "2024-01-06 00:00:00"]
    assert values(spark, "string", given, S.to_day) == [
        datetime.date(2024, 1, 5), None, datetime.date(2024, 1, 6),
    ]
    with pytest.raises(Exception, match="not a date"):
        values(spark, "string", ["yesterday"], S.to_day)


def test_after_close_uses_exchange_time_in_any_session_zone(spark):
    given = [datetime.datetime(2024, 1, 5, 20, 59, 59), datetime.datetime(2024, 1, 5, 21)]
    for zone in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert values(spark, "timestamp_ntz", given, S.is_after_close) == [False, True]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_business_days_and_weeks(spark):
    given = [datetime.date(2024, 1, 5), datetime.date(2024, 1, 6), datetime.date(2024, 1, 8)]
    assert values(spark, "date", given, S.is_business_day) == [True, False, True]
    assert values(spark, "date", given, S.week_start)[1] == datetime.date(2024, 1, 1)
    assert values(spark, "date", given, S.week_end)[1] == datetime.date(2024, 1, 7)


def test_nan_becomes_null(spark):
    assert values(spark, "double", [float("nan"), 1.0, None], S.null_if_nan) == [None, 1.0, None]


def test_address(spark):
    assert values(spark, "string", ["A"], S.quote_url) == ["https://finance.yahoo.com/quote/A/"]


@pytest.mark.parametrize(
    "html, expected",
    [
        ('<span data-testid="qsp-price">1,2</span>', "1,2"),
        ("<SPAN class='x' data-testid='qsp-price' id=a>\n 3 \n</SPAN >", "3"),
        ('<span data-testid="other">1</span><span data-testid="qsp-price">2</span>', "2"),
        ('<span data-testid="qsp-price"><b>4</b>.5</span>', "4.5"),
        ('<span data-testid="qsp-price"></span>', ""),
        ('<span data-testid="qsp-price">a &amp;lt; b</span>', "a &lt; b"),
        ("<spandex data-testid=\"qsp-price\">no</spandex>", None),
        ("", None),
        (None, None),
    ],
)
def test_element_by_attribute(spark, html, expected):
    pick = lambda c: markup_text(element_markup(c, "span", "data-testid", "qsp-price"))
    assert values(spark, "string", [html], pick) == [expected]


@pytest.mark.parametrize(
    "html, expected",
    [
        ('<h1 class="yf-xxbei9">A (B)</h1>', "A (B)"),
        ('<h1 class="big yf-xxbei9 bold">A</h1>', "A"),
        ('<h1 class="yf-xxbei9x">A</h1>', None),
    ],
)
def test_element_by_class_word(spark, html, expected):
    pick = lambda c: markup_text(element_markup(c, "h1", "class", "yf-xxbei9", token=True))
    assert values(spark, "string", [html], pick) == [expected]
