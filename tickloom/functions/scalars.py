"""Scalar column expressions: rounding, text parsing, dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "America/Chicago"
CLOSE_HOUR = 15
MISSING_NAME = "N/A"
BLANKS = " \t\n\r\x0b\x0c\u00a0"
# Fixed value: where quote pages are found.
QUOTE_BASE_URL = "https://finance.yahoo.com/quote/"

# A decimal number as Python's float() reads it; the words nan and inf are left
# out because a missing price is null here.
NUMBER_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_to(value: Column | str, digits: int) -> Column:
    """Round by scaling, then half to even on the scaled double."""
    scale = float(10**digits)
    return F.rint(_col(value) * scale) / scale


def round2(value: Column | str) -> Column:
    return round_to(value, 2)


def null_if_nan(value: Column | str) -> Column:
    value = _col(value)
    return F.when(~F.isnan(value), value)


def strip(text: Column | str) -> Column:
    """Cut blanks of any kind off both ends."""
    return F.trim(_col(text), F.lit(BLANKS))


def parse_price(text: Column | str) -> Column:
    """Text to double; thousands separators go, unreadable text becomes null."""
    bare = strip(F.replace(_col(text), F.lit(","), F.lit("")))
    number = F.regexp_extract(bare, NUMBER_TEXT, 0).try_cast("double")
    # Without naming the number twice, which would read the text twice.
    return F.nullif(F.nullif(number, F.lit(float("inf"))), F.lit(float("-inf")))


def parse_name(heading: Column | str) -> Column:
    """The heading up to its first parenthesis; ``N/A`` when there is none."""
    return F.coalesce(
        strip(F.substring_index(_col(heading), "(", 1)), F.lit(MISSING_NAME)
    )


def to_day(text: Column | str, format: str | None = None) -> Column:
    """Text to date, ISO or of a given format; unreadable text fails the query."""
    text = _col(text)
    day = F.try_to_date(text, format)
    problem = F.concat(F.lit("not a date: "), text)
    return F.when(text.isNull() | day.isNotNull(), day).otherwise(
        F.raise_error(problem).cast("date")
    )


def quote_url(symbol: Column | str) -> Column:
    return F.concat(F.lit(QUOTE_BASE_URL), _col(symbol), F.lit("/"))


def local_time(utc: Column | str) -> Column:
    """A UTC ``timestamp_ntz`` as wall-clock time at the exchange.

    Works on ``timestamp_ntz`` so that the session time zone plays no part.
    """
    return F.convert_timezone(
        F.lit("UTC"), F.lit(ZONE), _col(utc).cast("timestamp_ntz")
    )


def is_after_close(utc: Column | str) -> Column:
    return F.hour(local_time(utc)) >= CLOSE_HOUR


def is_business_day(day: Column | str) -> Column:
    """Monday to Friday; holidays count as business days."""
    return F.weekday(_col(day)) < 5


def week_start(day: Column | str) -> Column:
    day = _col(day)
    return F.date_sub(day, F.weekday(day))


def week_end(day: Column | str) -> Column:
    return F.date_add(week_start(day), 6)
