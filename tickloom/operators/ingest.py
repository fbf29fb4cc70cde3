"""From wide price files and quote pages to rows of ``stock_prices``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.html import first_match, markup_text, text_alone, visible, whole_element
from tickloom.functions.scalars import (
    is_after_close,
    local_time,
    null_if_nan,
    parse_name,
    parse_price,
    round2,
)
from tickloom.operators.returns import open_from_previous_close
from tickloom.schemas import STOCK_PRICES

ARRIVAL = "_arrival"
LOOKUP_SALTS = 16

# Company names of the seven symbols in the usual history file.
COMPANY_NAMES = {
    "AAPL": "Apple Inc.",
    "AMZN": "Amazon.com, Inc.",
    "GOOGL": "Alphabet Inc.",
    "META": "Meta Platforms, Inc.",
    "MSFT": "Microsoft Corporation",
    "NVDA": "NVIDIA Corporation",
    "TSLA": "Tesla, Inc.",
}


def unpivot_prices(wide: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """One row per date and symbol column; missing prices stay as null rows."""
    symbols = list(symbols or [c for c in wide.columns if c not in ("date", ARRIVAL)])
    clean = wide.select("date", *[null_if_nan(F.col(f"`{s}`")).alias(s) for s in symbols])
    return clean.unpivot(
        ["date"], [F.col(f"`{s}`") for s in symbols], "symbol", "current_price"
    ).select("symbol", "date", "current_price")


def with_names(prices: DataFrame, names: Mapping[str, str] | DataFrame) -> DataFrame:
    """Adds ``name``; an unknown symbol has none.

    A mapping becomes a literal. A table is joined on symbol plus a salt taken from
    the date, so the rows of one symbol spread over ``LOOKUP_SALTS`` tasks; when the
    table is small enough adaptive execution broadcasts it instead.
    """
    if isinstance(names, DataFrame):
        salted = names.select(
            "symbol",
            "name",
            F.explode(F.sequence(F.lit(0), F.lit(LOOKUP_SALTS - 1))).alias("_salt"),
        )
        salt = F.pmod(F.xxhash64("date"), F.lit(LOOKUP_SALTS)).cast("int")
        return (
            prices.withColumn("_salt", salt)
            .join(salted, ["symbol", "_salt"], "left")
            .drop("_salt")
        )
    if not names:
        return prices.withColumn("name", F.lit(None).cast("string"))
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    return prices.withColumn("name", F.create_map(*pairs)[F.col("symbol")])


def clean_prices(long: DataFrame, names: Mapping[str, str] | DataFrame) -> DataFrame:
    """Round, name, take the open from the row before, then drop rows without a price.

    The open is taken first, so the row after a gap has no open.
    """
    rounded = long.withColumn("current_price", round2("current_price"))
    opened = with_names(open_from_previous_close(rounded), names)
    return opened.na.drop(subset=["current_price"]).select(*STOCK_PRICES.names)


def sort_by_date(prices: DataFrame) -> DataFrame:
    """By date; ``symbol`` makes the order total."""
    return prices.orderBy("date", "symbol")


def history_prices(
    wide: DataFrame, names: Mapping[str, str] | DataFrame = COMPANY_NAMES
) -> DataFrame:
    return clean_prices(unpivot_prices(wide), names)


def extract_page_text(
    pages: DataFrame, elements: Mapping[str, Mapping], pieces: Sequence[str] = ()
) -> DataFrame:
    """Keeps the page's columns but its source and adds one text per element.

    Elements named in ``pieces`` have each piece of their text trimmed.
    """
    kept = [c for c in pages.columns if c != "html"]
    page = F.col("html")
    found = pages.withColumn("html", visible(page)).select(
        *kept, "html", *[first_match(page, **e).alias(name) for name, e in elements.items()]
    )
    found = found.select(*kept, "html", *[text_alone(F.col(n)).alias(n) for n in elements])
    found = found.select(
        *kept, *[whole_element(page, F.col(name), **e).alias(name) for name, e in elements.items()]
    )
    return found.select(*kept, *[markup_text(F.col(n), n in pieces).alias(n) for n in elements])


# Where a quote page holds its figures.
QUOTE_ELEMENTS = {
    "_price": {"tag": "span", "attribute": "data-testid", "value": "qsp-price"},
    "_open": {"tag": "fin-streamer", "attribute": "data-field", "value": "regularMarketOpen"},
    "_heading": {"tag": "h1", "attribute": "class", "value": "yf-xxbei9", "token": True},
}


def extract_quotes(pages: DataFrame) -> DataFrame:
    """One price row per page that was fetched well after the close.

    ``pages`` has symbol, status, fetched_at (UTC) and html. A failed fetch drops
    that page only.
    """
    usable = F.col("status").between(200, 399) & is_after_close("fetched_at")
    texts = extract_page_text(pages.where(usable), QUOTE_ELEMENTS, ("_price", "_open"))
    return texts.select(
        "symbol",
        parse_name("_heading").alias("name"),
        F.to_date(local_time("fetched_at")).alias("date"),
        parse_price("_price").alias("current_price"),
        parse_price("_open").alias("open_price"),
        "fetched_at",
    )


def union_history_current(history: DataFrame, current: DataFrame) -> DataFrame:
    """History, then today's rows; columns by name, absent ones null.

    ``_arrival`` remembers that history comes first, and within today's rows which
    page was fetched first.
    """
    fetched: Column = (
        F.col("fetched_at") if "fetched_at" in current.columns else F.lit(None)
    ).cast("timestamp_ntz")
    first = history.withColumn(
        ARRIVAL, F.struct(F.lit(0).alias("source"), F.lit(None).cast("timestamp_ntz").alias("at"))
    )
    then = current.withColumn(
        ARRIVAL, F.struct(F.lit(1).alias("source"), fetched.alias("at"))
    ).drop("fetched_at")
    return first.unionByName(then, allowMissingColumns=True)


def first_per_key(
    rows: DataFrame, key: Sequence[str], arrival: str | None = ARRIVAL
) -> DataFrame:
    """The row that arrived first for each key.

    An aggregate rather than a ranked window: copies of a key shrink to one before
    the shuffle, however many there are. Equal arrivals fall back to the smallest
    row, which keeps a re-run the same.
    """
    others = [c for c in rows.columns if c not in key and c != arrival]
    whole = F.struct(*others)
    order = F.struct(F.col(arrival), whole) if arrival in rows.columns else whole
    first = rows.groupBy(*key).agg(F.min_by(whole, order).alias("_row"))
    return first.select(*key, "_row.*").select(
        *[c for c in rows.columns if c != arrival]
    )


def absent_rows(
    batch: DataFrame,
    existing: DataFrame | None,
    key: Sequence[str],
    arrival: str | None = ARRIVAL,
    unique: bool = False,
) -> DataFrame:
    """Rows of ``batch`` a keyed insert would add: new keys, first arrival each."""
    fresh = batch if unique else first_per_key(batch, key, arrival)
    if existing is None:
        return fresh
    return fresh.join(existing.select(*key), list(key), "left_anti").select(
        *fresh.columns
    )
