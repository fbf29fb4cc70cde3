"""Shifts, returns and rolling figures of a daily price series.

Inputs hold one row per (symbol, date). Order is always by date within symbol.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import round2
from tickloom.operators.chunks import (
    CHUNK,
    HALO,
    across_chunks,
    attach_per_symbol,
    chunk_of,
    drop_halo,
    with_halo,
    within_chunk,
)

PRICE = "current_price"


def previous_value(rows: DataFrame, value: str, into: str) -> DataFrame:
    """Value of the row before, per symbol."""
    shifted = with_halo(rows, [value], back=1)
    return drop_halo(shifted.withColumn(into, F.lag(value).over(within_chunk())))


def next_value(rows: DataFrame, value: str, into: str) -> DataFrame:
    """Value of the row after, per symbol."""
    shifted = with_halo(rows, [value], ahead=True)
    return drop_halo(shifted.withColumn(into, F.lead(value).over(within_chunk())))


def open_from_previous_close(prices: DataFrame) -> DataFrame:
    """``open_price`` is the rounded price of the row before, even if that is null."""
    shifted = previous_value(prices, PRICE, "open_price")
    return shifted.withColumn("open_price", round2("open_price"))


def change_in_percent(now: Column, before: Column) -> Column:
    return round2((F.try_divide(now, before) - 1) * 100)


def full_frame(figure: Column, value: Column, frame, size: int) -> Column:
    """``figure`` over the frame once it holds ``size`` non-null values, else null."""
    return F.when(F.count(value).over(frame) >= size, figure.over(frame))


def last_rows(size: int):
    return within_chunk().rowsBetween(-(size - 1), 0)


def percent_change(prices: DataFrame, fill: str | None = "ffill") -> DataFrame:
    """Change against the row before in percent, rounded to 2.

    With ``fill="ffill"`` a missing price counts as the last known one; with
    ``None`` the change next to a gap is missing.
    """
    if fill is None:
        rows = previous_value(prices, PRICE, "_before")
        change = change_in_percent(F.col(PRICE), F.col("_before"))
        return rows.withColumn("percent_change", change).drop("_before")
    if fill != "ffill":
        raise ValueError("fill is 'ffill' or None")
    rows = with_known_price(prices)
    change = change_in_percent(F.col("_known"), F.col("_known_before"))
    return rows.withColumn("percent_change", change).drop("_known", "_known_before")


def with_known_price(prices: DataFrame) -> DataFrame:
    """Adds the last known price at each row and at the row before."""
    rows = prices.withColumn(CHUNK, chunk_of())
    # The last known price before a chunk stands in as a row just before it.
    latest = rows.groupBy("symbol", CHUNK).agg(
        F.min("date").alias("_first_day"),
        F.max_by(PRICE, F.when(F.col(PRICE).isNotNull(), F.col("date"))).alias("_last"),
    )
    earlier = across_chunks().rowsBetween(Window.unboundedPreceding, -1)
    seed = latest.select(
        "symbol",
        CHUNK,
        F.date_sub("_first_day", 1).alias("date"),
        F.last("_last", ignorenulls=True).over(earlier).alias(PRICE),
    ).where(F.col(PRICE).isNotNull())
    seeded = rows.withColumn(HALO, F.lit(False)).unionByName(
        seed.withColumn(HALO, F.lit(True)), allowMissingColumns=True
    )
    so_far = within_chunk().rowsBetween(Window.unboundedPreceding, 0)
    before = within_chunk().rowsBetween(Window.unboundedPreceding, -1)
    return drop_halo(
        seeded.withColumn("_known", F.last(PRICE, ignorenulls=True).over(so_far))
        .withColumn("_known_before", F.last(PRICE, ignorenulls=True).over(before))
    )


def cumulative_return(prices: DataFrame) -> DataFrame:
    """Return since the first row of the symbol, in percent."""
    base = prices.groupBy("symbol").agg(F.min_by(PRICE, "date").alias("_base"))
    rows = attach_per_symbol(prices, base)
    return rows.withColumn(
        "cumulative_return", return_since(F.col(PRICE), F.col("_base"))
    ).drop("_base")


def return_since(now: Column, base: Column) -> Column:
    return (F.try_divide(now, base) - 1) * 100


def rolling_mean(prices: DataFrame, size: int, into: str, value: str = PRICE) -> DataFrame:
    """Mean of the last ``size`` rows; null until all of them hold a value."""
    rows = with_halo(prices, [value], back=size - 1)
    mean = full_frame(F.avg(value), F.col(value), last_rows(size), size)
    return drop_halo(rows.withColumn(into, mean))


def rolling_deviation(rows: DataFrame, size: int, into: str, value: str) -> DataFrame:
    """Sample standard deviation of the last ``size`` rows, null as in the mean."""
    rows = with_halo(rows, [value], back=size - 1)
    spread = full_frame(F.stddev_samp(value), F.col(value), last_rows(size), size)
    return drop_halo(rows.withColumn(into, spread))


def volatility(prices: DataFrame, size: int = 30, into: str = "volatility_30_day") -> DataFrame:
    """Deviation of the rounded percent change over the last ``size`` rows."""
    rows = prices if "percent_change" in prices.columns else percent_change(prices)
    return rolling_deviation(rows, size, into, "percent_change")


def skip_first(rows: DataFrame, count: int) -> DataFrame:
    """All but the first ``count`` rows of each symbol.

    Halo rows are counted: a chunk has as many as come before it, up to ``count``.
    """
    numbered = with_halo(rows, [], back=count).withColumn(
        "_nth", F.row_number().over(within_chunk())
    )
    return drop_halo(numbered.where(F.col("_nth") > count)).drop("_nth")


def skip_head(rows: DataFrame, count: int) -> DataFrame:
    """All but the first ``count`` rows by date and symbol over the whole frame.

    A sorted ``offset`` would move every row through one task. Only the first
    ``count`` keys are found by a top-n, then left out by an anti-join.
    """
    head = rows.select("date", "symbol").orderBy("date", "symbol").limit(count)
    return rows.join(head, ["date", "symbol"], "left_anti").select(*rows.columns)
