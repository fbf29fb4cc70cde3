"""Schemas and keys of the stored tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _doubles(*names: str) -> list[StructField]:
    return [StructField(name, DoubleType()) for name in names]


FEATURE_COLUMNS = (
    "percent_change",
    "cumulative_return",
    "ma_10_day",
    "ma_30_day",
    "volatility_30_day",
    "ema_10",
    "ema_30",
)

MODEL_FEATURES = ("open_price",) + FEATURE_COLUMNS

STOCK_PRICES = StructType(
    [
        StructField("symbol", StringType()),
        StructField("name", StringType()),
        StructField("date", DateType()),
        *_doubles("current_price", "open_price"),
    ]
)

FULL_STOCK_CALCULATIONS = StructType(
    STOCK_PRICES.fields + _doubles(*FEATURE_COLUMNS)
)

PREDICTED_STOCK_PRICES = StructType(
    [
        StructField("symbol", StringType()),
        StructField("predicted_price", DoubleType()),
        StructField("date", DateType()),
        *_doubles("current_price", "open_price"),
        *_doubles(*FEATURE_COLUMNS),
        StructField("previous_day_predicted_price", DoubleType()),
    ]
)

MODEL_EVAL = StructType(
    [
        StructField("symbol", StringType()),
        *_doubles("r_squared", "mae", "rmse", "mse", "directional_accuracy"),
    ]
)

# What features of later rows need of a symbol's past.
FEATURE_STATE = StructType(
    [
        StructField("symbol", StringType()),
        StructField("last_date", DateType()),
        StructField(
            "tail",
            ArrayType(StructType([StructField("date", DateType()), *_doubles("current_price", "known")])),
        ),
        *_doubles("first_price", "last_price"),
        StructField("trailing", LongType()),
        *_doubles("ema_10", "ema_30"),
    ]
)

# Sums that metrics of a symbol follow from, and its last row.
METRIC_STATE = StructType(
    [
        StructField("symbol", StringType()),
        StructField("last_date", DateType()),
        *_doubles("last_actual", "last_predicted"),
        StructField("pairs", LongType()),
        *_doubles("mean_actual", "actual_spread", "absolute_error", "squared_error"),
        StructField("steps", LongType()),
        StructField("matches", LongType()),
    ]
)

QUOTE_PAGES = StructType(
    [
        StructField("symbol", StringType()),
        StructField("status", IntegerType()),
        StructField("fetched_at", TimestampNTZType()),
        StructField("html", StringType()),
    ]
)


@dataclass(frozen=True)
class Table:
    """A stored table: its columns and the key no two rows share."""

    name: str
    schema: StructType
    key: tuple[str, ...]

    @property
    def dated(self) -> bool:
        return "date" in self.key


TABLES = {
    table.name: table
    for table in (
        Table("stock_prices", STOCK_PRICES, ("symbol", "date")),
        Table("full_stock_calculations", FULL_STOCK_CALCULATIONS, ("symbol", "date")),
        Table("predicted_stock_prices", PREDICTED_STOCK_PRICES, ("symbol", "date")),
        Table("model_eval", MODEL_EVAL, ("symbol",)),
    )
}

# One row per symbol, replaced by every narrow run.
STATES = {
    table.name: table
    for table in (
        Table("feature_state", FEATURE_STATE, ("symbol",)),
        Table("forecast_state", FULL_STOCK_CALCULATIONS, ("symbol",)),
        Table("metric_state", METRIC_STATE, ("symbol",)),
    )
}
