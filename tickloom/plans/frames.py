"""Price-series inputs derived from the order tables.

The given tables hold no prices, so a supplier stands for a symbol and the highest
extended price it shipped on a day for that day's price. ``max`` is exact, so any
engine derives the same series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.features import add_features
from tickloom.operators.ingest import clean_prices
from tickloom.operators.returns import rolling_mean

LINES = tuple(range(1, 8))
UNNAMED_NATION = 7


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def symbol_of(key: str) -> Column:
    return F.concat(F.lit("S"), F.col(key).cast("string"))


def daily(spark: SparkSession, folder: str) -> DataFrame:
    """supplier key, date, highest and lowest price of the day."""
    return (
        load(spark, folder, "lineitem")
        .groupBy("l_suppkey", F.to_date("l_shipdate").alias("date"))
        .agg(
            F.max("l_extendedprice").alias("current_price"),
            F.min("l_extendedprice").alias("low_price"),
        )
    )


def series(spark: SparkSession, folder: str) -> DataFrame:
    return daily(spark, folder).select(
        symbol_of("l_suppkey").alias("symbol"), "date", "current_price"
    )


def day_number() -> Column:
    return F.col("l_suppkey") + F.dayofyear("date")


def price_with_gaps() -> Column:
    return F.when(day_number() % 97 != 0, F.col("current_price"))


def gappy(spark: SparkSession, folder: str) -> DataFrame:
    """The series with some prices missing."""
    return daily(spark, folder).select(
        symbol_of("l_suppkey").alias("symbol"),
        "date",
        price_with_gaps().alias("current_price"),
    )


def early_series(spark: SparkSession, folder: str) -> DataFrame:
    """The series as the first three lines of each order alone would give it."""
    return (
        load(spark, folder, "lineitem")
        .where(F.col("l_linenumber") <= 3)
        .groupBy("l_suppkey", F.to_date("l_shipdate").alias("date"))
        .agg(F.max("l_extendedprice").alias("current_price"))
        .select(symbol_of("l_suppkey").alias("symbol"), "date", "current_price")
    )


def wide(spark: SparkSession, folder: str) -> DataFrame:
    """One column per line number: the highest price of the day on that line."""
    return (
        load(spark, folder, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("date"))
        .pivot("l_linenumber", list(LINES))
        .agg(F.max("l_extendedprice"))
        .select("date", *[F.col(str(n)).alias(f"L{n}") for n in LINES])
    )


def names(spark: SparkSession, folder: str) -> DataFrame:
    """Symbol names; suppliers of one nation have none."""
    suppliers = load(spark, folder, "supplier").where(
        F.col("s_nationkey") != UNNAMED_NATION
    )
    nations = load(spark, folder, "nation")
    return suppliers.join(
        nations, suppliers["s_nationkey"] == nations["n_nationkey"]
    ).select(
        symbol_of("s_suppkey").alias("symbol"),
        F.concat_ws(" ", "s_name", "n_name").alias("name"),
    )


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return clean_prices(gappy(spark, folder), names(spark, folder))


def features(spark: SparkSession, folder: str) -> DataFrame:
    return add_features(cleaned(spark, folder))


def forecasts(spark: SparkSession, folder: str) -> DataFrame:
    """A forecast any engine can repeat: the ten-row mean."""
    return (
        rolling_mean(series(spark, folder), 10, "predicted_price")
        .where(F.col("predicted_price").isNotNull())
        .select("symbol", "date", "predicted_price")
    )


def compared(spark: SparkSession, folder: str) -> DataFrame:
    """Actual prices with gaps beside the ten-row mean of those without."""
    means = rolling_mean(series(spark, folder), 10, "previous_day_predicted_price")
    price = F.when(
        (F.substring("symbol", 2, 20).cast("bigint") + F.dayofyear("date")) % 97 != 0,
        F.col("current_price"),
    )
    return means.withColumn("current_price", price)


def spiked(spark: SparkSession, folder: str) -> DataFrame:
    """``compared`` with a price three times as high on one day in a hundred."""
    n = F.substring("symbol", 2, 20).cast("bigint") + F.dayofyear("date")
    price = F.when(n % 101 == 0, 3 * F.col("current_price")).otherwise(F.col("current_price"))
    return compared(spark, folder).withColumn("current_price", price)


def quote_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Page source written around each day's price.

    Some fetches failed, some came before the close, some pages lack an element.
    """
    days = daily(spark, folder).withColumn("price", price_with_gaps())
    suppliers = load(spark, folder, "supplier").select("s_suppkey", "s_name")
    rows = days.join(suppliers, days["l_suppkey"] == suppliers["s_suppkey"])
    symbol = symbol_of("l_suppkey")
    heading = F.when(
        F.col("l_suppkey") % 13 != 0,
        F.concat(
            F.lit('<h1 class="title yf-xxbei9">'), "s_name", F.lit(" ("), symbol, F.lit(")</h1>")
        ),
    )
    price = F.when(
        F.col("price").isNotNull(),
        F.concat(
            F.lit('<span class="base" data-testid="qsp-price">\n '),
            F.format_number("price", 2),
            F.lit(" </span>"),
        ),
    )
    opening = F.concat(
        F.lit('<fin-streamer data-field="regularMarketOpen" data-trend="none"><b>'),
        F.format_number("low_price", 2),
        F.lit("</b></fin-streamer>"),
    )
    fetched_at = F.col("date").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), (17 + day_number() % 8).cast("int")
    )
    return rows.select(
        symbol.alias("symbol"),
        F.when(day_number() % 11 == 0, 503).otherwise(200).alias("status"),
        fetched_at.alias("fetched_at"),
        F.concat(
            F.lit("<html><head><title>Quote</title></head><body><span>menu</span>"),
            F.coalesce(heading, F.lit("")),
            opening,
            F.coalesce(price, F.lit("")),
            F.lit("</body></html>"),
        ).alias("html"),
    )


RULE_TREES = 2
#: A forest whose symbol has no row.
GHOST = "NONE"


def rule_forests(spark: SparkSession, folder: str) -> DataFrame:
    """A forest of two small trees for three symbols in four, made from their prices.

    Its thresholds and leaves are exact in any engine. A fitted forest would differ
    with the engine's random numbers; how one is applied does not.
    """
    prices = gappy(spark, folder).groupBy("symbol").agg(
        F.min("current_price").alias("lo"), F.max("current_price").alias("hi")
    )
    prices = prices.where(F.substring("symbol", 2, 20).cast("bigint") % 4 != 0)
    ghost = spark.range(1).select(F.lit(GHOST).alias("symbol"), F.lit(1.0).alias("lo"), F.lit(2.0).alias("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    mid = (lo + hi) / 2

    def node(tree, number, prediction, feature=-1, threshold=None, left=-1, right=-1):
        return F.struct(
            F.lit(tree).alias("tree"), F.lit(number).alias("node"), F.lit(feature).alias("feature"),
            (F.lit(None) if threshold is None else threshold).cast("double").alias("threshold"),
            F.lit(left).alias("left"), F.lit(right).alias("right"), prediction.alias("prediction"),
        )

    nodes = [
        node(0, 0, mid, 3, mid, 1, 2), node(0, 1, lo), node(0, 2, mid, 1, F.lit(0.0), 3, 4),
        node(0, 3, mid), node(0, 4, hi),
        node(1, 0, mid, 7, (lo + mid) / 2, 1, 2), node(1, 1, lo, 2, F.lit(0.0), 3, 4),
        node(1, 2, hi), node(1, 3, lo), node(1, 4, mid),
    ]
    return prices.unionByName(ghost).select("symbol", F.inline(F.array(*nodes)))
