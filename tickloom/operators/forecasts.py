"""Training rows, the hold-out split and forecast alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.chunks import drop_halo, with_halo, within_chunk
from tickloom.operators.returns import next_value, previous_value
from tickloom.schemas import MODEL_FEATURES, PREDICTED_STOCK_PRICES

TEST_SHARE = 0.2
SEED = 42
ALIGNMENTS = ("as_stored", "forecast")


def training_frame(features: DataFrame) -> DataFrame:
    """Model inputs with the next row's price as target.

    A row with any missing column is left out, also one that is no model input.
    """
    rows = next_value(features, "current_price", "target").na.drop("any")
    return rows.select("symbol", "date", *MODEL_FEATURES, "target")


def with_split(
    rows: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """Adds ``is_test``: exactly ``ceil(test_share * n)`` rows of each symbol.

    Rows rank by a digest of key and seed, so the split does not depend on how the
    data is partitioned. Ranks are taken inside sixteen slices of a symbol, by the
    first digit of the digest, and offset by the sizes of the slices before.
    """
    digest = F.md5(F.concat_ws("|", "symbol", "date", F.lit(str(seed))))
    rows = rows.withColumn("_digest", digest).withColumn(
        "_slice", F.substring("_digest", 1, 1)
    )
    by_slice = Window.partitionBy("symbol").orderBy("_slice")
    whole = Window.partitionBy("symbol")
    sizes = (
        rows.groupBy("symbol", "_slice")
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumns(
            {
                "_offset": F.sum("_size").over(by_slice) - F.col("_size"),
                "_total": F.sum("_size").over(whole),
            }
        )
        .drop("_size")
    )
    in_slice = Window.partitionBy("symbol", "_slice").orderBy("_digest", "date")
    rank = F.col("_offset") + F.row_number().over(in_slice)
    cut = F.ceil(F.lit(test_share) * F.col("_total"))
    return (
        rows.join(sizes, ["symbol", "_slice"])
        .withColumn("is_test", rank <= cut)
        .drop("_digest", "_slice", "_offset", "_total")
    )


def lag_forecasts(forecasts: DataFrame) -> DataFrame:
    """Adds the forecast made on the row before."""
    return previous_value(forecasts, "predicted_price", "previous_day_predicted_price")


def join_forecasts(features: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Features with forecasts; a row without one keeps its features."""
    return features.join(forecasts, ["symbol", "date"], "left")


def align_forecasts(scored: DataFrame, alignment: str = "as_stored") -> DataFrame:
    """Rows of ``predicted_stock_prices`` from features with ``predicted_price``.

    The first row of each symbol goes, as nothing was forecast for it. Under
    ``forecast`` the names say what they hold: ``predicted_price`` was made on the
    row itself and ``previous_day_predicted_price`` on the row before. Under
    ``as_stored`` the two are exchanged, which is how the stored table has them.
    """
    if alignment not in ALIGNMENTS:
        raise ValueError(f"alignment is one of {ALIGNMENTS}")
    made = F.col("predicted_price")
    made_before = F.lag("predicted_price").over(within_chunk())
    rows = with_halo(scored, ["predicted_price"], back=1).withColumns(
        {
            "_has_before": F.lag(F.lit(True)).over(within_chunk()),
            "_made": made,
            "_made_before": made_before,
        }
    )
    rows = drop_halo(rows).where(F.col("_has_before"))
    if alignment == "as_stored":
        names = {"predicted_price": "_made_before", "previous_day_predicted_price": "_made"}
    else:
        names = {"predicted_price": "_made", "previous_day_predicted_price": "_made_before"}
    rows = rows.withColumns({name: F.col(source) for name, source in names.items()})
    return rows.select(*PREDICTED_STOCK_PRICES.names)
