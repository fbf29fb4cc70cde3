import datetime
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import column
from tickloom.operators import chunks, ema, returns
from tickloom.operators import forecasts as fc
from tickloom.operators.features import add_features, exponential_averages

GAPPY = [1.0, 2.0, None, 4.0, 5.0, 3.0]


def close(got, wanted):
    assert len(got) == len(wanted)
    for g, w in zip(got, wanted):
        assert (g is None and w is None) or g == pytest.approx(w, rel=1e-7), (got, wanted)


def test_percent_change_over_a_gap(price_rows):
    rows = price_rows(GAPPY)
    close(column(returns.percent_change(rows), "percent_change"), [None, 100, 0, 100, 25, -40])
    unfilled = returns.percent_change(rows, fill=None)
    close(column(unfilled, "percent_change"), [None, 100, None, None, 25, -40])
    with pytest.raises(ValueError):
        returns.percent_change(rows, fill="bfill")


def test_average_over_a_gap(price_rows):
    rows = exponential_averages(price_rows(GAPPY), [3])
    close(column(rows, "ema_3"), [1, 1.5, 1.5, 3.1666667, 4.0833333, 3.5416667])


def test_average_with_leading_gap(price_rows):
    close(column(exponential_averages(price_rows([None, 1.0, 2.0]), [3]), "ema_3"), [None, 1, 1.5])


def test_average_rejects_a_span_below_two():
    with pytest.raises(ValueError):
        ema.chunk_days([1])
    assert ema.chunk_days([2]) < ema.chunk_days([10]) == chunks.CHUNK_DAYS


def test_rolling_over_a_gap(price_rows):
    rows = price_rows(GAPPY)
    close(column(returns.rolling_mean(rows, 2, "m"), "m"), [None, 1.5, None, None, 4.5, 4.0])
    deviation = returns.rolling_deviation(rows, 2, "d", "current_price")
    close(column(deviation, "d"), [None, 0.7071068, None, None, 0.7071068, 1.4142136])


def test_lag_and_lead_over_a_gap(price_rows):
    rows = price_rows(GAPPY)
    close(column(returns.previous_value(rows, "current_price", "p"), "p"), [None, 1, 2, None, 4, 5])
    close(column(returns.next_value(rows, "current_price", "n"), "n"), [2, None, 4, 5, 3, None])
    close(column(returns.open_from_previous_close(rows), "open_price"), [None, 1, 2, None, 4, 5])


def test_trims(price_rows):
    rows = price_rows([1.0, 2, 3, 4]).unionByName(price_rows([5.0, 6, 7], symbol="B"))
    assert column(returns.skip_first(rows, 2), "current_price") == [3, 4, 7]
    assert column(returns.skip_head(rows, 3), "current_price") == [3, 4, 6, 7]
    assert returns.skip_head(rows, 0).count() == 7


def reference_features(prices: pd.DataFrame) -> pd.DataFrame:
    """The same figures with pandas, one symbol at a time."""
    out = []
    for _, rows in prices.sort_values(["symbol", "date"]).groupby("symbol"):
        rows = rows.copy()
        price = rows["current_price"]
        filled = price.ffill()
        rows["percent_change"] = ((filled / filled.shift(1) - 1) * 100).round(2)
        rows["cumulative_return"] = (price / price.iloc[0] - 1) * 100
        rows["ma_10_day"] = price.rolling(10).mean()
        rows["ma_30_day"] = price.rolling(30).mean()
        rows["volatility_30_day"] = rows["percent_change"].rolling(30).std()
        rows["ema_10"] = price.ewm(span=10, adjust=False).mean()
        rows["ema_30"] = price.ewm(span=30, adjust=False).mean()
        out.append(rows.iloc[30:])
    return pd.concat(out, ignore_index=True)


def random_prices(seed: int) -> pd.DataFrame:
    """A hot symbol, a sparse one, a dense one and short ones, with gaps."""
    rng = random.Random(seed)
    rows = []
    shapes = {"HOT": (900, 1), "SPARSE": (80, 700), "DENSE": (300, 2), "ONE": (1, 1), "SHORT": (31, 40)}
    for symbol, (count, stride) in shapes.items():
        day = datetime.date(1965, 1, 1)
        for n in range(count):
            day += datetime.timedelta(days=rng.randint(1, stride))
            missing = rng.random() < 0.15 or (symbol == "DENSE" and n < 40)
            rows.append((symbol, day, None if missing else round(rng.uniform(5, 500), 2)))
    return pd.DataFrame(rows, columns=["symbol", "date", "current_price"])


def compare(spark_frame, wanted: pd.DataFrame):
    got = spark_frame.toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
    wanted = wanted.sort_values(["symbol", "date"]).reset_index(drop=True)
    assert list(got["symbol"]) == list(wanted["symbol"])
    assert list(got["date"]) == list(wanted["date"])
    for name in [c for c in wanted.columns if c not in ("symbol", "date")]:
        np.testing.assert_allclose(
            got[name].astype(float), wanted[name].astype(float), rtol=1e-9, atol=1e-9, err_msg=name
        )


@pytest.mark.parametrize("chunk_length", [1, 37, 1024])
def test_features_match_pandas_whatever_the_chunk(spark, monkeypatch, chunk_length):
    monkeypatch.setattr(ema, "CHUNK_DAYS", chunk_length)
    prices = random_prices(chunk_length)
    rows = spark.createDataFrame(
        [(s, d, None if p != p else p) for s, d, p in prices.itertuples(index=False)],
        "symbol string, date date, current_price double",
    ).repartition(7)
    compare(add_features(rows), reference_features(prices))


def test_features_since_a_day_are_the_same_rows(spark):
    prices = random_prices(11)
    rows = spark.createDataFrame(
        [(s, d, None if p != p else p) for s, d, p in prices.itertuples(index=False)],
        "symbol string, date date, current_price double",
    )
    since = datetime.date(1967, 3, 1)
    wanted = reference_features(prices)
    compare(add_features(rows, since=since), wanted[wanted["date"] >= since])


def test_single_operators_match_pandas_on_sparse_chunks(spark):
    prices = random_prices(3)
    rows = spark.createDataFrame(
        [(s, d, None if p != p else p) for s, d, p in prices.itertuples(index=False)],
        "symbol string, date date, current_price double",
    )
    wanted = prices.sort_values(["symbol", "date"]).reset_index(drop=True)
    group = wanted.groupby("symbol")["current_price"]
    key = ["symbol", "date"]
    compare(
        returns.rolling_mean(rows, 10, "m").select(*key, "m"),
        wanted[key].assign(m=group.transform(lambda x: x.rolling(10).mean())),
    )
    compare(
        returns.previous_value(rows, "current_price", "p").select(*key, "p"),
        wanted[key].assign(p=group.shift(1)),
    )
    filled = group.ffill()
    before = wanted.assign(f=filled).groupby("symbol")["f"].shift(1)
    compare(
        returns.percent_change(rows).select(*key, "percent_change"),
        wanted[key].assign(percent_change=((filled / before - 1) * 100).round(2)),
    )
    compare(
        returns.cumulative_return(rows).select(*key, "cumulative_return"),
        wanted[key].assign(
            cumulative_return=group.transform(lambda x: (x / x.iloc[0] - 1) * 100)
        ),
    )
    trimmed = wanted[wanted.groupby("symbol").cumcount() >= 30]
    compare(returns.skip_first(rows, 30).select(*key), trimmed[key])


def test_order_and_partitions_change_nothing(spark):
    prices = random_prices(5)
    rows = spark.createDataFrame(
        [(s, d, None if p != p else p) for s, d, p in prices.itertuples(index=False)],
        "symbol string, date date, current_price double",
    )
    first = add_features(rows.orderBy("current_price")).orderBy("symbol", "date").collect()
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        second = add_features(rows.repartition(5)).orderBy("symbol", "date").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert first == second


def test_split_is_exact_and_stable(spark):
    prices = random_prices(7)
    rows = spark.createDataFrame(
        [(s, d) for s, d, _ in prices.itertuples(index=False)], "symbol string, date date"
    )
    split = fc.with_split(rows)
    counts = {
        r["symbol"]: (r["n"], r["t"])
        for r in split.groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_test").cast("int")).alias("t"))
        .collect()
    }
    for symbol, group in prices.groupby("symbol"):
        assert counts[symbol] == (len(group), int(np.ceil(0.2 * len(group))))
    again = fc.with_split(rows.repartition(9))
    assert split.exceptAll(again).count() == 0
    assert fc.with_split(rows, seed=1).exceptAll(split).count() > 0


def window_lines(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan, [l for l in plan.split("\n") if " Window [" in l or "Window [" in l]


def test_rows_are_never_windowed_by_symbol_alone(spark, folder):
    from tickloom.plans import frames

    plan, windows = window_lines(add_features(frames.series(spark, folder)))
    by_rows = [w for w in windows if "date#" in w.split("windowspecdefinition(")[1]]
    assert by_rows and all("_chunk#" in w for w in by_rows)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    schemas = {l.split("ReadSchema: ")[1] for l in plan.split("\n") if "ReadSchema: " in l}
    assert all("l_orderkey" not in s and "l_quantity" not in s for s in schemas)
