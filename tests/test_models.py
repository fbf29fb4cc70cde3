import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import column, day
from tickloom.operators import dashboard, forests, metrics
from tickloom.operators import forecasts as fc
from tickloom.operators.features import features_table
from tickloom.operators.ingest import clean_prices
from tickloom.plans import jobs
from tickloom.schemas import TABLES
from tickloom.sources.tables import read_table

PAIRS = "symbol string, date date, y double, p double"


def pairs(spark, actual, predicted, symbol="A"):
    number = lambda v: None if v is None else float(v)
    rows = [
        (symbol, day(i), number(a), number(p))
        for i, (a, p) in enumerate(zip(actual, predicted))
    ]
    return spark.createDataFrame(rows, PAIRS)


def test_metrics(spark):
    row = metrics.model_metrics(pairs(spark, [1.0, 2, 3, 4], [2.0, 2.5, 5, 3]), "y", "p").first()
    error = np.array([1, 0.5, 2, 1])
    assert row["r_squared"] == pytest.approx(-0.25)
    assert row["mae"] == pytest.approx(error.mean())
    assert row["mse"] == pytest.approx((error**2).mean())
    assert row["rmse"] == pytest.approx(np.sqrt((error**2).mean()))
    assert row["directional_accuracy"] == pytest.approx(2 / 3)


def test_direction_with_zero_change_and_gap(spark):
    rows = pairs(spark, [1.0, 2, 2, None, 3], [1.0, 3, 3, 4, 5])
    assert metrics.directional_accuracy(rows, "y", "p").first()[1] == 0.5


def test_r_squared_of_constant_and_single_rows(spark):
    rows = (
        pairs(spark, [2.0, 2], [2.0, 2], "EXACT")
        .unionByName(pairs(spark, [2.0, 2], [2.0, 3], "OFF"))
        .unionByName(pairs(spark, [2.0], [2.0], "ONE"))
    )
    got = {r["symbol"]: r for r in metrics.model_metrics(rows, "y", "p").collect()}
    assert got["EXACT"]["r_squared"] == 1.0
    assert got["OFF"]["r_squared"] == 0.0
    assert got["ONE"]["r_squared"] is None and got["ONE"]["directional_accuracy"] is None


def random_walks(spark, symbols=("A", "B", "C"), length=160):
    rng, rows = random.Random(1), []
    for symbol in symbols:
        price = rng.uniform(50, 150)
        for n in range(length):
            price *= 1 + rng.uniform(-0.02, 0.021)
            rows.append((symbol, day(n), price))
    long = spark.createDataFrame(rows, "symbol string, date date, current_price double")
    return clean_prices(long, {s: f"Name {s}" for s in symbols})


@pytest.fixture(scope="module")
def features(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("f") / "features")
    features_table(random_walks(spark)).write.parquet(path)
    return spark.read.parquet(path)


def test_training_frame(spark, features):
    frame = fc.training_frame(features)
    assert frame.count() == 3 * (160 - 30 - 1)
    first = frame.where("symbol = 'A'").orderBy("date").first()
    then = features.where((F.col("symbol") == "A") & (F.col("date") > first["date"])).orderBy("date")
    assert first["target"] == then.first()["current_price"]
    nameless = features.withColumn("name", F.when(F.col("symbol") != "B", F.col("name")))
    assert "B" not in {r["symbol"] for r in fc.training_frame(nameless).select("symbol").distinct().collect()}


def test_pooled_forest_beats_the_mean_and_repeats(spark, features, tmp_path):
    split = fc.with_split(fc.training_frame(features)).cache()
    train, test = split.where("NOT is_test"), split.where("is_test")
    model = forests.fit_pooled(train, trees=10, depth=6)
    forests.save_model(model, str(tmp_path))
    scored = forests.score(forests.load_model(spark, str(tmp_path)), test)
    overall = scored.agg(metrics.r_squared("target", "predicted_price")).first()[0]
    assert overall > 0.5
    assert metrics.holdout_metrics(scored).count() == 3
    again = forests.score(forests.fit_pooled(train, trees=10, depth=6), test)
    assert column(scored, "predicted_price") == column(again, "predicted_price")
    with pytest.raises(FileNotFoundError):
        forests.load_model(spark, str(tmp_path), "A")


def test_forest_is_the_same_however_rows_are_dealt(spark, features):
    train = fc.training_frame(features)
    sums = []
    for parts in (2, 7):
        model = forests.fit_pooled(train.repartition(parts), trees=5, depth=4)
        sums.append(forests.score(model, features).agg(F.sum(F.rint(F.col("predicted_price") * 1e6))).first()[0])
    assert sums[0] == sums[1]


def test_forest_per_symbol(spark, features, tmp_path):
    split = fc.with_split(fc.training_frame(features))
    models = forests.fit_each(split.where("NOT is_test"), ["A", "B"], trees=5, depth=4)
    for symbol, model in models.items():
        forests.save_model(model, str(tmp_path), symbol)
    models = forests.load_models(spark, str(tmp_path), ["A", "B"])
    scored = forests.score_each(models, features)
    assert {r[0]: r[1] for r in scored.groupBy("symbol").count().collect()} == {"A": 130, "B": 130}
    with pytest.raises(ValueError):
        forests.score_each({}, features)


def test_missing_input_has_no_forecast(spark, features):
    model = forests.fit_pooled(fc.training_frame(features), trees=3, depth=3)
    holed = features.withColumn("ma_30_day", F.when(F.dayofmonth("date") != 3, F.col("ma_30_day")))
    scored = forests.score(model, holed)
    assert scored.count() == features.count()
    assert scored.where("predicted_price IS NULL").count() == holed.where("ma_30_day IS NULL").count()


def test_alignments(spark, features):
    scored = features.withColumn("predicted_price", F.col("current_price") * 10)
    honest = fc.align_forecasts(scored, "forecast")
    stored = fc.align_forecasts(scored, "as_stored")
    assert honest.count() == stored.count() == 3 * 129
    assert column(honest, "predicted_price") == column(stored, "previous_day_predicted_price")
    assert column(honest, "previous_day_predicted_price") == column(stored, "predicted_price")
    prices = column(scored.where("symbol = 'A'"), "current_price")
    assert column(honest.where("symbol = 'A'"), "previous_day_predicted_price") == [
        p * 10 for p in prices[:-1]
    ]
    with pytest.raises(ValueError):
        fc.align_forecasts(scored, "other")


def test_forecasts_join_keeps_rows_without_one(spark, features):
    forecasts = features.where("symbol = 'A'").select(
        "symbol", "date", F.col("ma_10_day").alias("predicted_price")
    )
    joined = fc.join_forecasts(features, forecasts)
    assert joined.count() == features.count()
    assert joined.where("predicted_price IS NULL").count() == 260
    lagged = fc.lag_forecasts(forecasts)
    assert column(lagged, "previous_day_predicted_price")[1:] == column(forecasts, "predicted_price")[:-1]


def test_dashboard(spark):
    rows = pairs(spark, [10.0] * 20 + [100.0], [10.0, 11.0] * 10 + [10.0])
    points = dashboard.scatter_points(rows, "y", "p")
    assert points.count() == 21
    outliers = dashboard.residual_outliers(points).collect()
    assert [(r["actual"], r["residual"]) for r in outliers] == [(100.0, 90.0)]
    assert dashboard.scatter_points(pairs(spark, [None, 1.0], [1.0, None]), "y", "p").count() == 0


def test_recent_period(spark, price_rows):
    rows = price_rows([1.0] * 100)
    recent = dashboard.recent_period(rows, 1)
    assert recent.agg(F.min("date")).first()[0] == datetime.date(2024, 3, 9)
    assert recent.count() == 32


def daily_config(tmp_path, **more):
    rng, lines = random.Random(2), ["Date,AAPL,MSFT"]
    for n in range(90):
        lines.append(f"{day(n)},{rng.uniform(90, 110):.2f},{rng.uniform(190, 210):.2f}")
    history = tmp_path / "history.csv"
    history.write_text("\n".join(lines) + "\n")
    return jobs.Config(
        warehouse=str(tmp_path / "tables"),
        models=str(tmp_path / "models"),
        history=str(history),
        pages=str(tmp_path / "pages"),
        trees=4,
        depth=3,
        **more,
    )


@pytest.mark.parametrize("symbols, since", [((), None), (("AAPL", "MSFT"), day(91))])
def test_daily_chain(spark, tmp_path, symbols, since):
    config = daily_config(tmp_path, symbols=symbols)
    today = day(91)
    assert today.weekday() < 5
    html = '<span data-testid="qsp-price">101.25</span>'
    at = datetime.datetime.combine(today, datetime.time(22))
    spark.createDataFrame(
        [("AAPL", 200, at, html), ("MSFT", 500, at, html)],
        "symbol string, status int, fetched_at timestamp_ntz, html string",
    ).write.parquet(config.pages)

    jobs.run_ingest(spark, config, today)
    jobs.run_features(spark, config)
    assert jobs.run_train(spark, config).count() == 2
    jobs.run_predict(spark, config)
    tomorrow = html.replace("101", "102")
    spark.createDataFrame(
        [("AAPL", 200, at + datetime.timedelta(days=1), tomorrow)],
        "symbol string, status int, fetched_at timestamp_ntz, html string",
    ).write.mode("append").parquet(config.pages)
    today += datetime.timedelta(days=1)
    assert jobs.run_daily(spark, config, today, since)

    def size(table):
        return read_table(spark, config.path(table), TABLES[table]).count()

    counts = {t: size(t) for t in TABLES}
    assert counts == {
        "stock_prices": 182,
        "full_stock_calculations": 122,
        "predicted_stock_prices": 120,
        "model_eval": 2,
    }
    assert jobs.run_daily(spark, config, today)
    assert {t: size(t) for t in TABLES} == counts
    assert not jobs.run_daily(spark, config, datetime.date(2024, 1, 6))


def test_a_symbol_silent_for_years_is_forecast(spark, tmp_path):
    table = TABLES["full_stock_calculations"]
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(days=n) for n in range(60)]
    since = datetime.date(2023, 6, 1)
    rows = [("A", d, float(n)) for n, d in enumerate([*days, since])]
    rows += [("B", d, float(n)) for n, d in enumerate([*days, datetime.date(2023, 5, 31), since])]
    frame = spark.createDataFrame(rows, "symbol string, date date, current_price double")
    missing = [f for f in table.schema.fields if f.name not in frame.columns]
    numbers = {f.name: F.col("current_price").cast(f.dataType) for f in missing}
    features = frame.withColumns(numbers).select(*table.schema.names)
    found = []
    for name, begin in (("whole", None), ("narrow", since)):
        config = daily_config(tmp_path / name) if (tmp_path / name).mkdir() is None else None
        config.insert(spark, features, table.name)
        if not found:
            jobs.run_train(spark, config)
        models = jobs.Config(warehouse=config.warehouse, models=str(tmp_path / "whole" / "models"))
        jobs.run_predict(spark, models, begin)
        stored = models.read(spark, "predicted_stock_prices").where(F.col("date") >= F.lit(since))
        found.append(sorted(map(tuple, stored.collect())))
    assert found[0] == found[1]
    assert [r[0] for r in found[0]] == ["A", "B"]


def test_metrics_freeze_unless_refreshed(spark, tmp_path):
    config = daily_config(tmp_path)
    table = TABLES["predicted_stock_prices"]

    def predictions(error):
        rows = spark.range(5).select(
            F.lit("A").alias("symbol"),
            F.date_add(F.lit(day(0)), F.col("id").cast("int")).alias("date"),
            F.col("id").cast("double").alias("current_price"),
            (F.col("id") + error).alias("previous_day_predicted_price"),
        )
        missing = [f for f in table.schema.fields if f.name not in rows.columns]
        rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
        rows.select(*table.schema.names).write.mode("overwrite").parquet(config.path(table.name))

    def mae():
        return config.read(spark, "model_eval").first()["mae"]

    predictions(1.0)
    jobs.run_evaluate(spark, config)
    predictions(2.0)
    jobs.run_evaluate(spark, config)
    assert mae() == 1.0
    jobs.run_evaluate(spark, daily_config(tmp_path, refresh_metrics=True))
    assert mae() == 2.0


def test_a_fit_keeps_no_node_numbers_and_reads_large_partitions():
    """Both were written to disk: 400 bytes a row and group of nodes, and sums by partition."""
    forest = forests._pipeline(100, 10, 1).getStages()[-1]
    assert not forest.getCacheNodeIds()
    assert forest.getNumTrees() == 100 and forest.getMaxDepth() == 10
    assert -(-22_500_000 // forests.PART_ROWS) <= 24
