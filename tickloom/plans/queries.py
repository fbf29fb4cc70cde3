"""Registered queries: each operator over the whole of the given tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalars import (
    is_after_close,
    is_business_day,
    local_time,
    parse_name,
    parse_price,
    quote_url,
    round2,
    round_to,
    to_day,
    week_end,
    week_start,
)
from tickloom.operators import dashboard, forest_tables, forests, ingest, metrics, returns
from tickloom.operators import forecasts as fc
from tickloom.operators.features import (
    add_features,
    exponential_averages,
    feature_state,
    features_table,
)
from tickloom.plans import frames
from tickloom.plans.jobs import Config, run_daily as daily_jobs, run_evaluate, run_features
from tickloom.plans.jobs import run_ingest, run_predict, run_train
from tickloom.schemas import TABLES
from tickloom.session import scratch_path
from tickloom.sources.bucketed import insert_bucketed, open_bucketed
from tickloom.sources.files import one_row_per_date, scan_wide_csv
from tickloom.sources.key_filter import insert_filtered
from tickloom.sources.sinks import insert_if_absent, upsert
from tickloom.sources.tables import read_table, staged, unstaged
from tickloom.streaming.incremental import ingest_new_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PAGE_ELEMENTS = {"title": {"tag": "title"}, "heading": {"tag": "h1"}}
HEAD_ROWS = 210
RECENT_MONTHS = 6
OUTLIER_DEVIATIONS = 2.0
#: A Friday in the middle of the series, up to which states are taken.
CUT = datetime.date(1995, 6, 30)
#: How late a page may come to the stream that remembers pages.
LATE_DAYS = 30


def query(run: Query) -> Query:
    """Register under the function's name, less a trailing underscore."""
    QUERIES[run.__name__.rstrip("_")] = run
    return run


def rounded(rows: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Figures to a fixed number of digits, so that engines can be compared."""
    return rows.withColumns({c: round_to(c, digits) for c in columns})


# Sources and sinks


@query
def wide_csv_scan(spark, folder):
    path = scratch_path(spark, "wide")
    frames.wide(spark, folder).write.option("header", True).csv(path)
    return one_row_per_date(scan_wide_csv(spark, path))


@query
def wide_csv_union(spark, folder):
    """Price files of two headers: some lines only, in another order, for some years."""
    path = scratch_path(spark, "wide")
    wide = frames.wide(spark, folder)
    is_old = F.col("date") <= F.lit(CUT)
    wide.where(is_old).write.option("header", True).csv(path)
    later = wide.where(~is_old).select("date", "L3", "L1", F.col("L2").alias("M2"))
    later.write.option("header", True).mode("append").csv(path)
    return one_row_per_date(scan_wide_csv(spark, path))


@query
def quote_extract(spark, folder):
    return ingest.extract_quotes(frames.quote_pages(spark, folder)).drop("fetched_at")


@query
def table_scan(spark, folder):
    return read_table(spark, f"{folder}/orders.parquet")


@query
def page_extract(spark, folder):
    return ingest.extract_page_text(frames.load(spark, folder, "pages"), PAGE_ELEMENTS)


def stored_twice(
    spark, first: DataFrame, second: DataFrame, table: str, unique: bool = True
) -> DataFrame:
    """Two batches into a new table, then the table."""
    path = scratch_path(spark, table)
    insert_if_absent(spark, first, TABLES[table], path, unique=unique)
    insert_if_absent(spark, second, TABLES[table], path, unique=unique)
    return read_table(spark, path, TABLES[table])


@query
def sink_prices(spark, folder):
    first = ingest.clean_prices(
        frames.early_series(spark, folder), frames.names(spark, folder)
    )
    second = ingest.clean_prices(frames.series(spark, folder), frames.names(spark, folder))
    return stored_twice(spark, first, second, "stock_prices", unique=False)


@query
def sink_features(spark, folder):
    # Both batches come from rows that are computed once.
    cleaned = staged(frames.cleaned(spark, folder), "cleaned")
    rows = staged(features_table(cleaned), "features")
    unstaged(cleaned)
    first = rows.where(F.month("date") % 2 == 0)
    second = rows.withColumn("ema_30", -F.col("ema_30"))
    stored = stored_twice(spark, first, second, "full_stock_calculations")
    return rounded(
        stored, "cumulative_return", "ma_10_day", "ma_30_day", "volatility_30_day",
        "ema_10", "ema_30",
    )


def standin_predictions(spark, folder, features: DataFrame | None = None) -> DataFrame:
    if features is None:
        features = stored_features(spark, folder)
    return fc.align_forecasts(features.withColumn("predicted_price", F.col("ma_10_day")))


@query
def sink_predictions(spark, folder):
    features = stored_features(spark, folder)
    rows = staged(standin_predictions(spark, folder, features), "aligned")
    unstaged(features)
    first = rows.where(F.month("date") % 2 == 0)
    second = rows.withColumn("predicted_price", -F.col("predicted_price"))
    stored = stored_twice(spark, first, second, "predicted_stock_prices")
    return rounded(
        stored.select(
            "symbol", "date", "current_price", "predicted_price",
            "previous_day_predicted_price",
        ),
        "predicted_price", "previous_day_predicted_price",
    )


def compared_metrics(spark, folder) -> DataFrame:
    return metrics.model_metrics(frames.compared(spark, folder))


def rounded_metrics(rows: DataFrame) -> DataFrame:
    rows = rounded(rows, "r_squared", "directional_accuracy")
    return rounded(rows, "mae", "rmse", "mse", digits=2)


@query
def sink_eval(spark, folder):
    rows = compared_metrics(spark, folder)
    changed = rows.withColumn("mae", F.col("mae") + 1)
    return rounded_metrics(stored_twice(spark, rows, changed, "model_eval"))


@query
def upsert_eval(spark, folder):
    path = scratch_path(spark, "model_eval")
    rows = compared_metrics(spark, folder)
    upsert(spark, rows, TABLES["model_eval"], path)
    changed = rows.where(F.col("symbol").endswith("3")).withColumn("mae", F.lit(0.0))
    upsert(spark, changed, TABLES["model_eval"], path)
    return rounded_metrics(read_table(spark, path, TABLES["model_eval"]))


@query
def insert_if_absent_(spark, folder):
    existing = frames.early_series(spark, folder)
    # Each line is a row of its own, so most keys of the batch repeat.
    batch = frames.load(spark, folder, "lineitem").select(
        frames.symbol_of("l_suppkey").alias("symbol"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_extendedprice").alias("current_price"),
        F.struct("l_orderkey", "l_linenumber").alias(ingest.ARRIVAL),
    )
    absent = ingest.absent_rows(batch, existing, ["symbol", "date"])
    return existing.unionByName(absent)


@query
def bucketed_insert(spark, folder):
    """``sink_prices`` on a bucketed table: the stored keys of the check do not move."""
    path = scratch_path(spark, "bucketed")
    names = frames.names(spark, folder)
    for source in (frames.early_series, frames.series):
        batch = ingest.clean_prices(source(spark, folder), names)
        insert_bucketed(spark, batch, TABLES["stock_prices"], path)
    return open_bucketed(spark, path, TABLES["stock_prices"])


@query
def filtered_insert(spark, folder):
    """``sink_prices`` with a filter of stored keys in front of the key check."""
    path = scratch_path(spark, "filtered")
    names = frames.names(spark, folder)
    for source in (frames.early_series, frames.series):
        batch = ingest.clean_prices(source(spark, folder), names)
        insert_filtered(spark, batch, TABLES["stock_prices"], path)
    return read_table(spark, path, TABLES["stock_prices"])


# Shaping


@query
def eval_pairs(spark, folder):
    rows = metrics.eval_pairs(standin_predictions(spark, folder))
    return rounded(rows, "previous_day_predicted_price")


@query
def unpivot_prices(spark, folder):
    return ingest.unpivot_prices(frames.wide(spark, folder))


@query
def symbol_name_lookup(spark, folder):
    return ingest.with_names(frames.series(spark, folder), frames.names(spark, folder))


@query
def date_coerce(spark, folder):
    orders = frames.load(spark, folder, "orders")
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    other = F.date_format("o_orderdate", "MM/dd/yyyy")
    return orders.select(
        "o_orderkey", to_day(text).alias("date"), to_day(other, "MM/dd/yyyy").alias("date_us")
    )


@query
def clean_prices(spark, folder):
    return ingest.sort_by_date(frames.cleaned(spark, folder))


@query
def union_history_current(spark, folder):
    rows = ingest.union_history_current(
        frames.cleaned(spark, folder),
        ingest.extract_quotes(frames.quote_pages(spark, folder)),
    )
    source = F.col(ingest.ARRIVAL)["source"]
    return rows.withColumn("source", source).drop(ingest.ARRIVAL)


@query
def history_then_current(spark, folder):
    """The union reduced to what ``stock_prices`` keeps of it."""
    rows = ingest.union_history_current(
        frames.cleaned(spark, folder),
        ingest.extract_quotes(frames.quote_pages(spark, folder)),
    )
    return ingest.first_per_key(rows, ["symbol", "date"])


# Filters


@query
def symbol_filter(spark, folder):
    return frames.series(spark, folder).where(F.col("symbol") == "S1")


def stored_features(spark, folder, cleaned: DataFrame | None = None) -> DataFrame:
    """Features as a written table: what is read several times is computed once.

    So are the cleaned prices, which every chunk is read from and summed up from; they go
    when the features are written.
    """
    if cleaned is None:
        cleaned = staged(frames.cleaned(spark, folder), "cleaned")
    features = staged(add_features(cleaned), "features")
    unstaged(cleaned)
    return features


@query
def training_frame(spark, folder):
    rows = fc.training_frame(stored_features(spark, folder))
    return rounded(
        rows, "cumulative_return", "ma_10_day", "ma_30_day", "volatility_30_day",
        "ema_10", "ema_30",
    )


@query
def train_test_split(spark, folder):
    rows = frames.series(spark, folder)
    return fc.with_split(rows).select("symbol", "date", "is_test")


@query
def warmup_trim(spark, folder):
    return returns.skip_first(frames.series(spark, folder), 30)


@query
def head_drop(spark, folder):
    return returns.skip_head(frames.series(spark, folder), HEAD_ROWS)


@query
def after_close(spark, folder):
    events = frames.load(spark, folder, "events")
    return events.where(is_after_close("ts")).select("event_id", "ts")


@query
def business_days(spark, folder):
    days = frames.load(spark, folder, "events").select(
        "event_id", F.to_date("ts").alias("day")
    )
    return days.where(is_business_day("day")).select(
        "event_id",
        "day",
        week_start("day").alias("week_start"),
        week_end("day").alias("week_end"),
    )


# Joins


@query
def features_left_predictions(spark, folder):
    features = frames.gappy(spark, folder)
    rows = fc.join_forecasts(features, frames.forecasts(spark, folder))
    return rounded(rows, "predicted_price")


@query
def actual_join_predicted(spark, folder):
    rows = metrics.join_actual_predicted(
        frames.gappy(spark, folder), frames.forecasts(spark, folder)
    )
    return rounded(rows, "predicted_price")


@query
def bucketed_join(spark, folder):
    """Stored prices with stored forecasts, joined where they lie."""
    prices, scored = TABLES["stock_prices"], TABLES["predicted_stock_prices"]
    paths = [scratch_path(spark, t.name) for t in (prices, scored)]
    cleaned = staged(frames.cleaned(spark, folder), "cleaned")
    insert_bucketed(spark, cleaned, prices, paths[0], unique=True)
    features = stored_features(spark, folder, cleaned)
    # Alignment and buckets deal the rows in two ways; neither keeps its shuffle beside the other's.
    made = staged(standin_predictions(spark, folder, features), "aligned")
    unstaged(features)
    insert_bucketed(spark, made, scored, paths[1], unique=True)
    unstaged(made)
    made = open_bucketed(spark, paths[1], scored).select("symbol", "date", "predicted_price")
    rows = fc.join_forecasts(open_bucketed(spark, paths[0], prices), made)
    return rounded(rows.select("symbol", "date", "current_price", "predicted_price"), "predicted_price")


# Metrics


@query
def model_metrics(spark, folder):
    return rounded_metrics(compared_metrics(spark, folder))


@query
def merged_metrics(spark, folder):
    """Metrics from the sums of the rows up to a day, merged with those of later rows."""
    rows = frames.compared(spark, folder)
    path = scratch_path(spark, "sums")
    metrics.metric_state(rows.where(F.col("date") <= F.lit(CUT))).write.parquet(path)
    later = rows.where(F.col("date") > F.lit(CUT))
    return rounded_metrics(metrics.metrics_of(metrics.metric_state(later, spark.read.parquet(path))))


@query
def directional_accuracy(spark, folder):
    rows = metrics.directional_accuracy(frames.compared(spark, folder))
    return rounded(rows, "directional_accuracy")


@query
def distinct_symbols(spark, folder):
    return metrics.distinct_symbols(frames.series(spark, folder))


# Windows


@query
def open_from_prev_close(spark, folder):
    return returns.open_from_previous_close(frames.gappy(spark, folder))


@query
def lag_predictions(spark, folder):
    rows = fc.lag_forecasts(frames.forecasts(spark, folder))
    return rounded(rows, "predicted_price", "previous_day_predicted_price")


@query
def percent_change(spark, folder):
    return returns.percent_change(frames.gappy(spark, folder))


@query
def percent_change_unfilled(spark, folder):
    return returns.percent_change(frames.gappy(spark, folder), fill=None)


@query
def cumulative_return(spark, folder):
    return rounded(
        returns.cumulative_return(frames.gappy(spark, folder)), "cumulative_return"
    )


@query
def ma_10_day(spark, folder):
    rows = returns.rolling_mean(frames.gappy(spark, folder), 10, "ma_10_day")
    return rounded(rows, "ma_10_day")


@query
def ma_30_day(spark, folder):
    rows = returns.rolling_mean(frames.gappy(spark, folder), 30, "ma_30_day")
    return rounded(rows, "ma_30_day")


@query
def volatility_30_day(spark, folder):
    rows = returns.volatility(frames.gappy(spark, folder))
    return rounded(rows, "volatility_30_day")


@query
def ema_10(spark, folder):
    return rounded(exponential_averages(frames.gappy(spark, folder), [10]), "ema_10")


@query
def ema_30(spark, folder):
    return rounded(exponential_averages(frames.gappy(spark, folder), [30]), "ema_30")


@query
def features(spark, folder):
    rows = add_features(frames.gappy(spark, folder))
    return rounded(
        rows, "cumulative_return", "ma_10_day", "ma_30_day", "volatility_30_day",
        "ema_10", "ema_30",
    )


@query
def features_from_state(spark, folder):
    """Features of the rows up to a day, and of the later ones from the state they left."""
    rows = frames.gappy(spark, folder)
    before = rows.where(F.col("date") <= F.lit(CUT))
    path = scratch_path(spark, "state")
    feature_state(before).write.parquet(path)
    later = add_features(rows.where(F.col("date") > F.lit(CUT)), state=spark.read.parquet(path))
    return rounded(
        add_features(before).unionByName(later), "cumulative_return", "ma_10_day", "ma_30_day",
        "volatility_30_day", "ema_10", "ema_30",
    )


# Scalars


@query
def round2_(spark, folder):
    lines = frames.load(spark, folder, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return lines.select("l_orderkey", "l_linenumber", round2(net).alias("net_price"))


def price_text():
    """Order totals written in ways that do and do not read as a number."""
    total = F.col("o_totalprice")
    kind = F.col("o_orderkey") % 8
    text = F.format_number(total, 2)
    return (
        F.when(kind == 0, F.concat(F.lit(" "), text, F.lit("\n")))
        .when(kind == 1, F.concat(text, F.lit("d")))
        .when(kind == 2, F.concat(text, F.lit("e1")))
        .when(kind == 3, F.lit("N/A"))
        .when(kind == 4, F.concat(F.lit("-"), text))
        .when(kind == 5, F.lit(""))
        .otherwise(text)
    )


@query
def parse_price_(spark, folder):
    orders = frames.load(spark, folder, "orders")
    return orders.select("o_orderkey", parse_price(price_text()).alias("price"))


@query
def parse_name_(spark, folder):
    suppliers = frames.load(spark, folder, "supplier")
    heading = F.when(
        F.col("s_suppkey") % 5 != 0,
        F.concat("s_name", F.lit(" ("), frames.symbol_of("s_suppkey"), F.lit(")")),
    )
    return suppliers.select("s_suppkey", parse_name(heading).alias("name"))


@query
def quote_url_(spark, folder):
    suppliers = frames.load(spark, folder, "supplier")
    return suppliers.select(
        "s_suppkey", quote_url(frames.symbol_of("s_suppkey")).alias("url")
    )


# Dashboard


def standin_points(spark, folder) -> DataFrame:
    return dashboard.scatter_points(frames.compared(spark, folder))


@query
def scatter_points(spark, folder):
    return rounded(standin_points(spark, folder), "predicted")


@query
def residual_outliers(spark, folder):
    rows = dashboard.residual_outliers(standin_points(spark, folder), OUTLIER_DEVIATIONS)
    return rounded(rows, "predicted", "residual", "residual_deviation")


@query
def residual_outliers_by_rule(spark, folder):
    """With the rule's own number of deviations, on prices that spike now and then."""
    rows = dashboard.residual_outliers(dashboard.scatter_points(frames.spiked(spark, folder)))
    return rounded(rows, "predicted", "residual", "residual_deviation")


@query
def recent_period(spark, folder):
    return dashboard.recent_period(frames.series(spark, folder), RECENT_MONTHS)


# Models


def split_training(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Features, training rows and test rows, read back from written tables."""
    features = stored_features(spark, folder)
    split_path = scratch_path(spark, "training")
    rows = staged(fc.training_frame(features), "training-rows")
    fc.with_split(rows).write.parquet(split_path)
    split = spark.read.parquet(split_path)
    return features, split.where(~F.col("is_test")), split.where(F.col("is_test"))


@query
def train_models(spark, folder):
    """Fit, save, load; the size of the loaded forests against the rows they saw."""
    _, training, _ = split_training(spark, folder)
    models = scratch_path(spark, "models")
    forests.save_model(forests.fit_pooled(training), models)
    trees, nodes = forests.load_model(spark, models).size()
    return training.agg(F.count(F.lit(1)).alias("training_rows")).withColumns(
        {"trees": F.lit(trees), "nodes": F.lit(nodes)}
    )


@query
def holdout_metrics(spark, folder):
    _, training, holdout = split_training(spark, folder)
    model = forests.fit_pooled(training)
    return metrics.holdout_metrics(forests.score(model, holdout))


@query
def holdout_metrics_of_mean(spark, folder):
    """The same rows with the ten-row mean as forecast, which any engine can repeat."""
    rows = staged(fc.training_frame(stored_features(spark, folder)), "training-rows")
    rows = fc.with_split(rows).where("is_test")
    found = metrics.holdout_metrics(rows.withColumn("predicted_price", F.col("ma_10_day")))
    return rounded(rounded(found, "r_squared"), "mse", digits=2)


def scored_features(spark, folder) -> DataFrame:
    features, training, _ = split_training(spark, folder)
    return forests.score(forests.fit_pooled(training), features)


@query
def predict(spark, folder):
    return scored_features(spark, folder).select("symbol", "date", "predicted_price")


@query
def predictions_as_stored(spark, folder):
    return fc.align_forecasts(staged(scored_features(spark, folder), "scored"), "as_stored")


@query
def predict_per_symbol(spark, folder):
    """Every row scored by its own symbol's forest; rows of symbols without one go."""
    # Nodes are counted, then sent or met.
    nodes = staged(frames.rule_forests(spark, folder), "nodes")
    rows = forest_tables.score_own(nodes, frames.features(spark, folder))
    return rounded(rows.select("symbol", "date", "predicted_price"), "predicted_price")


# Jobs and streams


@query
def incremental_ingest(spark, folder):
    """Two deliveries of pages, the second repeating keys of the first."""
    base = scratch_path(spark, "incremental")
    pages = frames.quote_pages(spark, folder)
    deliveries = [
        pages.where(F.dayofyear(local_time("fetched_at")) % 2 == 0),
        pages.withColumn("html", F.replace("html", F.lit("Supplier"), F.lit("Vendor"))),
    ]
    for delivery in deliveries:
        delivery.write.mode("append").parquet(f"{base}/landing")
        ingest_new_pages(spark, f"{base}/landing", f"{base}/prices", f"{base}/state")
    return read_table(spark, f"{base}/prices", TABLES["stock_prices"])


@query
def incremental_ingest_late(spark, folder):
    """Deliveries under a watermark: early years, all of them again with the rest, stragglers.

    The stragglers are pages of one weekday that both deliveries before had left out; they
    come after the watermark has passed them but for those of the last days.
    """
    base = scratch_path(spark, "incremental")
    pages = frames.quote_pages(spark, folder)
    day = F.to_date(local_time("fetched_at"))
    is_straggler = F.dayofweek(day) == 4
    early = pages.where(~is_straggler & (day <= F.lit(CUT)))
    for delivery in (early, pages.where(~is_straggler), pages.where(is_straggler)):
        delivery.write.mode("append").parquet(f"{base}/landing")
        ingest_new_pages(
            spark, f"{base}/landing", f"{base}/prices", f"{base}/state", late=f"{LATE_DAYS} days"
        )
    return read_table(spark, f"{base}/prices", TABLES["stock_prices"])


@query
def daily_chain(spark, folder):
    """Ingest, features, training, then the daily chain; returns ``model_eval``."""
    base = scratch_path(spark, "chain")
    frames.wide(spark, folder).write.option("header", True).csv(f"{base}/history")
    frames.quote_pages(spark, folder).write.parquet(f"{base}/pages")
    config = Config(
        warehouse=f"{base}/tables",
        models=f"{base}/models",
        history=f"{base}/history",
        pages=f"{base}/pages",
        names={f"L{n}": f"Line {n}" for n in frames.LINES},
    )
    run_ingest(spark, config)
    run_features(spark, config)
    run_train(spark, config)
    run_predict(spark, config)
    run_evaluate(spark, config)
    return config.read(spark, "model_eval")


@query
def run_daily(spark, folder):
    """Three daily runs: up to a Friday, on the Saturday, and from the state on Monday.

    The ten-row mean is the forecast. Returns what the chain left of each symbol: its
    stored prices, with the quotes of the two business days, and its metrics.
    """
    base = scratch_path(spark, "daily")
    wide = frames.wide(spark, folder)
    config = Config(
        warehouse=f"{base}/tables",
        models=f"{base}/models",
        history=f"{base}/history",
        pages=f"{base}/pages",
        names={f"L{n}": f"Line {n}" for n in frames.LINES},
        baseline="ma_10_day",
        refresh_metrics=True,
    )
    frames.quote_pages(spark, folder).write.parquet(config.pages)
    is_old = F.col("date") <= F.lit(CUT)
    wide.where(is_old).write.option("header", True).csv(config.history)
    daily_jobs(spark, config, CUT)
    wide.where(~is_old).write.option("header", True).mode("append").csv(config.history)
    next_day = CUT + datetime.timedelta(days=1)
    daily_jobs(spark, config, next_day, next_day)
    daily_jobs(spark, config, CUT + datetime.timedelta(days=3), next_day)
    prices = config.read(spark, "stock_prices").groupBy("symbol").agg(F.count(F.lit(1)).alias("price_rows"))
    return rounded_metrics(prices.join(config.read(spark, "model_eval"), "symbol", "left"))
