"""Bucketed tables: joins without a shuffle of stored rows, keyed inserts."""

import pytest
from pyspark.sql import functions as F

from conftest import day
from tickloom.operators.forecasts import join_forecasts
from tickloom.operators.metrics import join_actual_predicted
from tickloom.schemas import TABLES
from tickloom.sources import bucketed
from tickloom.sources.bucketed import insert_bucketed, open_bucketed

PRICES = TABLES["stock_prices"]
FORECASTS = TABLES["predicted_stock_prices"]


def prices(spark, rows):
    """(symbol, day, price) as a batch; one symbol may hold most of them."""
    frame = spark.createDataFrame([(s, day(d), float(p)) for s, d, p in rows], "symbol string, date date, current_price double")
    return frame.withColumns({"name": F.col("symbol"), "open_price": F.lit(None).cast("double")})


def stored(spark, path, buckets=8):
    return {(r.symbol, r.date): r.current_price for r in open_bucketed(spark, path, PRICES, buckets).collect()}


def exchanges(frame):
    """Exchanges of the plan before any row is read."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


@pytest.fixture
def sized(spark):
    """Stored sides too large to be sent around, as they are in earnest."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_first_writer_wins_across_sessions(spark, tmp_path):
    path = str(tmp_path / "prices")
    insert_bucketed(spark, prices(spark, [("A", d, d) for d in range(50)] + [("B", 1, 7)]), PRICES, path, 8)
    # Another session knows nothing of the entry.
    for t in spark.catalog.listTables():
        if t.name.startswith("stock_prices_"):
            spark.sql(f"DROP TABLE {t.name}")
    batch = prices(spark, [("A", 49, -1), ("A", 50, 50), ("A", 50, 51), ("C", 1, 9)])
    batch = batch.withColumn("_arrival", F.col("current_price"))
    insert_bucketed(spark, batch, PRICES, path, 8)
    got = stored(spark, path)
    assert len(got) == 53 and got["A", day(49)] == 49 and got["A", day(50)] == 50
    insert_bucketed(spark, batch, PRICES, path, 8)
    assert stored(spark, path) == got


def test_null_keys_and_missing_tables_fail(spark, tmp_path):
    bad = prices(spark, [("A", 1, 1)]).withColumn("symbol", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="null"):
        insert_bucketed(spark, bad, PRICES, str(tmp_path / "prices"), 4)
    with pytest.raises(FileNotFoundError):
        open_bucketed(spark, str(tmp_path / "none"), PRICES, 4)


def test_stored_rows_are_not_shuffled(spark, tmp_path, sized):
    rows = [("HOT", d, d) for d in range(400)] + [(f"S{i}", d, d) for i in range(5) for d in range(20)]
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    for part in (rows[:200], rows[200:]):
        insert_bucketed(spark, prices(spark, part), PRICES, one, 8, unique=True)
    missing = [f for f in FORECASTS.schema.fields if f.name not in ("symbol", "date", "current_price")]
    scored = prices(spark, rows[::2]).select("symbol", "date", "current_price")
    scored = scored.withColumns({f.name: F.lit(1.5).cast(f.dataType) for f in missing})
    insert_bucketed(spark, scored, FORECASTS, two, 8, unique=True)

    left = open_bucketed(spark, one, PRICES, 8)
    right = open_bucketed(spark, two, FORECASTS, 8).select("symbol", "date", "predicted_price")
    outer, inner = join_forecasts(left, right), join_actual_predicted(left, right)
    assert exchanges(outer) == 0 and exchanges(inner) == 0
    assert outer.count() == len(rows) and outer.where("predicted_price = 1.5").count() == len(rows[::2])
    assert inner.count() == len(rows[::2])
    # A batch moves; what is stored does not.
    batch = prices(spark, [("HOT", d, 0) for d in range(390, 410)]).repartition(8, "symbol", "date")
    fresh = batch.join(left.select("symbol", "date"), ["symbol", "date"], "left_anti")
    assert exchanges(fresh) == 1 and fresh.count() == 10
    # The hot symbol lies in every bucket.
    places = left.where("symbol = 'HOT'").select(F.input_file_name().alias("f")).distinct().count()
    assert places >= 8
    assert bucketed.BUCKETS > 0


def test_an_empty_batch_and_other_bucket_numbers(spark, tmp_path):
    path = str(tmp_path / "prices")
    insert_bucketed(spark, prices(spark, [("A", 1, 1)]), PRICES, path, 4)
    insert_bucketed(spark, prices(spark, [("A", 1, 1)]).limit(0), PRICES, path, 4)
    insert_bucketed(spark, prices(spark, [("B", 1, 2)]), PRICES, path, 2)
    assert stored(spark, path, 4) == {("A", day(1)): 1} and stored(spark, path, 2) == {("B", day(1)): 2}
