"""What a query needs no more does not stay on disk beside what it writes next."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tickloom.plans.queries import QUERIES
from tickloom.schemas import TABLES
from tickloom.sources.sinks import insert_if_absent
from tickloom.sources.tables import staged, unstaged


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def settled(spark, before):
    """Removal goes on in the background."""
    for _ in range(100):
        if shuffle_files(spark) <= before:
            return True
        time.sleep(0.1)
    return False


def test_a_write_leaves_no_shuffle_files(spark, tmp_path, price_rows):
    before = shuffle_files(spark)
    rows = price_rows(range(1, 60))
    kept = staged(rows.repartition(3, "date"), "dealt")
    assert settled(spark, before)
    prices = rows.select("symbol", F.lit("n").alias("name"), "date", "current_price", F.lit(1.0).alias("open_price"))
    assert len(kept.collect()) == 59
    for _ in range(2):
        insert_if_absent(spark, prices, TABLES["stock_prices"], str(tmp_path / "prices"))
        assert settled(spark, before)
    assert spark.read.parquet(str(tmp_path / "prices")).count() == 59


def test_a_staged_table_is_removed(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    rows = staged(spark.range(5), "five")
    assert any(name.startswith("five-") for name in os.listdir(folder))
    unstaged(rows)
    assert not any(name.startswith("five-") for name in os.listdir(folder))


@pytest.mark.parametrize(
    "name, left",
    [("sink_predictions", {"aligned", "predicted_stock_prices"}), ("sink_features", {"features", "full_stock_calculations"}),
     ("bucketed_join", {"stock_prices", "predicted_stock_prices"})],
)
def test_only_tables_that_are_read_later_stay(spark, folder, name, left):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    assert QUERIES[name](spark, folder).count() > 0
    assert {new.rpartition("-")[0] for new in set(os.listdir(shared)) - before} == left
