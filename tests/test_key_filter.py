"""The filter in front of the key check: same rows, fewer keys read."""

import datetime
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickloom.schemas import TABLES
from tickloom.sources import key_filter
from tickloom.sources.key_filter import insert_filtered, probably_known
from tickloom.sources.sinks import insert_if_absent
from tickloom.sources.tables import read_table

PRICES = TABLES["stock_prices"]


def batch(spark, keys, price):
    rows = [(s, "n", d, float(price), None) for s, d in keys]
    return spark.createDataFrame(rows, PRICES.schema)


def some_keys(rng, count, year):
    days = [datetime.date(year, 1, 1) + datetime.timedelta(days=n) for n in range(300)]
    return list({(f"S{rng.randrange(40)}", rng.choice(days)) for _ in range(count)})


def stored(spark, path):
    rows = read_table(spark, path, PRICES).collect()
    assert len({(r.symbol, r.date) for r in rows}) == len(rows)
    return {(r.symbol, r.date): r.current_price for r in rows}


@pytest.mark.parametrize("words", [2, 64, key_filter.WORDS])
def test_rows_are_those_of_the_plain_insert(spark, tmp_path, words):
    """Two words a year are so full that every key is looked up; many hardly any."""
    rng, plain, filtered = random.Random(words), str(tmp_path / "plain"), str(tmp_path / "filtered")
    for price in range(3):
        keys = some_keys(rng, 300, 2023) + some_keys(rng, 300, 2024)
        insert_if_absent(spark, batch(spark, keys, price), PRICES, plain)
        insert_filtered(spark, batch(spark, keys, price), PRICES, filtered, words)
    wanted = stored(spark, plain)
    assert stored(spark, filtered) == wanted
    keys = read_table(spark, filtered, PRICES).select("symbol", "date")
    # Stored keys are always found; new ones by chance, and rarely where there is room.
    assert probably_known(keys, PRICES, filtered, words).count() == len(wanted)
    new = [k for k in some_keys(rng, 3000, 2024) if k not in wanted]
    by_chance = probably_known(batch(spark, new, 0).select("symbol", "date"), PRICES, filtered, words).count()
    assert by_chance == len(new) if words == 2 else by_chance < len(new) / 10 if words > 64 else by_chance < len(new)


def spoil(path, year):
    """Files of a year that nothing may read any more."""
    files = list(Path(path, f"_year={year}").glob("*.parquet"))
    assert files
    for file in files:
        file.write_bytes(b"not a table")


def test_keys_are_read_only_for_probable_hits(spark, tmp_path):
    path = str(tmp_path / "prices")
    day = datetime.date
    insert_filtered(spark, batch(spark, [("A", day(2022, 5, 1)), ("A", day(2023, 5, 1))], 1), PRICES, path)
    spoil(path, 2022)
    # New keys of both years read no stored key; a known one reads its own year.
    insert_filtered(spark, batch(spark, [("B", day(2022, 5, 2)), ("B", day(2023, 5, 2))], 2), PRICES, path)
    insert_filtered(spark, batch(spark, [("A", day(2023, 5, 1)), ("C", day(2022, 5, 1))], 3), PRICES, path)
    kept = read_table(spark, path, PRICES).where(F.col("date") == F.lit(day(2023, 5, 1)))
    year = spark.read.schema(PRICES.schema).parquet(f"{path}/_year=2023").collect()
    assert sorted((r.symbol, r.current_price) for r in year) == [("A", 1.0), ("B", 2.0)] and kept is not None
    with pytest.raises(Exception):
        insert_filtered(spark, batch(spark, [("A", day(2022, 5, 1))], 4), PRICES, path)


def test_a_table_without_filter_gets_one(spark, tmp_path):
    path, rng = str(tmp_path / "prices"), random.Random(1)
    keys = some_keys(rng, 200, 2024)
    insert_if_absent(spark, batch(spark, keys, 1), PRICES, path)
    insert_filtered(spark, batch(spark, keys + [("NEW", keys[0][1])], 2), PRICES, path)
    got = stored(spark, path)
    assert len(got) == len(keys) + 1 and got["NEW", keys[0][1]] == 2
    insert_filtered(spark, batch(spark, [], 3), PRICES, path)
    assert stored(spark, path) == got
    with pytest.raises(ValueError):
        insert_filtered(spark, batch(spark, keys, 1), TABLES["model_eval"], path)
