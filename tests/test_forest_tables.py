"""Every row by its own symbol's forest, against the library's own scoring."""

import random
from functools import reduce
from operator import add

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import day
from tickloom.operators import forest_tables, forests, metrics
from tickloom.operators.features import features_table
from tickloom.operators.forecasts import training_frame
from tickloom.operators.ingest import clean_prices
from tickloom.schemas import MODEL_FEATURES

SYMBOLS = ("A", "B b%", "C")


@pytest.fixture(scope="module")
def features(spark):
    rng, rows = random.Random(1), []
    for symbol in (*SYMBOLS, "D"):
        price = rng.uniform(50, 150)
        for n in range(120):
            price *= rng.uniform(0.97, 1.03)
            rows.append((symbol, day(n * 30), None if rng.random() < 0.05 else price))
    prices = spark.createDataFrame(rows, "symbol string, date date, current_price double")
    table = features_table(clean_prices(prices, {s: s for s in (*SYMBOLS, "D")}))
    return spark.createDataFrame(table.collect(), table.schema)


@pytest.fixture(scope="module")
def trained(spark, features, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("models"))
    models = forests.fit_each(training_frame(features), SYMBOLS, trees=5, depth=6)
    for symbol, model in models.items():
        forests.save_model(model, folder, symbol)
    return folder, models


def forecasts(frame):
    return {(r.symbol, r.date): r.predicted_price for r in frame.collect()}


@pytest.mark.parametrize("sent", [forest_tables.SENT_NODES, 0])
def test_own_forests_score_as_the_library_does(spark, features, trained, sent):
    folder, models = trained
    nodes = forest_tables.stored_nodes(spark, folder, SYMBOLS)
    wanted = forecasts(forests.score_each(models, features))
    got = forest_tables.score_own(nodes, features, sent_nodes=sent)
    assert got.columns == [*features.columns, "predicted_price"]
    assert forecasts(got) == wanted and len(wanted) > 200
    assert any(v is None for v in wanted.values()) and any(wanted.values())
    # Symbols without a forest stay on request, without a forecast.
    every = forecasts(forest_tables.score_own(nodes, features, others=True, sent_nodes=sent))
    assert {k: v for k, v in every.items() if k[0] != "D"} == wanted
    assert {v for k, v in every.items() if k[0] == "D"} == {None}
    # A forest without rows gives nothing.
    one = forecasts(forest_tables.score_own(nodes, features.where("symbol = 'C'"), sent_nodes=sent))
    assert one == {k: v for k, v in wanted.items() if k[0] == "C"}
    assert forecasts(forest_tables.score_own(nodes, features.limit(0), sent_nodes=sent)) == {}


def test_features_are_read_once(spark, features, trained, tmp_path):
    path = str(tmp_path / "features")
    features.write.parquet(path)
    nodes = forest_tables.stored_nodes(spark, trained[0], SYMBOLS)
    plan = forest_tables.score_own(nodes, spark.read.parquet(path))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Scan parquet") == 1


def test_missing_forests_fail(spark, features, trained):
    with pytest.raises(FileNotFoundError):
        forest_tables.stored_nodes(spark, trained[0], ["A", "Z"])
    with pytest.raises(ValueError):
        forest_tables.stored_nodes(spark, trained[0], [])
    nodes = forest_tables.stored_nodes(spark, trained[0], ["A"])
    with pytest.raises(ValueError):
        forest_tables.score_own(nodes.limit(0), features)
    with pytest.raises(ValueError, match="child"):
        forest_tables.Forest.of([0, 0], [0, 1], [1, -1], [0.5, 0.0], [1, -1], [9, -1], [1.0, 2.0])


def test_walk_equals_a_recursion():
    rng = np.random.default_rng(2)
    table = []

    def grow(tree, depth):
        node = sum(1 for r in table if r[0] == tree)
        table.append(None)
        if depth == 0 or rng.random() < 0.2:
            table[len(table) - 1] = (tree, node, -1, 0.0, -1, -1, float(rng.normal()))
            return node
        at = len(table) - 1
        table[at] = (tree, node, 0, 0.0, 0, 0, 0.0)
        left, right = grow(tree, depth - 1), grow(tree, depth - 1)
        table[at] = (tree, node, int(rng.integers(0, 3)), float(rng.normal()), left, right, 0.0)
        return node

    for t in range(4):
        grow(t, 5)
    nodes = {(r[0], r[1]): r for r in table}
    inputs = rng.normal(size=(50, 3))

    def walk(x, t, n=0):
        _, _, f, c, a, b, p = nodes[t, n]
        return p if f < 0 else walk(x, t, a if x[f] <= c else b)

    rng.shuffle(table)
    forest = forest_tables.Forest.of(*map(np.array, zip(*table)))
    wanted = [reduce(add, (walk(x, t) for t in range(4))) / 4 for x in inputs]
    assert forest.predict(inputs).tolist() == wanted


# Metrics that merge


def pairs(spark, seed, days):
    rng = random.Random(seed)
    rows = []
    for s in ("A", "B", "C", "EMPTY"):
        for n in days:
            if rng.random() < 0.2 and s != "A":
                continue
            y = None if s == "EMPTY" or rng.random() < 0.1 else 1e6 + rng.choice([1.0, 2.0, rng.random()])
            p = None if rng.random() < 0.1 else 1e6 + rng.random()
            rows.append((s, day(n), y, p))
    return spark.createDataFrame(rows, "symbol string, date date, y double, p double")


@pytest.mark.parametrize("cuts", [(40,), (1, 2, 3, 40), (79,)])
def test_merged_metrics_are_those_of_all_rows(spark, cuts):
    rows = pairs(spark, 5, range(80))
    state = None
    for low, high in zip((-1, *cuts), (*cuts, 99)):
        # Rows that were seen before come again and do not count.
        part = rows.where(F.col("date").between(F.lit(day(max(low - 3, -1))), F.lit(day(high))))
        state = metrics.metric_state(part, state, "y", "p")
        state = spark.createDataFrame(state.collect(), state.schema)
    got = {r.symbol: r[1:] for r in metrics.metrics_of(state).collect()}
    wanted = {r.symbol: r[1:] for r in metrics.model_metrics(rows, "y", "p").collect()}
    assert got.keys() == wanted.keys()
    for symbol, values in wanted.items():
        assert got[symbol] == tuple(None if v is None else pytest.approx(v, rel=1e-6) for v in values)
