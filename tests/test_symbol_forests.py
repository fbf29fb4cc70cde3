"""A forest of every symbol in one fit, against brute force on its splits."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import day
from tickloom.operators import forests, symbol_forests
from tickloom.plans.queries import QUERIES
from tickloom.schemas import MODEL_FEATURES


def training(spark, symbols, length=90):
    rng, rows = random.Random(3), []
    for s in symbols:
        for n in range(length):
            inputs = [rng.choice([1.0, 2.0, rng.uniform(0, 9)]) for _ in MODEL_FEATURES]
            rows.append((s, day(n), *inputs, sum(inputs) + round(rng.uniform(0, 1), 1)))
    names = ", ".join(f"{c} double" for c in (*MODEL_FEATURES, "target"))
    return spark.createDataFrame(rows, f"symbol string, date date, {names}")


def squared_error(target, weight):
    return (weight * (target - np.average(target, weights=weight)) ** 2).sum()


@pytest.mark.parametrize("at_once", [symbol_forests.DRAWN, 60])
def test_every_split_is_the_best_and_trees_grow_to_the_end(monkeypatch, at_once):
    monkeypatch.setattr(symbol_forests, "DRAWN", at_once)
    rng = np.random.default_rng(1)
    inputs = np.column_stack([rng.integers(0, 5, 40), np.ones(40), rng.normal(size=(40, 2))])
    inputs[:3] = inputs[0]  # equal inputs, whatever their targets, cannot be told apart
    target = rng.normal(size=40).round(1)
    seen = []
    inner = symbol_forests._grow_together

    def kept(ranks, values, sorted_target, drawn, depth):
        seen.append(drawn)
        return inner(ranks, values, sorted_target, drawn, depth)

    monkeypatch.setattr(symbol_forests, "_grow_together", kept)
    grown = symbol_forests.grow(inputs, target, 6, None, 42, "A")
    drawn = np.concatenate(seen)
    assert (drawn.sum(axis=1) == 40).all() and len({tuple(d) for d in drawn}) == 6
    order = np.lexsort((target, *inputs.T))
    inputs, target, forest = inputs[order], target[order], grown.forest()

    def checked(node, weight, depth=0):
        rows = np.flatnonzero(weight)
        x, y, w = inputs[rows], target[rows], weight[rows]
        errors = [
            squared_error(y[go], w[go]) + squared_error(y[~go], w[~go])
            for column in x.T for cut in np.unique(column)[:-1] for go in [column <= cut]
        ]
        f = forest.feature[node]
        if f < 0:
            assert len(set(y)) == 1 or not errors
            assert forest.prediction[node] == pytest.approx(np.average(y, weights=w))
            return depth
        go = inputs[:, f] <= forest.threshold[node]
        left, right = np.where(go, weight, 0), np.where(go, 0, weight)
        got = sum(squared_error(target[p > 0], p[p > 0]) for p in (left, right))
        assert got == pytest.approx(min(errors))
        return max(checked(forest.left[node], left, depth + 1), checked(forest.right[node], right, depth + 1))

    assert max(checked(root, w.astype(float)) for root, w in zip(forest.roots, drawn)) >= 6
    assert len(forest.roots) == 6


def test_depth_stops_trees():
    rng = np.random.default_rng(1)
    grown = symbol_forests.grow(rng.normal(size=(50, 2)), rng.normal(size=50), 3, 2, 1, "A")
    assert np.diff([*grown.roots, len(grown.feature)]).max() <= 7
    single = symbol_forests.grow(np.ones((1, 2)), np.ones(1), 3, None, 1, None)
    assert single.value.tolist() == [1.0] * 3


def forecasts(frame):
    return {(r.symbol, r.date): r.predicted_price for r in frame.collect()}


def test_every_symbol_has_its_own_forest(spark, tmp_path):
    """Before, one forest of ten levels was all that symbols had between them."""
    rows = training(spark, "ABC").cache()
    model = forests.fit_pooled(rows, trees=20)
    forests.save_model(model, str(tmp_path))
    stored = forests.load_model(spark, str(tmp_path))
    trees = stored.rows.groupBy("symbol").count().collect()
    assert {r[0]: r[1] for r in trees} == {"A": 20, "B": 20, "C": 20}
    asked = rows.unionByName(rows.where("symbol = 'A'").withColumn("symbol", F.lit("NEW")))
    got = forecasts(forests.score(stored, asked))
    assert got == forecasts(forests.score(model, asked)) and len(got) == 360
    assert {v for k, v in got.items() if k[0] == "NEW"} == {None}
    # The rows of other symbols do not matter.
    alone = forests.fit_pooled(rows.where("symbol = 'B'").repartition(5), trees=20)
    wanted = {k: v for k, v in got.items() if k[0] == "B"}
    assert forecasts(forests.score(alone, rows.where("symbol = 'B'"))) == wanted
    error = [abs(got[r.symbol, r.date] - r.target) for r in rows.collect()]
    assert np.mean(error) < 2


def test_train_models_has_a_hundred_trees_a_symbol(spark, folder):
    row = QUERIES["train_models"](spark, folder).first()
    symbols = QUERIES["holdout_metrics"](spark, folder).count()
    assert row.trees == 100 * symbols and symbols > 1
    # About two nodes for each drawn row, of which there are 0.63 for a row.
    assert row.nodes > 100 * row.training_rows
