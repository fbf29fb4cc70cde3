"""What a query reads more than once is computed once: its readers see a written table."""

import pytest

from tickloom.plans import jobs, queries


class Seen(Exception):
    pass


def raw(rows):
    """Whether the given tables would be read again."""
    return any("lineitem" in file for file in rows.inputFiles())


@pytest.mark.parametrize("name", ["sink_features", "sink_predictions"])
def test_both_batches_come_from_stored_rows(spark, folder, monkeypatch, name):
    def look(session, first, second, table, unique=True):
        assert not raw(first) and not raw(second)
        raise Seen

    monkeypatch.setattr(queries, "stored_twice", look)
    with pytest.raises(Seen):
        queries.QUERIES[name](spark, folder)


def test_both_bucketed_tables_come_from_stored_prices(spark, folder, monkeypatch):
    batches = []
    monkeypatch.setattr(queries, "insert_bucketed", lambda s, batch, *rest, **more: batches.append(batch))
    monkeypatch.setattr(queries, "open_bucketed", lambda *args: (_ for _ in ()).throw(Seen))
    with pytest.raises(Seen):
        queries.QUERIES["bucketed_join"](spark, folder)
    assert len(batches) == 2 and not any(raw(b) for b in batches)


def test_the_split_reads_stored_rows(spark, folder, monkeypatch):
    def look(rows):
        assert not raw(rows) and all("training-rows" in f for f in rows.inputFiles())
        raise Seen

    monkeypatch.setattr(queries.fc, "with_split", look)
    for run in (queries.QUERIES["holdout_metrics_of_mean"], queries.split_training):
        with pytest.raises(Seen):
            run(spark, folder)


def test_forests_are_made_once(spark, folder, monkeypatch):
    def look(nodes, features, **more):
        assert not raw(nodes)
        raise Seen

    monkeypatch.setattr(queries.forest_tables, "score_own", look)
    with pytest.raises(Seen):
        queries.QUERIES["predict_per_symbol"](spark, folder)


def test_forecasts_are_made_once(spark, tmp_path, price_rows, monkeypatch):
    def look(scored, alignment):
        assert scored.inputFiles() and all("scored" in f for f in scored.inputFiles())
        raise Seen

    config = jobs.Config(warehouse=str(tmp_path), models="", baseline="ma_10_day")
    prices = price_rows(range(1, 60)).selectExpr("symbol", "'n' AS name", "date", "current_price", "current_price AS open_price")
    config.insert(spark, prices, "stock_prices")
    jobs.run_features(spark, config)
    monkeypatch.setattr(jobs, "align_forecasts", look)
    with pytest.raises(Seen):
        jobs.run_predict(spark, config)
