"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query runs
once to warm up and then ``BENCH_RUNS`` times; the best run counts. A run builds the
plan and computes every row and column of the result.
"""

from __future__ import annotations

import json
import os
import time

from tickloom.plans.queries import QUERIES
from tickloom.session import build_session

HEADLINE = (
    "features",
    "ema_10",
    "ma_30_day",
    "volatility_30_day",
    "percent_change",
    "cumulative_return",
    "clean_prices",
    "unpivot_prices",
    "quote_extract",
    "page_extract",
    "history_then_current",
    "insert_if_absent",
    "model_metrics",
    "residual_outliers",
    "train_test_split",
    "training_frame",
    "features_left_predictions",
    "head_drop",
    "sink_prices",
    "holdout_metrics",
)


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    rows = QUERIES[name](spark, folder)
    rows.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        seconds(spark, name, folder)
        times[name] = round(min(seconds(spark, name, folder) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
