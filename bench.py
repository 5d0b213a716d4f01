"""Headline queries: one warm-up, then the median of several runs, as one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from marketlens.catalog import QUERIES
from marketlens.session import build_session

HEADLINE = (
    "price_trend",
    "stg_trades",
    "stg_weather_dedup",
    "dim_item",
    "fact_weather_daily",
    "mart_price_weather",
    "price_movement",
    "mart_seasonal",
    "fact_predictions",
    "mart_dashboard",
    "content_score",
    "outlier_filter",
    "forecast_trend_seasonal",
    "training_features",
)
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(1 + RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    scale = os.path.basename(os.path.normpath(folder)).removeprefix("sf")
    print(json.dumps({"metric": "total_median_seconds", "value": total, "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()
