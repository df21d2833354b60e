"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default: all), ``BENCH_QUERIES``
(comma list, default: the headline queries). Every query runs twice; ``queries`` holds the second
(warm) run, ``cold`` the first. Results go to Spark's ``noop`` sink, so every row is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "trade_messages_to_prices", "trade_normalize", "ticker_normalize", "trade_avg_price_5s",
    "trade_avg_price_1h_dense", "trade_total_value", "book_spread_pct_window", "book_bid_ask_window",
    "book_avg_spread_daily", "heatmap_view", "heatmap_normalized", "latest_row", "dedup_events",
    "symbol_universe_topk", "point_upsert", "line_protocol_trade", "archive_window_scan", "cyclic_time",
    "minmax_transform", "series_position_long", "split_ratio", "windows_index", "windows_30_10",
    "feature_samples", "metrics_by_symbol", "naive_backtest", "daily_backtest", "ridge_backtest", "ridge_training", "ridge_forecast",
    "stream_avg_price", "stream_archive_roundtrip",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from tidemark.session import SQL_SETTINGS, clear_scratch
    from tidemark.workload.catalog import QUERIES
    from tidemark.workload.samples import windows_of

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    for key, value in {
        **SQL_SETTINGS,
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    runs = dict(QUERIES)
    runs["windows_30_10"] = lambda s, d: windows_of(s, d, seq=30, pred=10)
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    def seconds(name: str) -> float:
        begun = time.perf_counter()
        runs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - begun, 3)

    cold, warm = {}, {}
    for name in names:
        cold[name] = seconds(name)
        warm[name] = seconds(name)
        print(f"{name:30s} cold {cold[name]:7.2f}  warm {warm[name]:7.2f}", file=sys.stderr, flush=True)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    replay = warm.get("stream_archive_roundtrip")
    print(json.dumps({
        "metric": "headline queries, warm total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "stream_replay_rows_per_sec": round(rows / replay) if replay else None,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
    }))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
