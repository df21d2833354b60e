"""Warehouse views over the ticker table and the charts that read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.scaling import minmax_scale
from tidemark.operators.selection import latest, temporal_range
from tidemark.plans.dashboards import first_rows
from tidemark.session import settle


def heatmap_ticker(tickers: DataFrame) -> DataFrame:
    """Newest row per symbol by close time, with a constant row key for the heat map."""
    columns = ["symbol", "close_time", "price_change_percent", "quote_volume"]
    newest = latest(tickers, ["symbol"], "close_time", "last_trade_id", columns)
    return newest.withColumn("constant", F.lit("all"))


def scatter_plot_ticker(tickers: DataFrame) -> DataFrame:
    """Newest row per symbol by event time."""
    columns = [
        "event_time", "symbol", "price_change_percent", "quote_volume", "trade_count", "last_price",
    ]
    return latest(tickers, ["symbol"], "event_time", "last_trade_id", columns)


def heatmap_metric(heatmap: DataFrame, lo=None, hi=None, row_limit: int | None = None) -> DataFrame:
    """Average change per cell (symbol, constant); with ``row_limit`` the first in alphabetical order."""
    cells = temporal_range(heatmap, "close_time", lo, hi).groupBy("symbol", "constant").agg(
        F.avg("price_change_percent").alias("avg_change")
    )
    return first_rows(cells, row_limit, "symbol", "constant")


def heatmap_normalized(heatmap: DataFrame, lo=None, hi=None, row_limit: int | None = None) -> DataFrame:
    """Cell values scaled to [0, 1] across the whole heat map, whatever the limit; 0.0 if all are equal.

    The combined cells are written once (an action) and both their limits and the rows are read from there; the
    limits are scalar subqueries, so no task holds all cells.
    """
    value = F.col("avg_change")
    cells = settle(heatmap_metric(heatmap, lo, hi))
    low, high = (cells.select(edge(value)).scalar() for edge in (F.min, F.max))
    scaled = cells.withColumn("normalized", minmax_scale(value, low, high))
    return first_rows(scaled, row_limit, "symbol", "constant")


def scatter_metric(scatter: DataFrame, lo=None, hi=None, row_limit: int | None = None) -> DataFrame:
    """Largest change per (change, symbol) of the scatter view; with ``row_limit`` the largest ones."""
    ranged = temporal_range(scatter, "event_time", lo, hi)
    points = ranged.groupBy("price_change_percent", "symbol").agg(
        F.max("price_change_percent").alias("max_change")
    )
    return first_rows(points, row_limit, F.desc("max_change"), "symbol")


def register_views(spark, tickers: DataFrame) -> None:
    """Make both views queryable by name."""
    heatmap_ticker(tickers).createOrReplaceTempView("heatmap_ticker")
    scatter_plot_ticker(tickers).createOrReplaceTempView("scatter_plot_ticker")
