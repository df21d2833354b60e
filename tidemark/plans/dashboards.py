"""Dashboard panels and chart queries over the typed tables.

Time ranges, window lengths and "now" are parameters, so every query is deterministic. Windowed
panels accept streams unless they fill empty windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.quotes import notional, recency, spread, spread_percent, truncate
from tidemark.operators.selection import (
    last_interval, latest, limit_series, page, page_after, temporal_range,
)
from tidemark.operators.windows import aggregate_window
from tidemark.schemas import TABLE_SCHEMAS


def first_rows(df: DataFrame, row_limit: int | None, *order) -> DataFrame:
    """The first rows of a chart, all of them without a limit."""
    return df if row_limit is None else df.orderBy(*order).limit(row_limit)


# --- trades -----------------------------------------------------------------------------------


def average_trade_price(
    trades: DataFrame, every: str = "5 seconds", start=None, stop=None, fill_empty: bool = False
) -> DataFrame:
    aggs = {"avg_price": F.avg("price")}
    return aggregate_window(trades, "trade_time", every, ["symbol"], aggs, start, stop, fill_empty)


def total_transaction_value(trades: DataFrame, start=None, stop=None) -> DataFrame:
    ranged = temporal_range(trades, "trade_time", start, stop)
    return ranged.groupBy("symbol").agg(F.sum(notional()).alias("total_value"))


def value_by_maker(trades: DataFrame, start=None, stop=None, row_limit: int | None = None) -> DataFrame:
    ranged = temporal_range(trades, "trade_time", start, stop)
    totals = ranged.groupBy("is_market_maker").agg(F.sum(notional()).alias("total_value"))
    return first_rows(totals, row_limit, F.desc("total_value"), "is_market_maker")


def price_over_time(
    trades: DataFrame, now, interval: str = "7 days", grain: str | None = None,
    row_limit: int | None = None,
) -> DataFrame:
    """Average price per (trade time, symbol); with ``row_limit`` the first rows in time order."""
    recent = last_interval(trades, "trade_time", now, interval)
    time = F.col("trade_time") if grain is None else truncate(F.col("trade_time"), grain)
    averaged = recent.groupBy(time.alias("trade_time"), "symbol").agg(F.avg("price").alias("avg_price"))
    return first_rows(averaged, row_limit, "trade_time", "symbol")


# --- tickers ----------------------------------------------------------------------------------


def last_price_windows(
    tickers: DataFrame, every: str = "5 seconds", start=None, stop=None, fill_empty: bool = False
) -> DataFrame:
    aggs = {"last_price": F.avg("last_price")}
    return aggregate_window(tickers, "close_time", every, ["symbol"], aggs, start, stop, fill_empty)


def latest_trade_count(tickers: DataFrame, now, interval: str = "1 minute") -> DataFrame:
    recent = last_interval(tickers, "close_time", now, interval)
    return latest(recent, ["symbol"], "close_time", "last_trade_id", ["symbol", "close_time", "trade_count"])


def latest_quote_volume(tickers: DataFrame, now, interval: str = "5 minutes") -> DataFrame:
    recent = last_interval(tickers, "close_time", now, interval)
    return latest(recent, ["symbol"], "close_time", "last_trade_id", ["symbol", "close_time", "quote_volume"])


def peak_change(tickers: DataFrame, row_limit: int | None = None) -> DataFrame:
    peaks = tickers.groupBy("symbol").agg(
        F.max("price_change_percent").alias("latest_price_change_percent")
    )
    return first_rows(peaks, row_limit, F.desc("latest_price_change_percent"), "symbol")


# --- best bid and ask -------------------------------------------------------------------------


def bid_ask_windows(books: DataFrame, every: str, start=None, stop=None) -> DataFrame:
    """Mean of bid and ask per (symbol, field) and window with data.

    The averages are taken on the wide rows and unfolded afterwards: half the rows to aggregate.
    """
    fields = ["best_bid_price", "best_ask_price"]
    wide = aggregate_window(
        books, "event_time", every, ["symbol"], {f: F.avg(f) for f in fields}, start, stop
    )
    long = wide.unpivot(["symbol", "window_start", "window_end"], fields, "field", "value")
    return long.filter(F.col("value").isNotNull()).select(
        "symbol", "field", "window_start", "window_end", "value"
    )


def spread_percent_windows(books: DataFrame, every: str, start=None, stop=None) -> DataFrame:
    """Spread in percent of the mean bid, per window that has both sides.

    One aggregate with two averages; joining two aggregates of the same rows would read and
    shuffle them twice.
    """
    aggs = {"bid": F.avg("best_bid_price"), "ask": F.avg("best_ask_price")}
    both = aggregate_window(books, "event_time", every, ["symbol"], aggs, start, stop).filter(
        F.col("bid").isNotNull() & F.col("ask").isNotNull()
    )
    return both.select(
        "symbol", "window_start", "window_end",
        spread_percent(F.col("bid"), F.col("ask")).alias("spread_percentage"),
    )


def _newest_values(books: DataFrame, now, interval: str, fields: dict[str, str]) -> DataFrame:
    """Last value of each field per symbol, one hash aggregate over the wide rows."""
    recent = last_interval(books, "event_time", now, interval)
    order = recency("event_time", "update_id")
    return recent.groupBy("symbol").agg(
        F.max("event_time").alias("event_time"),
        *[
            F.max_by(column, F.when(F.col(column).isNotNull(), order)).alias(name)
            for name, column in fields.items()
        ],
    )


def latest_spread(books: DataFrame, now, interval: str = "1 minute") -> DataFrame:
    """Spread in percent of the last bid and last ask of each symbol."""
    sides = _newest_values(books, now, interval, {"bid": "best_bid_price", "ask": "best_ask_price"})
    both = sides.filter(F.col("bid").isNotNull() & F.col("ask").isNotNull())
    return both.select(
        "symbol", "event_time", spread_percent(F.col("bid"), F.col("ask")).alias("spread_percentage")
    )


def latest_depth(books: DataFrame, now, interval: str = "5 minutes") -> DataFrame:
    """Last bid and ask quantity per (symbol, field)."""
    fields = ["best_bid_qty", "best_ask_qty"]
    newest = _newest_values(books, now, interval, {f: f for f in fields})
    long = newest.select("symbol", *fields).unpivot(["symbol"], fields, "field", "value")
    return long.filter(F.col("value").isNotNull())


def average_spread(
    books: DataFrame, grain: str = "P1D", lo=None, hi=None,
    series_limit: int | None = None, row_limit: int | None = None,
) -> DataFrame:
    """Average ask - bid per time grain and symbol; with ``series_limit`` of the symbols with the widest spread."""
    metric = F.avg(spread(F.col("best_bid_price"), F.col("best_ask_price")))
    ranged = temporal_range(books, "event_time", lo, hi)
    chosen = limit_series(ranged, "symbol", metric, series_limit)
    averaged = chosen.groupBy(truncate(F.col("event_time"), grain).alias("event_time"), "symbol").agg(
        metric.alias("avg_spread")
    )
    return first_rows(averaged, row_limit, F.desc("avg_spread"), "event_time", "symbol")


# --- predictions ------------------------------------------------------------------------------


def prediction_windows(
    predictions: DataFrame, fields: Sequence[str], every: str, start=None, stop=None
) -> DataFrame:
    """Mean per (symbol, field) and window with data, for any predicted fields."""
    aggs = {f: F.avg(f) for f in fields}
    wide = aggregate_window(predictions, "event_time", every, ["symbol"], aggs, start, stop)
    long = wide.select(
        "symbol", "window_start", "window_end", *[F.col(f).cast("double").alias(f) for f in fields]
    ).unpivot(["symbol", "window_start", "window_end"], list(fields), "field", "value")
    return long.filter(F.col("value").isNotNull()).select(
        "symbol", "field", "window_start", "window_end", "value"
    )


def predicted_price_windows(predictions: DataFrame, every: str, start=None, stop=None) -> DataFrame:
    return prediction_windows(predictions, ["last_price"], every, start, stop)


def predicted_bid_ask_windows(predictions: DataFrame, every: str, start=None, stop=None) -> DataFrame:
    return prediction_windows(predictions, ["best_bid_price", "best_ask_price"], every, start, stop)


def predicted_trade_count_windows(predictions: DataFrame, every: str, start=None, stop=None) -> DataFrame:
    return prediction_windows(predictions, ["trade_count"], every, start, stop)


def prediction_page(
    predictions: DataFrame, size: int = 10, offset: int = 0, lo=None, hi=None, after: Sequence | None = None
) -> DataFrame:
    """One page in the order of all columns; ``after``, the last row of the page before, finds deep pages
    without sorting what lies before them."""
    columns = T.StructType.fromDDL(TABLE_SCHEMAS["ticker_predict"]).names
    ranged = temporal_range(predictions, "event_time", lo, hi).select(*columns)
    return page_after(ranged, columns, size, after) if after is not None else page(ranged, columns, size, offset)


