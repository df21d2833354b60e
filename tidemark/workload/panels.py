"""Queries of the dashboards, views and selection operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.quotes import notional, spread, spread_percent, truncate
from tidemark.operators import selection as sel
from tidemark.operators.cleaning import normalize_trade
from tidemark.operators.windows import aggregate_window
from tidemark.plans import dashboards as d, views as v
from tidemark.workload import frames as fr
from tidemark.workload.registry import query

START, STOP, NOW = "2024-01-01", "2024-01-31", "2024-01-31 00:00:00"


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _windowed(cte, table, time, every, aggs):
    return (
        f"WITH {cte} SELECT symbol, time_bucket(INTERVAL {every}, {time}) AS window_start, "
        f"time_bucket(INTERVAL {every}, {time}) + INTERVAL {every} AS window_end, {aggs} "
        f"FROM {table} GROUP BY ALL"
    )


@query(
    "trade_avg_price_5s",
    _windowed(fr.trade_sql(), "trade", "trade_time", "5 SECOND", "ROUND(AVG(price), 6) AS avg_price"),
)
def trade_avg_price_5s(spark, sf_dir):
    return _rounded(d.average_trade_price(fr.trades(spark, sf_dir)), "avg_price")


def _dense(cte, table, time, column, name, every="1 HOUR"):
    return f"""WITH {cte}, w AS (SELECT symbol, time_bucket(INTERVAL {every}, {time}) AS window_start,
    AVG({column}) AS v FROM {table} WHERE {time} >= TIMESTAMP '{START}' AND {time} < TIMESTAMP '{STOP}'
    GROUP BY ALL), s AS (SELECT DISTINCT symbol FROM w), spine AS (SELECT symbol, h AS window_start FROM s,
    generate_series(TIMESTAMP '{START}', TIMESTAMP '{STOP}' - INTERVAL {every}, INTERVAL {every}) g(h))
    SELECT symbol, window_start, window_start + INTERVAL {every} AS window_end, ROUND(v, 6) AS {name}
    FROM spine LEFT JOIN w USING (symbol, window_start)"""


@query("trade_avg_price_1h_dense", _dense(fr.trade_sql(), "trade", "trade_time", "price", "avg_price"))
def trade_avg_price_1h_dense(spark, sf_dir):
    panel = d.average_trade_price(fr.trades(spark, sf_dir), "1 hour", START, STOP, fill_empty=True)
    return _rounded(panel, "avg_price")


@query(
    "trade_avg_price_1m_dense", _dense(fr.trade_sql(), "trade", "trade_time", "price", "avg_price", "1 MINUTE"))
def trade_avg_price_1m_dense(spark, sf_dir):
    panel = d.average_trade_price(fr.trades(spark, sf_dir), "1 minute", START, STOP, fill_empty=True)
    return _rounded(panel, "avg_price")


@query(
    "trade_avg_price_users_dense",
    _dense(fr.trade_sql("user_id"), "trade", "trade_time", "price", "avg_price"),
)
def trade_avg_price_users_dense(spark, sf_dir):
    panel = d.average_trade_price(fr.trades(spark, sf_dir, "user_id"), "1 hour", START, STOP, fill_empty=True)
    return _rounded(panel, "avg_price")


@query(
    "window_aggregates",
    _windowed(
        fr.trade_sql(), "trade", "trade_time", "1 DAY",
        "COUNT(*) AS n, MIN(price) AS low, MAX(price) AS high, ROUND(SUM(price * quantity), 2) AS total, "
        "min_by(price, trade_time) AS first, max_by(price, trade_time) AS last",
    ),
)
def window_aggregates(spark, sf_dir):
    aggs = {
        "n": F.count(F.lit(1)), "low": F.min("price"), "high": F.max("price"),
        "total": F.round(F.sum(notional()), 2),
        "first": F.min_by("price", "trade_time"), "last": F.max_by("price", "trade_time"),
    }
    return aggregate_window(fr.trades(spark, sf_dir), "trade_time", "1 day", ["symbol"], aggs)


@query(
    "trade_total_value",
    f"WITH {fr.trade_sql()} SELECT symbol, ROUND(SUM(price * quantity), 2) AS total_value FROM trade GROUP BY symbol",
)
def trade_total_value(spark, sf_dir):
    return _rounded(d.total_transaction_value(fr.trades(spark, sf_dir)), "total_value", digits=2)


@query(
    "trade_notional",
    f"WITH {fr.trade_sql()} SELECT trade_id, symbol, ROUND(price * quantity, 4) AS value FROM trade",
)
def trade_notional(spark, sf_dir):
    return fr.trades(spark, sf_dir).select("trade_id", "symbol", F.round(notional(), 4).alias("value"))


@query(
    "value_by_maker",
    f"""WITH {fr.trade_sql()} SELECT is_market_maker, ROUND(SUM(price * quantity), 2) AS total_value
    FROM trade GROUP BY is_market_maker""",
)
def value_by_maker(spark, sf_dir):
    return _rounded(d.value_by_maker(fr.trades(spark, sf_dir)), "total_value", digits=2)


@query(
    "price_over_time_7d",
    f"""WITH {fr.trade_sql()} SELECT trade_time, symbol, ROUND(AVG(price), 6) AS avg_price FROM trade
    WHERE trade_time >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY AND trade_time <= TIMESTAMP '{NOW}'
    GROUP BY trade_time, symbol""",
)
def price_over_time_7d(spark, sf_dir):
    return _rounded(d.price_over_time(fr.trades(spark, sf_dir), NOW), "avg_price")


@query(
    "ticker_last_price_window",
    _windowed(fr.ticker_sql(), "ticker", "close_time", "5 SECOND", "ROUND(AVG(last_price), 6) AS last_price"),
)
def ticker_last_price_window(spark, sf_dir):
    return _rounded(d.last_price_windows(fr.tickers(spark, sf_dir)), "last_price")


@query("ticker_last_price_dense", _dense(fr.ticker_sql(), "ticker", "close_time", "last_price", "last_price"))
def ticker_last_price_dense(spark, sf_dir):
    panel = d.last_price_windows(fr.tickers(spark, sf_dir), "1 hour", START, STOP, fill_empty=True)
    return _rounded(panel, "last_price")


_RECENT = f"close_time >= TIMESTAMP '{NOW}' - INTERVAL 1 DAY AND close_time <= TIMESTAMP '{NOW}'"


def _latest_sql(column):
    return f"""WITH {fr.ticker_sql('user_id')} SELECT symbol, close_time, {column} FROM ticker WHERE {_RECENT}
    QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY close_time DESC, last_trade_id DESC) = 1"""


@query("ticker_trade_count_latest", _latest_sql("trade_count"))
def ticker_trade_count_latest(spark, sf_dir):
    return d.latest_trade_count(fr.tickers(spark, sf_dir, "user_id"), NOW, "1 day")


@query("ticker_quote_volume_latest", _latest_sql("quote_volume"))
def ticker_quote_volume_latest(spark, sf_dir):
    return d.latest_quote_volume(fr.tickers(spark, sf_dir, "user_id"), NOW, "1 day")


@query(
    "latest_row",
    f"""WITH {fr.ticker_sql('user_id')} SELECT * FROM ticker
    QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY close_time DESC, last_trade_id DESC) = 1""",
)
def latest_row(spark, sf_dir):
    return sel.latest(fr.tickers(spark, sf_dir, "user_id"), ["symbol"], "close_time", "last_trade_id")


def _nulls_sql(form):
    return f"""SELECT symbol, close_time, tie, '{form}' AS form FROM t
    QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY close_time DESC NULLS LAST, tie DESC NULLS LAST) = 1"""


@query(
    "latest_row_nulls",
    f"""WITH {fr.ticker_sql('user_id')}, t AS (SELECT symbol,
    CASE WHEN last_trade_id % 5 <> 0 THEN date_trunc('week', close_time)::TIMESTAMP END AS close_time,
    CASE WHEN last_trade_id % 3 <> 0 THEN last_trade_id END AS tie FROM ticker)
    {_nulls_sql('narrow')} UNION ALL {_nulls_sql('text')}""",
)
def latest_row_nulls(spark, sf_dir):
    """Equal and missing times and ties give the same row whatever the types of the other columns."""
    identity = F.col("last_trade_id")
    rows = fr.tickers(spark, sf_dir, "user_id").select(
        "symbol", F.when(identity % 5 != 0, F.date_trunc("week", "close_time")).alias("close_time"),
        F.when(identity % 3 != 0, identity).alias("tie"))
    narrow = sel.latest(rows, ["symbol"], "close_time", "tie").withColumn("form", F.lit("narrow"))
    text = sel.latest(rows.withColumn("form", F.lit("text")), ["symbol"], "close_time", "tie")
    return narrow.unionByName(text)


@query(
    "peak_change",
    f"""WITH {fr.ticker_sql('user_id')} SELECT symbol, MAX(price_change_percent) AS latest_price_change_percent
    FROM ticker GROUP BY symbol""",
)
def peak_change(spark, sf_dir):
    return d.peak_change(fr.tickers(spark, sf_dir, "user_id"))


@query(
    "book_bid_ask_window",
    f"""WITH {fr.book_sql()}, w AS (SELECT symbol, time_bucket(INTERVAL 1 HOUR, event_time) AS window_start,
    AVG(best_bid_price) AS bid, AVG(best_ask_price) AS ask FROM book GROUP BY ALL)
    SELECT symbol, 'best_bid_price' AS field, window_start, window_start + INTERVAL 1 HOUR AS window_end,
    ROUND(bid, 8) AS value FROM w UNION ALL
    SELECT symbol, 'best_ask_price', window_start, window_start + INTERVAL 1 HOUR, ROUND(ask, 8) FROM w""",
)
def book_bid_ask_window(spark, sf_dir):
    return _rounded(d.bid_ask_windows(fr.books(spark, sf_dir), "1 hour"), "value", digits=8)


@query(
    "book_spread_pct_window",
    f"""WITH {fr.book_sql()}, bid AS (SELECT symbol, time_bucket(INTERVAL 1 HOUR, event_time) AS window_start,
    AVG(best_bid_price) AS b FROM book GROUP BY ALL), ask AS (SELECT symbol,
    time_bucket(INTERVAL 1 HOUR, event_time) AS window_start, AVG(best_ask_price) AS a FROM book GROUP BY ALL)
    SELECT symbol, window_start, window_start + INTERVAL 1 HOUR AS window_end,
    ROUND((a - b) / b * 100.0, 6) AS spread_percentage FROM bid JOIN ask USING (symbol, window_start)""",
)
def book_spread_pct_window(spark, sf_dir):
    return _rounded(d.spread_percent_windows(fr.books(spark, sf_dir), "1 hour"), "spread_percentage")


_RECENT_BOOK = f"event_time >= TIMESTAMP '{NOW}' - INTERVAL 1 DAY AND event_time <= TIMESTAMP '{NOW}'"


@query(
    "book_spread_latest",
    f"""WITH {fr.book_sql('user_id')} SELECT symbol, MAX(event_time) AS event_time,
    ROUND((max_by(best_ask_price, event_time) - max_by(best_bid_price, event_time))
    / max_by(best_bid_price, event_time) * 100.0, 6) AS spread_percentage FROM book
    WHERE {_RECENT_BOOK} GROUP BY symbol""",
)
def book_spread_latest(spark, sf_dir):
    return _rounded(d.latest_spread(fr.books(spark, sf_dir, "user_id"), NOW, "1 day"), "spread_percentage")


@query(
    "book_depth_latest",
    f"""WITH {fr.book_sql('user_id')} SELECT symbol, 'best_bid_qty' AS field,
    max_by(best_bid_qty, event_time) AS value FROM book WHERE {_RECENT_BOOK} GROUP BY symbol UNION ALL
    SELECT symbol, 'best_ask_qty', max_by(best_ask_qty, event_time) FROM book WHERE {_RECENT_BOOK}
    GROUP BY symbol""",
)
def book_depth_latest(spark, sf_dir):
    return d.latest_depth(fr.books(spark, sf_dir, "user_id"), NOW, "1 day")


_TOP_SPREAD = """top AS (SELECT symbol FROM book GROUP BY symbol
    ORDER BY AVG(best_ask_price - best_bid_price) DESC, symbol LIMIT 10)"""


@query(
    "book_avg_spread_daily",
    f"""WITH {fr.book_sql('user_id')}, {_TOP_SPREAD} SELECT date_trunc('day', event_time)::TIMESTAMP AS event_time,
    symbol, ROUND(AVG(best_ask_price - best_bid_price), 6) AS avg_spread FROM book
    WHERE symbol IN (SELECT symbol FROM top) GROUP BY ALL""",
)
def book_avg_spread_daily(spark, sf_dir):
    return _rounded(d.average_spread(fr.books(spark, sf_dir, "user_id"), series_limit=10), "avg_spread")


@query(
    "series_limit",
    f"""WITH {fr.book_sql('user_id')}, {_TOP_SPREAD} SELECT * FROM book
    WHERE symbol IN (SELECT symbol FROM top) ORDER BY event_time, update_id LIMIT 1000""",
)
def series_limit(spark, sf_dir):
    metric = F.avg(spread(F.col("best_bid_price"), F.col("best_ask_price")))
    order = [F.col("event_time"), F.col("update_id")]
    return sel.limit_series(fr.books(spark, sf_dir, "user_id"), "symbol", metric, 10, 1000, order)


@query(
    "spread_columns",
    f"""WITH {fr.book_sql()} SELECT update_id, ROUND(best_ask_price - best_bid_price, 6) AS spread,
    ROUND((best_ask_price - best_bid_price) / best_bid_price * 100.0, 6) AS spread_pct,
    date_trunc('second', event_time) AS second FROM book""",
)
def spread_columns(spark, sf_dir):
    bid, ask = F.col("best_bid_price"), F.col("best_ask_price")
    return fr.books(spark, sf_dir).select(
        "update_id",
        F.round(spread(bid, ask), 6).alias("spread"),
        F.round(spread_percent(bid, ask), 6).alias("spread_pct"),
        truncate(F.col("event_time"), "PT1S").alias("second"),
    )


_HEATMAP = f"""heat AS (SELECT symbol, close_time, price_change_percent, quote_volume, 'all' AS constant
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY close_time DESC) AS rn FROM ticker)
    WHERE rn = 1)"""
_SCATTER = """scatter AS (SELECT event_time, symbol, price_change_percent, quote_volume, trade_count, last_price
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY event_time DESC) AS rn FROM ticker)
    WHERE rn = 1)"""
_USERS = fr.ticker_sql("user_id")


@query("heatmap_view", f"WITH {_USERS}, {_HEATMAP} SELECT * FROM heat")
def heatmap_view(spark, sf_dir):
    return v.heatmap_ticker(fr.tickers(spark, sf_dir, "user_id"))


@query(
    "heatmap_metric",
    f"WITH {_USERS}, {_HEATMAP} SELECT symbol, constant, AVG(price_change_percent) AS avg_change FROM heat GROUP BY ALL",
)
def heatmap_metric(spark, sf_dir):
    return v.heatmap_metric(v.heatmap_ticker(fr.tickers(spark, sf_dir, "user_id")))


@query(
    "heatmap_normalized",
    f"""WITH {_USERS}, {_HEATMAP}, c AS (SELECT symbol, constant, AVG(price_change_percent) AS avg_change
    FROM heat GROUP BY ALL) SELECT symbol, constant, avg_change, ROUND((avg_change - MIN(avg_change) OVER ()) /
    (MAX(avg_change) OVER () - MIN(avg_change) OVER ()), 6) AS normalized FROM c""",
)
def heatmap_normalized(spark, sf_dir):
    heat = v.heatmap_ticker(fr.tickers(spark, sf_dir, "user_id"))
    return _rounded(v.heatmap_normalized(heat), "normalized")


@query("scatter_view", f"WITH {_USERS}, {_SCATTER} SELECT * FROM scatter")
def scatter_view(spark, sf_dir):
    return v.scatter_plot_ticker(fr.tickers(spark, sf_dir, "user_id"))


@query(
    "scatter_metric",
    f"""WITH {_USERS}, {_SCATTER} SELECT price_change_percent, symbol, MAX(price_change_percent) AS max_change
    FROM scatter GROUP BY ALL""",
)
def scatter_metric(spark, sf_dir):
    return v.scatter_metric(v.scatter_plot_ticker(fr.tickers(spark, sf_dir, "user_id")))


def _predicted_sql(fields, every="1 HOUR"):
    return " UNION ALL ".join(
        f"""SELECT symbol, '{f}' AS field, time_bucket(INTERVAL {every}, event_time) AS window_start,
        time_bucket(INTERVAL {every}, event_time) + INTERVAL {every} AS window_end,
        ROUND(AVG({f}), 8) AS value FROM ticker GROUP BY ALL"""
        for f in fields
    )


@query("predict_price_window", f"WITH {fr.ticker_sql()} {_predicted_sql(['last_price'])}")
def predict_price_window(spark, sf_dir):
    return _rounded(d.predicted_price_windows(fr.predictions(spark, sf_dir), "1 hour"), "value", digits=8)


@query(
    "predict_bid_ask_window",
    f"WITH {fr.ticker_sql()} {_predicted_sql(['best_bid_price', 'best_ask_price'])}",
)
def predict_bid_ask_window(spark, sf_dir):
    return _rounded(d.predicted_bid_ask_windows(fr.predictions(spark, sf_dir), "1 hour"), "value", digits=8)


@query("predict_trade_count_window", f"WITH {fr.ticker_sql()} {_predicted_sql(['trade_count'])}")
def predict_trade_count_window(spark, sf_dir):
    return _rounded(d.predicted_trade_count_windows(fr.predictions(spark, sf_dir), "1 hour"), "value", digits=8)


@query(
    "prediction_page",
    f"""WITH {fr.ticker_sql()} SELECT event_time, symbol, last_price, best_bid_price, best_ask_price, trade_count
    FROM ticker ORDER BY event_time, symbol LIMIT 10 OFFSET 20""",
)
def prediction_page(spark, sf_dir):
    return d.prediction_page(fr.predictions(spark, sf_dir), 10, 20)


@query(
    "time_range",
    f"""WITH {fr.trade_sql()} SELECT * FROM trade WHERE trade_time >= TIMESTAMP '2024-01-10'
    AND trade_time < TIMESTAMP '2024-01-12 06:30:00'""",
)
def time_range(spark, sf_dir):
    return sel.time_range(fr.trades(spark, sf_dir), "trade_time", "2024-01-10", "2024-01-12 06:30:00")


@query(
    "trailing_range",
    f"""WITH {fr.trade_sql()} SELECT * FROM trade WHERE trade_time >= TIMESTAMP '{NOW}' - INTERVAL 5 HOUR
    AND trade_time <= TIMESTAMP '{NOW}'""",
)
def trailing_range(spark, sf_dir):
    return sel.last_interval(fr.trades(spark, sf_dir), "trade_time", NOW, "5 hours")


@query(
    "temporal_range",
    f"WITH {fr.trade_sql()} SELECT * FROM trade WHERE trade_time >= TIMESTAMP '2024-01-29'",
)
def temporal_range(spark, sf_dir):
    return sel.temporal_range(fr.trades(spark, sf_dir), "trade_time", lo="2024-01-29")


@query("for_symbol", f"WITH {fr.trade_sql()} SELECT * FROM trade WHERE symbol = 'click'")
def for_symbol(spark, sf_dir):
    return sel.for_symbol(fr.trades(spark, sf_dir), "click")


@query("distinct_symbols", f"WITH {fr.trade_sql('user_id')} SELECT DISTINCT symbol FROM trade")
def distinct_symbols(spark, sf_dir):
    return sel.distinct_symbols(fr.trades(spark, sf_dir, "user_id"))


@query("chronological", f"WITH {fr.trade_sql()} SELECT symbol, trade_time, trade_id, price FROM trade")
def chronological(spark, sf_dir):
    rows = fr.trades(spark, sf_dir).select("symbol", "trade_time", "trade_id", "price")
    return sel.chronological(rows, "trade_time", ["trade_id"])


@query(
    "dedup_events",
    f"""WITH {fr.trade_sql()}, h AS (SELECT symbol, date_trunc('hour', trade_time) AS event_time, price, trade_id
    FROM trade) SELECT symbol, event_time, price, trade_id FROM h
    QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol, event_time ORDER BY price, trade_id) = 1""",
)
def dedup_events(spark, sf_dir):
    hourly = fr.trades(spark, sf_dir).select(
        "symbol", F.date_trunc("hour", "trade_time").alias("event_time"), "price", "trade_id"
    )
    return sel.dedup(hourly)


@query(
    "union_by_name",
    f"""WITH {fr.trade_sql()} SELECT symbol, trade_id, price, CAST(NULL AS DOUBLE) AS quantity FROM trade
    WHERE is_market_maker UNION ALL SELECT symbol, trade_id, price, quantity FROM trade WHERE NOT is_market_maker""",
)
def union_by_name(spark, sf_dir):
    rows = fr.trades(spark, sf_dir)
    maker = rows.filter("is_market_maker").select("symbol", "trade_id", "price")
    taker = rows.filter("not is_market_maker").select("quantity", "price", "trade_id", "symbol")
    return sel.union_all([maker, taker]).select("symbol", "trade_id", "price", "quantity")


_PAIRS = "SELECT symbol, price FROM trade"


@query(
    "subtract_rows",
    f"WITH {fr.trade_sql()} {_PAIRS} WHERE is_market_maker EXCEPT {_PAIRS} WHERE NOT is_market_maker",
)
def subtract_rows(spark, sf_dir):
    rows = fr.trades(spark, sf_dir)
    maker = rows.filter("is_market_maker").select("symbol", "price")
    taker = rows.filter("not is_market_maker").select("symbol", "price")
    return sel.subtract_rows(maker, taker)


@query(
    "subtract_rows_all",
    f"WITH {fr.trade_sql()} {_PAIRS} WHERE is_market_maker EXCEPT ALL {_PAIRS} WHERE NOT is_market_maker",
)
def subtract_rows_all(spark, sf_dir):
    rows = fr.trades(spark, sf_dir)
    maker = rows.filter("is_market_maker").select("symbol", "price")
    taker = rows.filter("not is_market_maker").select("symbol", "price")
    return sel.subtract_rows(maker, taker, keep_copies=True)


@query(
    "trade_messages_to_prices",
    f"""WITH {fr.EVENTS_MS} SELECT event_type AS symbol, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
    time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
    ROUND(AVG(CASE WHEN event_id % 89 = 0 THEN NULL ELSE value END), 6) AS avg_price FROM ev
    WHERE event_id % 97 <> 0 AND event_id % 83 <> 0 GROUP BY ALL""",
)
def trade_messages_to_prices(spark, sf_dir):
    """Messages to dashboard: decode, clean, type, average per hour and symbol."""
    trades = normalize_trade(fr.raw_trades(spark, sf_dir))
    return _rounded(d.average_trade_price(trades, "1 hour"), "avg_price")
