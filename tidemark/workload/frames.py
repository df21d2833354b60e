"""Market frames made from the shared tables, in Spark and as SQL common table expressions.

Events play trades, quotes and tickers: the event type (or the user) is the symbol, ``value`` the
price and ``k`` of the JSON properties the quantity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.session import configure

EVENTS_SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def ntz(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the shared tables store them."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows; reading ``ts`` as a UTC timestamp leaves time filters on the bare column."""
    return configure(spark).read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as a stream."""
    reader = configure(spark).readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet")
    return reader.parquet(sf_dir)


def _k():
    return F.get_json_object("props", "$.k").cast("double")


def trades_of(rows: DataFrame, symbol: str = "event_type") -> DataFrame:
    return rows.select(
        F.col("event_id").alias("trade_id"),
        F.lit("trade").alias("event"),
        F.col(symbol).cast("string").alias("symbol"),
        F.col("value").alias("price"),
        _k().alias("quantity"),
        F.col("ts").alias("trade_time"),
        (F.col("event_id") % 2 == 0).alias("is_market_maker"),
    )


def trades(spark, sf_dir, symbol: str = "event_type") -> DataFrame:
    return trades_of(events(spark, sf_dir), symbol)


def books(spark, sf_dir, symbol: str = "event_type") -> DataFrame:
    return events(spark, sf_dir).select(
        F.col(symbol).cast("string").alias("symbol"),
        F.col("event_id").alias("update_id"),
        F.col("value").alias("best_bid_price"),
        _k().alias("best_bid_qty"),
        F.round(F.col("value") * (1 + _k() / 1000.0), 5).alias("best_ask_price"),
        (99.0 - _k()).alias("best_ask_qty"),
        F.col("ts").alias("event_time"),
    )


def tickers_of(rows: DataFrame, symbol: str = "event_type") -> DataFrame:
    value = F.col("value")
    return rows.select(
        F.lit("24hrTicker").alias("event"),
        F.col("ts").alias("event_time"),
        F.col(symbol).cast("string").alias("symbol"),
        value.alias("price_change"),
        (_k() - 50.0).alias("price_change_percent"),
        value.alias("weighted_avg_price"),
        value.alias("prev_close_price"),
        value.alias("last_price"),
        _k().alias("last_qty"),
        value.alias("best_bid_price"),
        _k().alias("best_bid_qty"),
        F.round(value * (1 + _k() / 1000.0), 5).alias("best_ask_price"),
        (99.0 - _k()).alias("best_ask_qty"),
        value.alias("open_price"),
        value.alias("high_price"),
        value.alias("low_price"),
        _k().alias("base_volume"),
        F.round(value * _k(), 2).alias("quote_volume"),
        (F.col("ts") - F.expr("INTERVAL 1 DAY")).alias("open_time"),
        F.col("ts").alias("close_time"),
        F.col("event_id").alias("first_trade_id"),
        F.col("event_id").alias("last_trade_id"),
        _k().cast("long").alias("trade_count"),
    )


def tickers(spark, sf_dir, symbol: str = "event_type") -> DataFrame:
    return tickers_of(events(spark, sf_dir), symbol)


def predictions(spark, sf_dir, symbol: str = "event_type") -> DataFrame:
    return tickers(spark, sf_dir, symbol).select(
        "event_time", "symbol", "last_price", "best_bid_price", "best_ask_price", "trade_count"
    )


def _dirty(text):
    """Empty and unreadable prices in fixed places."""
    key = F.col("event_id")
    return F.when(key % 97 == 0, "").when(key % 89 == 0, "abc").otherwise(text.cast("string"))


def _unless_83(column):
    return F.when(F.col("event_id") % 83 != 0, column)


def raw_trades_of(rows: DataFrame, poison: bool = False) -> DataFrame:
    """JSON trade messages, some with an empty price, a bad price or no event time; with ``poison`` also
    some with an infinite price or a trade time that no timestamp can hold."""
    millis = F.unix_millis("ts")
    key = F.col("event_id")
    price, traded = _dirty(F.col("value")), millis
    if poison:
        price = F.when(key % 101 == 0, "Infinity").otherwise(price)
        traded = F.when(key % 79 == 0, F.lit(2**63 - 1)).otherwise(traded)
    payload = F.struct(
        F.lit("trade").alias("e"),
        _unless_83(millis).alias("E"),
        F.col("event_type").alias("s"),
        F.col("event_id").alias("t"),
        price.alias("p"),
        _k().cast("string").alias("q"),
        traded.alias("T"),
        (F.col("event_id") % 2 == 0).alias("m"),
        F.lit(True).alias("M"),
    )
    return rows.select(
        F.col("event_type").cast("binary").alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
        F.col("ts").alias("timestamp"),
    )


def raw_trades(spark, sf_dir, poison: bool = False) -> DataFrame:
    return raw_trades_of(events(spark, sf_dir), poison)


def raw_tickers(spark, sf_dir) -> DataFrame:
    text = F.col("value").cast("string")
    k = _k().cast("string")
    millis = F.unix_millis("ts")
    ask = F.round(F.col("value") * (1 + _k() / 1000.0), 5).cast("string")
    payload = F.struct(
        F.lit("24hrTicker").alias("e"), _unless_83(millis).alias("E"), F.col("event_type").alias("s"),
        text.alias("p"), (_k() - 50.0).cast("string").alias("P"), text.alias("w"), text.alias("x"),
        _dirty(F.col("value")).alias("c"), k.alias("Q"), text.alias("b"), k.alias("B"), ask.alias("a"),
        (99.0 - _k()).cast("string").alias("A"), text.alias("o"), text.alias("h"), text.alias("l"),
        k.alias("v"), F.round(F.col("value") * _k(), 2).cast("string").alias("q"),
        (millis - 86_400_000).alias("O"), millis.alias("C"), F.col("event_id").alias("F"),
        F.col("event_id").alias("L"), _k().cast("int").alias("n"),
    )
    return events(spark, sf_dir).select(F.to_json(payload).alias("value"))


def raw_books(spark, sf_dir) -> DataFrame:
    ask = F.round(F.col("value") * (1 + _k() / 1000.0), 5).cast("string")
    payload = F.struct(
        _unless_83(F.col("event_id")).alias("u"), F.col("event_type").alias("s"),
        _dirty(F.col("value")).alias("b"), _k().cast("string").alias("B"), ask.alias("a"),
        (99.0 - _k()).cast("string").alias("A"),
    )
    return events(spark, sf_dir).select(
        F.to_json(payload).alias("value"), F.col("ts").alias("timestamp")
    )


def snapshot(spark, sf_dir) -> DataFrame:
    """24-hour statistics: a symbol per part, its price as quote volume."""
    quote = F.when(F.col("p_partkey") % 2 == 0, "USDT").otherwise("BTC")
    return configure(spark).read.parquet(f"{sf_dir}/part.parquet").select(
        F.concat(F.col("p_partkey").cast("string"), quote).alias("symbol"),
        F.col("p_retailprice").cast("string").alias("quoteVolume"),
    )


FEATURES = [f"f{i}" for i in range(63)]


def vector_series(spark, sf_dir) -> DataFrame:
    """Hourly multivariate series of the embedding rows: date, f0..f62, target last."""
    names = [*FEATURES, "target"]
    rows = configure(spark).read.schema("vec_id long, embedding array<float>").parquet(
        f"{sf_dir}/embeddings.parquet"
    )
    start = F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return rows.select(
        F.lit("all").alias("series"),
        F.timestamp_micros(start + F.col("vec_id") * 3_600_000_000).alias("date"),
        *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)],
    )


def daily_series(spark, sf_dir) -> DataFrame:
    """Daily sums of the line items: date, quantity, discount, tax, price (the target) last."""
    rows = configure(spark).read.schema(
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp"
    ).parquet(f"{sf_dir}/lineitem.parquet")
    return rows.groupBy(F.col("l_shipdate").alias("date")).agg(
        F.lit("all").alias("series"),
        F.round(F.sum("l_quantity"), 2).alias("quantity"),
        F.round(F.sum("l_discount"), 2).alias("discount"),
        F.round(F.sum("l_tax"), 2).alias("tax"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
    )


# --- the same frames as SQL -------------------------------------------------------------------

K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"

EVENTS_K = f"ev AS (SELECT event_id, ts, user_id, event_type, value, {K} AS k FROM events)"
EVENTS_MS = (
    f"ev AS (SELECT event_id, date_trunc('milliseconds', ts) AS ts, user_id, event_type, value, {K} AS k "
    "FROM events)"
)


def trade_sql(symbol: str = "event_type") -> str:
    return (
        f"{EVENTS_K}, trade AS (SELECT event_id AS trade_id, 'trade' AS event, "
        f"CAST({symbol} AS VARCHAR) AS symbol, value AS price, k AS quantity, ts AS trade_time, "
        "event_id % 2 = 0 AS is_market_maker FROM ev)"
    )


def book_sql(symbol: str = "event_type", events_cte: str = EVENTS_K) -> str:
    return (
        f"{events_cte}, book AS (SELECT CAST({symbol} AS VARCHAR) AS symbol, event_id AS update_id, "
        "value AS best_bid_price, k AS best_bid_qty, ROUND(value * (1 + k / 1000.0::DOUBLE), 5) AS best_ask_price, "
        "99.0::DOUBLE - k AS best_ask_qty, ts AS event_time FROM ev)"
    )


def ticker_sql(symbol: str = "event_type", events_cte: str = EVENTS_K) -> str:
    return (
        f"{events_cte}, ticker AS (SELECT '24hrTicker' AS event, ts AS event_time, "
        f"CAST({symbol} AS VARCHAR) AS symbol, value AS price_change, k - 50 AS price_change_percent, "
        "value AS weighted_avg_price, value AS prev_close_price, value AS last_price, k AS last_qty, "
        "value AS best_bid_price, k AS best_bid_qty, "
        "ROUND(value * (1 + k / 1000.0::DOUBLE), 5) AS best_ask_price, "
        "99.0::DOUBLE - k AS best_ask_qty, value AS open_price, value AS high_price, value AS low_price, "
        "k AS base_volume, ROUND(value * k, 2) AS quote_volume, ts - INTERVAL 1 DAY AS open_time, "
        "ts AS close_time, event_id AS first_trade_id, event_id AS last_trade_id, "
        "CAST(k AS BIGINT) AS trade_count FROM ev)"
    )


VECTOR_SQL = (
    "vec AS (SELECT 'all' AS series, TIMESTAMP '2024-01-01' + to_hours(CAST(vec_id AS INTEGER)) AS date, vec_id AS position, "
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {n}" for i, n in enumerate([*FEATURES, "target"]))
    + ", COUNT(*) OVER () AS n FROM embeddings)"
)

DAILY_SQL = (
    "daily AS (SELECT 'all' AS series, l_shipdate AS date, ROUND(SUM(l_quantity), 2) AS quantity, "
    "ROUND(SUM(l_discount), 2) AS discount, ROUND(SUM(l_tax), 2) AS tax, "
    "ROUND(SUM(l_extendedprice), 2) AS price FROM lineitem GROUP BY l_shipdate), "
    "placed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY date) - 1 AS position, "
    "COUNT(*) OVER () AS series_length FROM daily)"
)


def placed_ticker_sql(symbol: str = "user_id") -> str:
    """Tickers with position and length per symbol."""
    return (
        f"{ticker_sql(symbol)}, placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY "
        "event_time) - 1 AS position, COUNT(*) OVER (PARTITION BY symbol) AS series_length FROM ticker)"
    )
