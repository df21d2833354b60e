"""Queries of the sources, sinks and cleaning operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.cleaning import normalize_book_ticker, normalize_ticker, normalize_trade
from tidemark.operators.points import (
    pivot_fields, select_fields, to_line_protocol, to_points, upsert_points,
)
from tidemark.operators.selection import symbols_quoted_in, top_symbols
from tidemark.session import scratch_path
from tidemark.sources import archive, files, messages
from tidemark.streaming.sinks import replace_points, write_predictions
from tidemark.workload import frames as fr
from tidemark.workload.registry import query

CLEAN = "event_id % 97 <> 0 AND event_id % 83 <> 0"
DIRTY_PRICE = "CASE WHEN event_id % 89 = 0 THEN NULL ELSE value END"
DIRTY_TEXT = (
    "CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 89 = 0 THEN 'abc' "
    "ELSE CAST(value AS VARCHAR) END"
)
MS = "CAST(epoch_us(ts) // 1000 AS BIGINT)"


@query(
    "declared_schema_ingest",
    f"""WITH {fr.EVENTS_K} SELECT 'trade' AS event,
    CASE WHEN event_id % 83 <> 0 THEN {MS} END AS event_ms, event_type AS symbol,
    event_id AS trade_id, {DIRTY_TEXT} AS price, CAST(k AS VARCHAR) AS quantity, {MS} AS trade_ms,
    event_id % 2 = 0 AS maker, TRUE AS best_match FROM ev""",
)
def declared_schema_ingest(spark, sf_dir):
    typed = messages.apply_declared_schema(fr.raw_trades(spark, sf_dir), "trade")
    return typed.toDF(
        "event", "event_ms", "symbol", "trade_id", "price", "quantity", "trade_ms", "maker", "best_match"
    )


@query(
    "json_decode",
    f"""WITH {fr.EVENTS_K} SELECT CASE WHEN event_id % 83 <> 0 THEN event_id END AS update_id,
    event_type AS symbol, {DIRTY_TEXT} AS best_bid_price, CAST(k AS VARCHAR) AS best_bid_qty,
    CAST(ROUND(value * (1 + k / 1000.0::DOUBLE), 5) AS VARCHAR) AS best_ask_price,
    CAST(99.0::DOUBLE - k AS VARCHAR) AS best_ask_qty FROM ev""",
)
def json_decode(spark, sf_dir):
    return messages.decode_json(fr.raw_books(spark, sf_dir), "bookTicker")


_TRADE = f"""WITH {fr.EVENTS_MS} SELECT event_id AS trade_id, 'trade' AS event,
    event_type AS symbol, {DIRTY_PRICE} AS price, k AS quantity, ts AS trade_time,
    event_id % 2 = 0 AS is_market_maker FROM ev WHERE {CLEAN}"""


@query("trade_normalize", _TRADE)
def trade_normalize(spark, sf_dir):
    return normalize_trade(fr.raw_trades(spark, sf_dir))


@query("trade_normalize_strict", _TRADE + " AND event_id % 89 <> 0")
def trade_normalize_strict(spark, sf_dir):
    return normalize_trade(fr.raw_trades(spark, sf_dir), strict=True)


def _poisoned(extra=""):
    return f"""WITH {fr.EVENTS_MS} SELECT event_id AS trade_id, 'trade' AS event, event_type AS symbol,
    CASE WHEN event_id % 101 = 0 THEN 'Infinity'::DOUBLE ELSE {DIRTY_PRICE} END AS price, k AS quantity,
    CASE WHEN event_id % 79 <> 0 THEN ts END AS trade_time, event_id % 2 = 0 AS is_market_maker
    FROM ev WHERE (event_id % 97 <> 0 OR event_id % 101 = 0) AND event_id % 83 <> 0 {extra}"""


@query("trade_normalize_poison", _poisoned())
def trade_normalize_poison(spark, sf_dir):
    return normalize_trade(fr.raw_trades(spark, sf_dir, poison=True))


@query(
    "trade_normalize_poison_strict",
    _poisoned("AND event_id % 101 <> 0 AND event_id % 79 <> 0 AND event_id % 89 <> 0"),
)
def trade_normalize_poison_strict(spark, sf_dir):
    return normalize_trade(fr.raw_trades(spark, sf_dir, poison=True), strict=True)


@query(
    "ticker_normalize",
    f"""WITH {fr.ticker_sql(events_cte=fr.EVENTS_MS)} SELECT * REPLACE (
    CASE WHEN first_trade_id % 89 = 0 THEN NULL ELSE last_price END AS last_price) FROM ticker
    WHERE first_trade_id % 97 <> 0 AND first_trade_id % 83 <> 0""",
)
def ticker_normalize(spark, sf_dir):
    return normalize_ticker(fr.raw_tickers(spark, sf_dir))


@query(
    "book_normalize",
    f"""WITH {fr.book_sql()} SELECT * REPLACE (
    CASE WHEN update_id % 89 = 0 THEN NULL ELSE best_bid_price END AS best_bid_price) FROM book
    WHERE update_id % 97 <> 0 AND update_id % 83 <> 0""",
)
def book_normalize(spark, sf_dir):
    return normalize_book_ticker(fr.raw_books(spark, sf_dir), event_time="timestamp")


@query(
    "clean_counts",
    f"""SELECT event_type AS symbol, COUNT(*) AS kept, COUNT({DIRTY_PRICE}) AS priced FROM events
    WHERE {CLEAN} GROUP BY event_type""",
)
def clean_counts(spark, sf_dir):
    rows = normalize_trade(fr.raw_trades(spark, sf_dir))
    return rows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("kept"), F.count("price").alias("priced")
    )


@query(
    "message_publish",
    f"""WITH {fr.book_sql()} SELECT 'market_bookTicker' AS topic, symbol AS key,
    '{{"u":' || update_id || ',"s":"' || symbol || '","b":"' || best_bid_price || '","B":"' ||
    best_bid_qty || '","a":"' || best_ask_price || '","A":"' || best_ask_qty || '"}}' AS value
    FROM book""",
)
def message_publish(spark, sf_dir):
    return messages.encode_messages(fr.books(spark, sf_dir), "bookTicker")


@query(
    "message_replay",
    f"""WITH {fr.trade_sql()} SELECT symbol, COUNT(*) AS n, ROUND(SUM(price * quantity), 2) AS total
    FROM trade GROUP BY symbol""",
)
def message_replay(spark, sf_dir):
    """Publish to JSON-lines files, read them back and clean them."""
    path = scratch_path(spark, "messages")
    rows = fr.trades(spark, sf_dir).withColumns(
        {"event_ms": F.unix_millis("trade_time"), "is_best_match": F.lit(True)}
    )
    messages.publish(rows, "trade", path=path)
    back = normalize_trade(spark.read.text(path))
    return back.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("price") * F.col("quantity")), 2).alias("total")
    )


@query(
    "csv_scan",
    f"""WITH {fr.DAILY_SQL} SELECT date, quantity, discount, tax, price FROM daily""",
)
def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.export_csv(fr.daily_series(spark, sf_dir).drop("series"), path)
    return files.read_series_csv(spark, path)


@query(
    "parquet_export",
    f"""WITH {fr.DAILY_SQL} SELECT date, quantity, discount, tax, price FROM daily""",
)
def parquet_export(spark, sf_dir):
    path = scratch_path(spark, "export")
    files.export_parquet(fr.daily_series(spark, sf_dir).drop("series"), path)
    return spark.read.parquet(path)


_QUOTED = """SELECT CAST(p_partkey AS VARCHAR) || CASE WHEN p_partkey % 2 = 0 THEN 'USDT' ELSE 'BTC' END
    AS symbol, CAST(p_retailprice AS VARCHAR) AS "quoteVolume" FROM part"""


@query("snapshot_scan", _QUOTED)
def snapshot_scan(spark, sf_dir):
    path = scratch_path(spark, "snapshot")
    fr.snapshot(spark, sf_dir).write.json(path)
    return files.read_snapshot(spark, path, multiline=False)


@query("symbols_quoted_in", f"WITH s AS ({_QUOTED}) SELECT * FROM s WHERE symbol LIKE '%USDT'")
def quoted(spark, sf_dir):
    return symbols_quoted_in(fr.snapshot(spark, sf_dir), "USDT")


@query(
    "symbol_universe_topk",
    f"""WITH s AS ({_QUOTED}) SELECT LOWER(symbol) AS symbol, CAST("quoteVolume" AS DOUBLE) AS quote_volume
    FROM s WHERE symbol LIKE '%USDT' ORDER BY quote_volume DESC, s.symbol LIMIT 10""",
)
def symbol_universe_topk(spark, sf_dir):
    return top_symbols(fr.snapshot(spark, sf_dir), "USDT", 10)


def _daily_archive(spark, sf_dir) -> str:
    """Trades archived with one batch per trade day."""
    root = scratch_path(spark, "archive")
    day = F.unix_seconds(F.date_trunc("day", "trade_time"))
    (
        fr.trades(spark, sf_dir)
        .withColumns({"query_id": F.lit("load"), "batch_id": F.lit(0).cast("long"), "ingest_epoch": day})
        .write.partitionBy("query_id", "batch_id", "ingest_epoch").parquet(f"{root}/trade")
    )
    return root


_DAYS = f"""WITH {fr.trade_sql()}, d AS (SELECT *,
    CAST(epoch_us(date_trunc('day', trade_time)) // 1000000 AS BIGINT) AS ingest_epoch FROM trade)"""
AS_OF = "2024-01-30"


@query(
    "archive_window_scan",
    _DAYS + """, b AS (SELECT DISTINCT ingest_epoch FROM d WHERE ingest_epoch <= epoch(TIMESTAMP '2024-01-30') - 3 * 86400
    ORDER BY ingest_epoch DESC LIMIT 10) SELECT * FROM d WHERE ingest_epoch IN (SELECT ingest_epoch FROM b)""",
)
def archive_window_scan(spark, sf_dir):
    return archive.read_archive(spark, _daily_archive(spark, sf_dir), "trade", AS_OF, 3, 10)


@query(
    "archive_current_scan",
    _DAYS + """, b AS (SELECT DISTINCT ingest_epoch FROM d WHERE ingest_epoch <= epoch(TIMESTAMP '2024-01-30') - 86400
    ORDER BY ingest_epoch DESC LIMIT 2) SELECT * FROM d WHERE ingest_epoch IN (SELECT ingest_epoch FROM b)""",
)
def archive_current_scan(spark, sf_dir):
    return archive.read_current(spark, _daily_archive(spark, sf_dir), "trade", AS_OF, max_batches=20)


@query(
    "archive_newest_batches",
    _DAYS + """ SELECT DISTINCT ingest_epoch FROM d WHERE ingest_epoch <= epoch(TIMESTAMP '2024-01-30') - 86400
    ORDER BY ingest_epoch DESC LIMIT 5""",
)
def archive_newest_batches(spark, sf_dir):
    chosen = archive.newest_batches(spark, _daily_archive(spark, sf_dir), "trade", AS_OF, 1, 5)
    return spark.createDataFrame([(e,) for e in chosen], "ingest_epoch bigint")


@query(
    "archive_since",
    _DAYS + """ SELECT * FROM d WHERE ingest_epoch >= epoch(TIMESTAMP '2024-01-25')""",
)
def archive_since(spark, sf_dir):
    return archive.read_since(spark, _daily_archive(spark, sf_dir), "trade", "2024-01-25", clock_skew=0)


@query(
    "archive_union_read",
    _DAYS + """ SELECT * FROM d WHERE ingest_epoch IN (epoch(TIMESTAMP '2024-01-05'), epoch(TIMESTAMP '2024-01-09'))""",
)
def archive_union_read(spark, sf_dir):
    days = [archive.epoch_seconds("2024-01-05"), archive.epoch_seconds("2024-01-09")]
    return archive.read_batches(spark, _daily_archive(spark, sf_dir), "trade", days)


@query(
    "table_registration",
    f"""WITH {fr.trade_sql()}, t AS (SELECT 'trade' AS name, symbol, COUNT(*) AS n FROM trade GROUP BY symbol),
    b AS (SELECT 'bookTicker' AS name, event_type AS symbol, COUNT(*) AS n FROM ev GROUP BY event_type)
    SELECT * FROM t UNION ALL SELECT * FROM b UNION ALL SELECT 'ticker', symbol, n FROM b
    UNION ALL SELECT 'ticker_predict', symbol, n FROM b""",
)
def table_registration(spark, sf_dir):
    root = scratch_path(spark, "tables")
    fr.trades(spark, sf_dir).write.parquet(f"{root}/trade")
    fr.tickers(spark, sf_dir).write.parquet(f"{root}/ticker")
    fr.books(spark, sf_dir).write.parquet(f"{root}/bookTicker")
    fr.predictions(spark, sf_dir).write.parquet(f"{root}/ticker_predict")
    names = archive.register_tables(spark, root)
    return spark.sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS name, symbol, COUNT(*) AS n FROM {name} GROUP BY symbol" for name in names
        )
    )


_PREDICTIONS = f"""WITH {fr.ticker_sql()} SELECT event_time, symbol, last_price, best_bid_price,
    best_ask_price, trade_count FROM ticker"""


@query("prediction_table", _PREDICTIONS)
def prediction_table(spark, sf_dir):
    root = scratch_path(spark, "predictions")
    return spark.read.parquet(write_predictions(fr.predictions(spark, sf_dir), root))


@query(
    "prediction_points",
    f"""WITH {fr.ticker_sql()} SELECT 'ticker,symbol=' || symbol || ' last_price=' || last_price ||
    ',best_bid_price=' || best_bid_price || ',best_ask_price=' || best_ask_price || ',trade_count=' ||
    trade_count || 'i ' || (epoch_us(event_time) * 1000) AS line FROM ticker""",
)
def replaced_points(spark, sf_dir):
    path = scratch_path(spark, "points")
    replace_points(fr.predictions(spark, sf_dir), path)
    return spark.read.text(path).toDF("line")


def _line(stream: str, table: str, fields: list[str], time: str) -> str:
    body = " || ',".join(f"{name}=' || {name}" for name in fields)
    return f"SELECT '{stream},symbol=' || symbol || ' {body} || ' ' || (epoch_us({time}) * 1000) AS line FROM {table}"


@query("line_protocol_trade", f"WITH {fr.trade_sql()} " + _line("trade", "trade", ["price", "quantity"], "trade_time"))
def line_protocol_trade(spark, sf_dir):
    return to_line_protocol(fr.trades(spark, sf_dir), "trade")


_TICKER_FIELDS = [
    "price_change", "price_change_percent", "weighted_avg_price", "prev_close_price", "last_price",
    "last_qty", "best_bid_price", "best_bid_qty", "best_ask_price", "best_ask_qty", "open_price",
    "high_price", "low_price", "base_volume", "quote_volume", "first_trade_id", "last_trade_id",
    "trade_count",
]


@query("line_protocol_ticker", f"WITH {fr.ticker_sql()} " + _line("ticker", "ticker", _TICKER_FIELDS, "close_time"))
def line_protocol_ticker(spark, sf_dir):
    return to_line_protocol(fr.tickers(spark, sf_dir), "ticker")


_BOOK_FIELDS = ["best_bid_price", "best_bid_qty", "best_ask_price", "best_ask_qty", "update_id"]


@query("line_protocol_book", f"WITH {fr.book_sql()} " + _line("bookTicker", "book", _BOOK_FIELDS, "event_time"))
def line_protocol_book(spark, sf_dir):
    return to_line_protocol(fr.books(spark, sf_dir), "bookTicker")


_POINTS = " UNION ALL ".join(
    f"SELECT 'bookTicker' AS measurement, symbol, '{f}' AS field, CAST({f} AS DOUBLE) AS value, "
    "event_time AS time FROM book"
    for f in _BOOK_FIELDS
)


def _book_points(spark, sf_dir):
    return to_points(fr.books(spark, sf_dir), "bookTicker", _BOOK_FIELDS, "event_time")


@query("unpivot_points", f"WITH {fr.book_sql()} {_POINTS}")
def unpivot_points(spark, sf_dir):
    return _book_points(spark, sf_dir)


@query(
    "field_selection",
    f"""WITH {fr.book_sql()}, p AS ({_POINTS}) SELECT * FROM p WHERE measurement = 'bookTicker'
    AND field IN ('best_bid_price', 'best_ask_price')""",
)
def field_selection(spark, sf_dir):
    return select_fields(_book_points(spark, sf_dir), "bookTicker", ["best_bid_price", "best_ask_price"])


@query(
    "pivot_fields",
    f"""WITH {fr.book_sql()} SELECT symbol, event_time AS time, best_bid_price, best_ask_price FROM book""",
)
def pivoted(spark, sf_dir):
    fields = ["best_bid_price", "best_ask_price"]
    return pivot_fields(select_fields(_book_points(spark, sf_dir), "bookTicker", fields), fields)


@query(
    "point_upsert",
    f"""WITH {fr.trade_sql()}, p AS (SELECT 'trade' AS measurement, symbol, 'price' AS field,
    price AS value, date_trunc('hour', trade_time) AS time, trade_id FROM trade)
    SELECT measurement, symbol, field, time, max_by(value, trade_id) AS value FROM p
    GROUP BY measurement, symbol, field, time""",
)
def point_upsert(spark, sf_dir):
    hourly = fr.trades(spark, sf_dir).withColumn("trade_time", F.date_trunc("hour", "trade_time"))
    points = to_points(hourly, "trade", ["price"], "trade_time", keep=["trade_id"])
    return upsert_points(points, "trade_id")
