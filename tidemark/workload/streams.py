"""Queries that run as streams over the shared tables until the input is drained."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators.cleaning import normalize_trade
from tidemark.session import scratch_path
from tidemark.sources.archive import open_archive, register_tables
from tidemark.sources.log import ENVELOPE
from tidemark.sources.messages import decode_json, publish, read_stream
from tidemark.streaming import queries as live
from tidemark.streaming.sinks import write_archive, write_points
from tidemark.streaming.store import read_points
from tidemark.workload import frames as fr
from tidemark.workload.registry import query


def _drained(stream_df, path, mode):
    query_ = live.write_table(stream_df, f"{path}/table", f"{path}/checkpoint", mode, "available")
    live.drain(query_)
    return stream_df.sparkSession.read.parquet(f"{path}/table")


@query(
    "stream_avg_price",
    f"""WITH {fr.trade_sql()} SELECT symbol, time_bucket(INTERVAL 1 HOUR, trade_time) AS window_start,
    time_bucket(INTERVAL 1 HOUR, trade_time) + INTERVAL 1 HOUR AS window_end, ROUND(AVG(price), 6) AS avg_price
    FROM trade GROUP BY ALL""",
)
def stream_avg_price(spark, sf_dir):
    trades = fr.trades_of(fr.stream_events(spark, sf_dir))
    panel = live.live_windows(trades, "trade_time", "1 hour", ["symbol"], {"avg_price": F.avg("price")}, "1 minute")
    stored = _drained(panel, scratch_path(spark, "live"), "complete")
    return stored.withColumn("avg_price", F.round("avg_price", 6))


@query(
    "stream_closed_windows",
    f"""WITH {fr.trade_sql()}, w AS (SELECT symbol, time_bucket(INTERVAL 1 HOUR, trade_time) AS window_start,
    COUNT(*) AS n FROM trade GROUP BY ALL) SELECT symbol, window_start, window_start + INTERVAL 1 HOUR AS window_end,
    n FROM w WHERE window_start + INTERVAL 1 HOUR <= (SELECT MAX(trade_time) FROM trade) - INTERVAL 1 MINUTE""",
)
def stream_closed_windows(spark, sf_dir):
    """Append mode: a window is written once the watermark has passed its end."""
    trades = fr.trades_of(fr.stream_events(spark, sf_dir))
    panel = live.live_windows(trades, "trade_time", "1 hour", ["symbol"], {"n": F.count(F.lit(1))}, "1 minute")
    return _drained(panel, scratch_path(spark, "live"), "append").drop("batch_id")


# the days at which the table is cut into the files of a stream, and the rows that come too late
_CUTS = ["2024-01-08", "2024-01-15", "2024-01-22"]
_LATE = f"(ts < TIMESTAMP '{_CUTS[0]}' AND event_id % 50 = 0)"


@query(
    "stream_windows_batches",
    f"""WITH {fr.trade_sql()}, e AS (SELECT event_id FROM events WHERE NOT {_LATE})
    SELECT symbol, time_bucket(INTERVAL 1 HOUR, trade_time) AS window_start,
    time_bucket(INTERVAL 1 HOUR, trade_time) + INTERVAL 1 HOUR AS window_end, COUNT(*) AS n, ROUND(AVG(price), 6) AS avg_price
    FROM trade JOIN e ON trade_id = event_id GROUP BY ALL""",
)
def stream_windows_batches(spark, sf_dir):
    """Update mode over several micro-batches with a restart in between; late rows of closed windows fall out."""
    path = scratch_path(spark, "live")
    ts, late = F.col("ts"), F.expr(_LATE)
    edges = [F.lit(c).cast("timestamp") for c in _CUTS]
    files = [(ts < edges[0]) & ~late, (ts >= edges[0]) & (ts < edges[1]), (ts >= edges[1]) & (ts < edges[2]), (ts >= edges[2]) | late]

    def run(names):
        for k in names:
            fr.events(spark, sf_dir).where(files[k]).coalesce(1).write.mode("append").parquet(f"{path}/in")
        rows = spark.readStream.schema(fr.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        panel = live.live_windows(fr.trades_of(rows), "trade_time", "1 hour", ["symbol"],
                                  {"n": F.count(F.lit(1)), "avg_price": F.avg("price")}, "1 minute")
        live.drain(live.write_table(panel, f"{path}/table", f"{path}/checkpoint", "update", "available"))

    run([0, 1])
    run([2, 3])
    stored = live.read_updates(spark, f"{path}/table", ["symbol", "window_start", "window_end"])
    return stored.withColumn("avg_price", F.round("avg_price", 6))


@query(
    "stream_log_restart",
    f"""WITH {fr.trade_sql()} SELECT symbol AS key, 'market_trade' AS topic, trade_id, symbol, price, quantity, is_market_maker
    FROM trade""",
)
def stream_log_restart(spark, sf_dir):
    """Trades appended to a message log in two parts; the query that archives them is restarted between them."""
    path = scratch_path(spark, "log")
    trades = fr.trades(spark, sf_dir)

    def run(part):
        publish(part, "trade", log=f"{path}/log")
        stream = read_stream(spark, "trade", "log", path=f"{path}/log", starting="earliest", fail_on_data_loss=True)
        live.drain(live.write_table(stream, f"{path}/table", f"{path}/checkpoint", "append", "available"))

    early = F.col("trade_time") < F.lit(_CUTS[1]).cast("timestamp")
    run(trades.where(early))
    run(trades.where(~early))
    kept = spark.read.schema(ENVELOPE).parquet(f"{path}/table")
    decoded = decode_json(kept, "trade", passthrough=["key", "topic"])
    return decoded.select(F.col("key").cast("string").alias("key"), "topic", "trade_id", "symbol",
                          *[F.col(c).cast("double").alias(c) for c in ("price", "quantity")], "is_market_maker")


@query(
    "stream_latest",
    f"""WITH {fr.ticker_sql('user_id')} SELECT symbol, close_time, trade_count, quote_volume FROM ticker
    QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY close_time DESC, last_trade_id DESC) = 1""",
)
def stream_latest(spark, sf_dir):
    tickers = fr.tickers_of(fr.stream_events(spark, sf_dir), "user_id")
    columns = ["symbol", "close_time", "trade_count", "quote_volume"]
    newest = live.live_latest(tickers, ["symbol"], "close_time", "last_trade_id", columns)
    return _drained(newest, scratch_path(spark, "live"), "complete")


_SPLIT = f"""WITH {fr.ticker_sql('user_id')}, t AS (SELECT * FROM ticker JOIN (SELECT event_id FROM events WHERE NOT {_LATE}) e
    ON first_trade_id = event_id)"""


def _in_batches(spark, sf_dir, path, numbers):
    """The events as a stream of one file per part of the month; the late rows come with the last one."""
    ts, late = F.col("ts"), F.expr(_LATE)
    edges = [F.lit(c).cast("timestamp") for c in _CUTS]
    parts = [(ts < edges[0]) & ~late, (ts >= edges[0]) & (ts < edges[1]), (ts >= edges[1]) & (ts < edges[2]), (ts >= edges[2]) | late]
    for k in numbers:
        fr.events(spark, sf_dir).where(parts[k]).coalesce(1).write.mode("append").parquet(f"{path}/in")
    return spark.readStream.schema(fr.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


@query(
    "stream_latest_expiring",
    f"""{_SPLIT} SELECT symbol, close_time, trade_count, quote_volume FROM t
    QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY close_time DESC, last_trade_id DESC) = 1""",
)
def stream_latest_expiring(spark, sf_dir):
    """The newest row per symbol over four batches with a restart; idle symbols leave the state, not the table."""
    path = scratch_path(spark, "live")
    columns = ["symbol", "close_time", "trade_count", "quote_volume"]
    for numbers in ([0, 1], [2, 3]):
        tickers = fr.tickers_of(_in_batches(spark, sf_dir, path, numbers), "user_id")
        newest = live.live_latest_expiring(tickers, ["symbol"], "close_time", "1 minute", "2 days", "last_trade_id", columns)
        live.drain(live.write_table(newest, f"{path}/table", f"{path}/checkpoint", "update", "available", rocksdb=True))
    return live.read_updates(spark, f"{path}/table", ["symbol"])


@query(
    "stream_merged_updates",
    f"""WITH {fr.trade_sql()}, e AS (SELECT event_id FROM events WHERE NOT {_LATE})
    SELECT symbol, time_bucket(INTERVAL 1 DAY, trade_time) AS window_start,
    time_bucket(INTERVAL 1 DAY, trade_time) + INTERVAL 1 DAY AS window_end, COUNT(*) AS n
    FROM trade JOIN e ON trade_id = event_id GROUP BY ALL""",
)
def stream_merged_updates(spark, sf_dir):
    """An update table whose batches are merged between and after two runs of its query."""
    path, keys = scratch_path(spark, "live"), ["symbol", "window_start", "window_end"]
    for numbers in ([0, 1], [2, 3]):
        trades = fr.trades_of(_in_batches(spark, sf_dir, path, numbers))
        panel = live.live_windows(trades, "trade_time", "1 day", ["symbol"], {"n": F.count(F.lit(1))}, "1 minute")
        live.drain(live.write_table(panel, f"{path}/table", f"{path}/checkpoint", "update", "available"))
        live.merge_updates(spark, f"{path}/table", keys)
    return live.read_updates(spark, f"{path}/table", keys)


@query(
    "archive_table_batches",
    f"WITH {fr.trade_sql()} SELECT symbol, COUNT(*) AS n, COUNT(DISTINCT trade_time < TIMESTAMP '{_CUTS[1]}') AS batches FROM trade GROUP BY symbol",
)
def archive_table_batches(spark, sf_dir):
    """A catalogue table over an archive that two runs of a query fill; it is registered once, before the first."""
    path, name = scratch_path(spark, "archive"), f"market_{uuid.uuid4().hex}"
    register_tables(spark, f"{path}/archive", database=name, tables=["trade"])
    early = F.col("ts") < F.lit(_CUTS[1]).cast("timestamp")
    for part in (early, ~early):
        fr.events(spark, sf_dir).where(part).coalesce(1).write.mode("append").parquet(f"{path}/in")
        rows = fr.trades_of(spark.readStream.schema(fr.EVENTS_SCHEMA).parquet(f"{path}/in"))
        live.drain(write_archive(rows, f"{path}/archive", "trade", f"{path}/checkpoint", "available", table=f"{name}.trade"))
    return spark.table(f"{name}.trade").groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("query_id", "batch_id").alias("batches"))


@query(
    "stream_dedup",
    f"WITH {fr.trade_sql()} SELECT DISTINCT symbol, date_trunc('hour', trade_time) AS event_time FROM trade",
)
def stream_dedup(spark, sf_dir):
    trades = fr.trades_of(fr.stream_events(spark, sf_dir))
    hourly = trades.select("symbol", F.date_trunc("hour", "trade_time").alias("event_time"))
    path = scratch_path(spark, "live")
    return _drained(live.live_dedup(hourly, "1 minute"), path, "append").drop("batch_id")


_CLEAN = f"""WITH {fr.EVENTS_MS} SELECT event_id AS trade_id, 'trade' AS event, event_type AS symbol,
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE value END AS price, k AS quantity, ts AS trade_time,
    event_id % 2 = 0 AS is_market_maker FROM ev WHERE event_id % 97 <> 0 AND event_id % 83 <> 0"""


def _run(spark, sf_dir, strict=False):
    path = scratch_path(spark, "stream")
    messages = fr.raw_trades_of(fr.stream_events(spark, sf_dir))
    started = live.start_stream(
        messages, "trade", f"{path}/archive", f"{path}/checkpoints", points_path=f"{path}/points",
        strict=strict, archive_trigger="available", points_trigger="available",
    )
    live.drain(started.archive, started.points)
    return path


@query("stream_archive_roundtrip", _CLEAN)
def stream_archive_roundtrip(spark, sf_dir):
    """Messages through both sinks; the archive read back."""
    path = _run(spark, sf_dir)
    return open_archive(spark, f"{path}/archive", "trade").drop("query_id", "batch_id", "ingest_epoch")


@query(
    "stream_points",
    f"""WITH c AS ({_CLEAN} AND event_id % 89 <> 0) SELECT 'trade,symbol=' || symbol || ' price=' || price ||
    ',quantity=' || quantity || ' ' || (epoch_us(trade_time) * 1000) AS line FROM c""",
)
def stream_points(spark, sf_dir):
    """Messages through both sinks; the encoded points read back."""
    path = scratch_path(spark, "points")
    rows = normalize_trade(fr.raw_trades_of(fr.stream_events(spark, sf_dir)), strict=True)
    live.drain(write_points(rows, "trade", f"{path}/checkpoint", path=f"{path}/points", trigger="available"))
    return spark.read.option("recursiveFileLookup", "true").text(f"{path}/points").toDF("line")


@query(
    "stream_both_sinks",
    f"""WITH c AS ({_CLEAN} AND event_id % 89 <> 0) SELECT 'trade,symbol=' || symbol || ' price=' || price ||
    ',quantity=' || quantity || ' ' || (epoch_us(trade_time) * 1000) AS line, COUNT(*) OVER (PARTITION BY symbol) AS archived FROM c""",
)
def stream_both_sinks(spark, sf_dir):
    """One query feeds the archive and a folder store, with a restart; committed lines with their symbol's archived rows."""
    path = scratch_path(spark, "both")
    early = F.col("ts") < F.lit(_CUTS[1]).cast("timestamp")
    for part in (early, ~early):
        fr.events(spark, sf_dir).where(part).coalesce(1).write.mode("append").parquet(f"{path}/in")
        messages = fr.raw_trades_of(spark.readStream.schema(fr.EVENTS_SCHEMA).parquet(f"{path}/in"))
        live.drain(live.start_stream_once(
            messages, "trade", f"{path}/archive", f"{path}/checkpoints", strict=True, trigger="available", store=f"{path}/store"))
    counts = open_archive(spark, f"{path}/archive", "trade").groupBy("symbol").agg(F.count(F.lit(1)).alias("archived"))
    lines = read_points(spark, f"{path}/store").select("line", F.regexp_extract("line", "symbol=([^ ,]+)", 1).alias("symbol"))
    return lines.join(counts, "symbol").select("line", "archived")
