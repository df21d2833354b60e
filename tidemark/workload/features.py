"""Queries of the calendar, scaling, position and split operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.operators import positions as pos, scaling as sc
from tidemark.operators.sequences import feature_mode
from tidemark.plans.forecasting import encode_time, select_features
from tidemark.schemas import TICKER_FEATURES
from tidemark.workload import frames as fr
from tidemark.workload.registry import query

TICK = list(TICKER_FEATURES.features)
USERS = fr.ticker_sql("user_id")
PLACED = fr.placed_ticker_sql("user_id")


def _round(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "select_features",
    f"""WITH {fr.ticker_sql()} SELECT event_time, symbol, last_price, best_bid_price, best_ask_price,
    trade_count FROM ticker""",
)
def selected_features(spark, sf_dir):
    return select_features(fr.tickers(spark, sf_dir))


@query(
    "calendar_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
    CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
    CAST(second(ts) AS INTEGER) AS second, CAST(CASE WHEN month(ts) IN (1, 3, 5, 7, 8, 10, 12) THEN 31
    WHEN month(ts) IN (4, 6, 9, 11) THEN 30 WHEN year(ts) % 4 = 0 THEN 29 ELSE 28 END AS INTEGER) AS month_days
    FROM events""",
)
def calendar_parts(spark, sf_dir):
    t = F.col("ts")
    parts = [c.alias(n) for n, c in cal.calendar_parts(t).items()]
    return fr.events(spark, sf_dir).select("event_id", *parts, cal.days_in_month(t).alias("month_days"))


_DIM = """CASE WHEN month(date) IN (1, 3, 5, 7, 8, 10, 12) THEN 31 WHEN month(date) IN (4, 6, 9, 11)
    THEN 30 WHEN year(date) % 4 = 0 THEN 29 ELSE 28 END"""


@query(
    "month_lengths",
    f"""WITH {fr.DAILY_SQL} SELECT date, CAST({_DIM} AS INTEGER) AS month_days FROM daily""",
)
def month_lengths(spark, sf_dir):
    return fr.daily_series(spark, sf_dir).select("date", cal.days_in_month(F.col("date")).alias("month_days"))


def _sines(t: str, digits: int = 6) -> str:
    dim = _DIM.replace("date", t)
    parts = {
        "month_sin": f"month({t}) / 12.0::DOUBLE",
        "day_sin": f"day({t}) / CAST({dim} AS DOUBLE)",
        "weekday_sin": f"(dayofweek({t}) + 1) / 7.0::DOUBLE",
        "hour_sin": f"hour({t}) / 24.0::DOUBLE",
        "minute_sin": f"minute({t}) / 60.0::DOUBLE",
        "second_sin": f"second({t}) / 60.0::DOUBLE",
    }
    return ", ".join(f"ROUND(sin(2 * pi() * ({e})), {digits}) AS {n}" for n, e in parts.items())


@query("cyclic_time", f"WITH {fr.ticker_sql()} SELECT last_trade_id, {_sines('event_time')} FROM ticker")
def cyclic_time(spark, sf_dir):
    encoded = encode_time(fr.tickers(spark, sf_dir)).select("last_trade_id", *TICKER_FEATURES.time_features)
    return _round(encoded, TICKER_FEATURES.time_features)


_SCALED = {
    "second_of_minute": "second(date) / 59.0::DOUBLE",
    "minute_of_hour": "minute(date) / 59.0::DOUBLE",
    "hour_of_day": "hour(date) / 23.0::DOUBLE",
    "day_of_week": "(isodow(date) - 1) / 6.0::DOUBLE",
    "day_of_month": "(day(date) - 1) / 30.0::DOUBLE",
    "day_of_year": "(dayofyear(date) - 1) / 365.0::DOUBLE",
    "month_of_year": "(month(date) - 1) / 11.0::DOUBLE",
    "week_of_year": "(weekofyear(date) - 1) / 52.0::DOUBLE",
}


def _register_scaled(freq: str) -> None:
    names = cal.features_for_freq(freq)
    columns = "".join(f", ROUND({_SCALED[n]} - 0.5, 6) AS {n}" for n in names)
    source = f"{fr.DAILY_SQL}, s AS (SELECT date FROM daily)" if freq in "dwm" else (
        "s AS (SELECT ts AS date FROM events)"
    )

    @query(f"time_features_{freq}", f"WITH {source} SELECT date{columns} FROM s")
    def scaled(spark, sf_dir):
        if freq in "dwm":
            rows = fr.daily_series(spark, sf_dir).select("date")
        else:
            rows = fr.events(spark, sf_dir).select(F.col("ts").alias("date"))
        built = [F.round(c, 6).alias(n) for n, c in cal.time_features(F.col("date"), freq).items()]
        return rows.select("date", *built)


for _freq in "htsdwm":
    _register_scaled(_freq)


@query(
    "time_marks_t",
    """SELECT event_id, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
    CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour,
    CAST(minute(ts) // 15 AS INTEGER) AS minute FROM events""",
)
def time_marks_t(spark, sf_dir):
    marks = [c.alias(n) for n, c in cal.time_marks(F.col("ts"), "t").items()]
    return fr.events(spark, sf_dir).select("event_id", *marks)


_MINMAX_LONG = " UNION ALL ".join(
    f"SELECT symbol, '{c}' AS feature, CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max "
    "FROM ticker GROUP BY symbol"
    for c in TICK
)


@query("minmax_fit", f"WITH {USERS} {_MINMAX_LONG}")
def minmax_fit(spark, sf_dir):
    stats = sc.fit_minmax(fr.tickers(spark, sf_dir, "user_id"), ["symbol"], TICK)
    return sc.minmax_table(stats, ["symbol"], TICK)


_OVER = ", ".join(
    f"MIN({c}) OVER (PARTITION BY symbol) AS {c}_min, MAX({c}) OVER (PARTITION BY symbol) AS {c}_max"
    for c in TICK
)


@query("minmax_over", f"WITH {USERS} SELECT symbol, event_time, {', '.join(TICK)}, {_OVER} FROM ticker")
def minmax_over(spark, sf_dir):
    rows = select_features(fr.tickers(spark, sf_dir, "user_id"))
    return sc.minmax_over(rows, ["symbol"], TICK)


_SCALE_MINMAX = ", ".join(
    f"ROUND(CASE WHEN {c}_max <> {c}_min THEN ({c} - {c}_min) / CAST({c}_max - {c}_min AS DOUBLE) ELSE 0.0 END, 6) AS {c}"
    for c in TICK
)


@query(
    "minmax_transform",
    f"""WITH {USERS}, o AS (SELECT symbol, event_time, {', '.join(TICK)}, {_OVER} FROM ticker)
    SELECT symbol, event_time, {_SCALE_MINMAX} FROM o""",
)
def minmax_transform(spark, sf_dir):
    rows = select_features(fr.tickers(spark, sf_dir, "user_id"))
    stats = sc.fit_minmax(rows, ["symbol"], TICK)
    return _round(sc.minmax_transform(rows, stats, ["symbol"], TICK), TICK)


@query(
    "minmax_inverse",
    f"""WITH {USERS} SELECT symbol, event_time, {', '.join(f'ROUND(CAST({c} AS DOUBLE), 6) AS {c}' for c in TICK)}
    FROM ticker""",
)
def minmax_inverse(spark, sf_dir):
    """Scaling and its inverse give the prices back."""
    rows = select_features(fr.tickers(spark, sf_dir, "user_id"))
    stats = sc.fit_minmax(rows, ["symbol"], TICK)
    scaled = sc.minmax_transform(rows, stats, ["symbol"], TICK)
    return _round(sc.minmax_inverse(scaled, stats, ["symbol"], TICK), TICK)


@query(
    "attach_stats",
    f"""WITH {USERS}, s AS (SELECT symbol, MIN(last_price) AS last_price_min, MAX(last_price) AS last_price_max
    FROM ticker GROUP BY symbol) SELECT t.symbol, last_trade_id, last_price_min, last_price_max
    FROM ticker t LEFT JOIN s ON t.symbol = s.symbol""",
)
def attach_stats(spark, sf_dir):
    rows = fr.tickers(spark, sf_dir, "user_id").select("symbol", "last_trade_id", "last_price")
    stats = sc.fit_minmax(rows, ["symbol"], ["last_price"])
    return sc.attach_stats(rows.drop("last_price"), stats, ["symbol"])


VECTOR = [*fr.FEATURES, "target"]
_TRAIN_STATS = "st AS (SELECT " + ", ".join(
    f"AVG({c}) AS {c}_mean, stddev_pop({c}) AS {c}_std" for c in VECTOR
) + " FROM vec WHERE position < FLOOR(n * 0.7::DOUBLE))"


def _vector_placed(spark, sf_dir):
    return pos.with_position(fr.vector_series(spark, sf_dir), ["series"], ["date"], length="series_length")


def _train_rows(df):
    return df.filter(F.col("position") < F.floor(F.col("series_length") * F.lit(0.7)))


@query(
    "standard_fit",
    f"WITH {fr.VECTOR_SQL}, {_TRAIN_STATS} SELECT "
    + ", ".join(f"ROUND({c}_{s}, 8) AS {c}_{s}" for c in VECTOR for s in ("mean", "std")) + " FROM st",
)
def standard_fit(spark, sf_dir):
    stats = sc.fit_standard(_train_rows(_vector_placed(spark, sf_dir)), VECTOR)
    return _round(stats, stats.columns, 8)


@query(
    "standard_transform",
    f"WITH {fr.VECTOR_SQL}, {_TRAIN_STATS} SELECT date, "
    + ", ".join(f"ROUND(({c} - {c}_mean) / {c}_std, 6) AS {c}" for c in VECTOR) + " FROM vec, st",
)
def standard_transform(spark, sf_dir):
    placed = _vector_placed(spark, sf_dir)
    stats = sc.fit_standard(_train_rows(placed), VECTOR)
    scaled = sc.standard_transform(placed.select("date", *VECTOR), stats, VECTOR)
    return _round(scaled, VECTOR)


@query(
    "standard_inverse",
    f"WITH {fr.VECTOR_SQL} SELECT date, " + ", ".join(f"ROUND({c}, 6) AS {c}" for c in VECTOR) + " FROM vec",
)
def standard_inverse(spark, sf_dir):
    placed = _vector_placed(spark, sf_dir)
    stats = sc.fit_standard(_train_rows(placed), VECTOR)
    scaled = sc.standard_transform(placed.select("date", *VECTOR), stats, VECTOR)
    return _round(sc.standard_inverse(scaled, stats, VECTOR), VECTOR)


@query(
    "standard_inverse_target",
    f"""WITH {fr.VECTOR_SQL}, {_TRAIN_STATS} SELECT date, ROUND(f0 * target_std + target_mean, 6) AS forecast
    FROM vec, st""",
)
def standard_inverse_target(spark, sf_dir):
    """A single forecast column is restored with the statistics of the last column."""
    placed = _vector_placed(spark, sf_dir)
    stats = sc.fit_standard(_train_rows(placed), VECTOR)
    one = placed.select("date", F.col("f0").alias("forecast"))
    return _round(sc.standard_inverse(one, stats, ["forecast"]), ["forecast"])


for _mode, _columns in (("M", VECTOR), ("S", ["target"]), ("MS", ["f1", "f3", "target"])):

    def _register_mode(mode: str, columns: list[str]) -> None:
        picked = ", ".join(f"ROUND({c}, 6) AS {c}" for c in columns)

        @query(f"feature_mode_{mode.lower()}", f"WITH {fr.VECTOR_SQL} SELECT date, {picked} FROM vec")
        def moded(spark, sf_dir):
            rows = fr.vector_series(spark, sf_dir).drop("series")
            subset = columns if mode == "MS" else None
            return _round(feature_mode(rows, mode, "target", subset), columns)

    _register_mode(_mode, _columns)


@query("series_position", f"WITH {PLACED} SELECT symbol, event_time, last_price, position, series_length FROM placed")
def series_position(spark, sf_dir):
    rows = fr.tickers(spark, sf_dir, "user_id").select("symbol", "event_time", "last_price")
    return pos.with_position(rows, ["symbol"], ["event_time"], length="series_length")


@query(
    "series_position_long",
    f"""WITH {fr.trade_sql()} SELECT symbol, trade_id,
    ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY trade_time, trade_id) - 1 AS position FROM trade""",
)
def series_position_long(spark, sf_dir):
    """Few, long series spread over more partitions than there are symbols."""
    rows = fr.trades(spark, sf_dir).select("symbol", "trade_time", "trade_id")
    placed = pos.with_position(rows, ["symbol"], ["trade_time", "trade_id"], partitions=32)
    return placed.drop("trade_time")


_SPLITS = "CAST(FLOOR(n * 0.7::DOUBLE) AS BIGINT)", "CAST(FLOOR(n * 0.2::DOUBLE) AS BIGINT)"


@query(
    "series_profile",
    f"""WITH {USERS}, c AS (SELECT symbol, COUNT(*) AS n FROM ticker GROUP BY symbol)
    SELECT symbol, n, {_SPLITS[0]} AS n_train, {_SPLITS[1]} AS n_val, n - {_SPLITS[0]} - {_SPLITS[1]} AS n_test,
    GREATEST(n - 59, 0) AS samples, n >= 60 AS enough FROM c""",
)
def series_profile(spark, sf_dir):
    return pos.series_profile(fr.tickers(spark, sf_dir, "user_id"), ["symbol"], 48, 12)


@query("last_event_time", f"WITH {USERS} SELECT symbol, MAX(event_time) AS event_time FROM ticker GROUP BY symbol")
def last_event_time(spark, sf_dir):
    return pos.last_times(fr.tickers(spark, sf_dir, "user_id"), ["symbol"])


SPLIT_SQL = f"""{PLACED}, cut AS (SELECT *, CAST(FLOOR(series_length * 0.7::DOUBLE) AS BIGINT) AS nt,
    CAST(FLOOR(series_length * 0.2::DOUBLE) AS BIGINT) AS nv FROM placed), split AS (SELECT *,
    CASE WHEN position < nt THEN 'train' WHEN position < nt + nv THEN 'val' ELSE 'test' END AS split,
    CASE WHEN position < nt THEN position WHEN position < nt + nv THEN position - nt
    ELSE position - nt - nv END AS split_position,
    CASE WHEN position < nt THEN nt WHEN position < nt + nv THEN nv ELSE series_length - nt - nv END
    AS split_length FROM cut)"""


@query(
    "split_ratio",
    f"WITH {SPLIT_SQL} SELECT symbol, event_time, position, series_length, split, split_position, split_length FROM split",
)
def split_ratio(spark, sf_dir):
    rows = fr.tickers(spark, sf_dir, "user_id").select("symbol", "event_time")
    return pos.split_ratio(pos.with_position(rows, ["symbol"], ["event_time"], length="series_length"))


def _split_sql(borders: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT date, '{name}' AS split, CAST(position - GREATEST({lo}, 0) AS BIGINT) AS split_position "
        f"FROM placed WHERE position >= {lo} AND position < {hi}"
        for name, (lo, hi) in borders.items()
    )


@query(
    "split_calendar",
    f"WITH {fr.DAILY_SQL} "
    + _split_sql({"train": ("0", "360"), "val": ("360 - 48", "480"), "test": ("480 - 48", "600")}),
)
def split_calendar(spark, sf_dir):
    placed = pos.with_position(fr.daily_series(spark, sf_dir).select("series", "date"), ["series"], ["date"])
    return pos.split_calendar(placed, rows_per_day=1, lookback=48).select("date", "split", "split_position")


_NT, _NE = "CAST(FLOOR(series_length * 0.7::DOUBLE) AS BIGINT)", "CAST(FLOOR(series_length * 0.2::DOUBLE) AS BIGINT)"


@query(
    "split_custom",
    f"WITH {fr.DAILY_SQL} "
    + _split_sql(
        {
            "train": ("0", _NT),
            "val": (f"{_NT} - 48", f"series_length - {_NE}"),
            "test": (f"series_length - {_NE} - 48", "series_length"),
        }
    ),
)
def split_custom(spark, sf_dir):
    rows = fr.daily_series(spark, sf_dir).select("series", "date")
    placed = pos.with_position(rows, ["series"], ["date"], length="series_length")
    return pos.split_custom(placed, lookback=48).select("date", "split", "split_position")
