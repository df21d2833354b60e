"""Queries of the sample, forecast, model and metric operators."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidemark.functions import calendar as cal
from tidemark.operators import metrics as met, models as mod, positions as pos, sequences as seqs
from tidemark.operators.scaling import fit_minmax, minmax_transform
from tidemark.plans import forecasting as fc
from tidemark.schemas import TICKER_FEATURES
from tidemark.session import scratch_path
from tidemark.streaming.sinks import publish_forecast
from tidemark.workload import frames as fr
from tidemark.workload.features import PLACED, SPLIT_SQL, TICK, _sines
from tidemark.workload.registry import query

SEQ, PRED, LABEL = 12, 4, 8
SPAN = SEQ + PRED
MARKS = list(TICKER_FEATURES.time_features)


def cells(df: DataFrame, keys: Sequence[str], lane: str, names: Sequence[str], digits: int = 5) -> DataFrame:
    """Array rows of one lane as plain rows: keys, lane, step, values."""
    steps = df.select(*keys, F.posexplode(lane).alias("step", "_v"))
    values = [F.round(F.col("_v")[i].cast("double"), digits).alias(n) for i, n in enumerate(names)]
    return steps.select(*keys, F.lit(lane).alias("lane"), "step", *values)


def _placed(spark, sf_dir):
    rows = fr.tickers(spark, sf_dir, "user_id").select("symbol", "event_time", *TICK)
    return pos.with_position(rows, ["symbol"], ["event_time"], length="series_length")


@query(
    "windows_index",
    f"""WITH {PLACED} SELECT symbol, position AS sample_id, position AS start_pos FROM placed
    WHERE position <= series_length - {SPAN}""",
)
def windows_index(spark, sf_dir):
    return seqs.windows_index(_placed(spark, sf_dir), ["symbol"], SEQ, PRED)


@query(
    "windows_index_stride",
    f"""WITH {PLACED} SELECT symbol, position // 5 AS sample_id, position AS start_pos FROM placed
    WHERE position <= series_length - {SPAN} AND position % 5 = 0""",
)
def windows_index_stride(spark, sf_dir):
    return seqs.windows_index(_placed(spark, sf_dir), ["symbol"], SEQ, PRED, stride=5)


def _float(c: str, digits: int = 5) -> str:
    return f"ROUND(CAST(CAST({c} AS FLOAT) AS DOUBLE), {digits})"


def _lane_sql(lane: str, lo: int, hi: int, columns: Sequence[str], keys="p.symbol", source="placed",
              position="position", length="series_length", same="p.symbol = s.symbol") -> str:
    values = ", ".join(f"{_float('p.' + c)} AS {c}" for c in columns)
    return f"""SELECT {keys}, s.{position} AS sample_id, '{lane}' AS lane,
    CAST(p.{position} - s.{position} - {lo} AS INTEGER) AS step, {values} FROM {source} s JOIN {source} p
    ON {same} AND p.{position} >= s.{position} + {lo} AND p.{position} < s.{position} + {hi}
    WHERE s.{position} <= s.{length} - {SPAN}"""


def _windows(spark, sf_dir, padding=0.0, **options):
    placed = fc.encode_time(_placed(spark, sf_dir))
    return seqs.make_windows(
        placed, ["symbol"], TICK, MARKS, SEQ, PRED, LABEL, padding=padding, block=20, **options
    )


def windows_of(spark, sf_dir, seq: int, pred: int) -> DataFrame:
    """Materialised samples of the few long series."""
    rows = fr.tickers(spark, sf_dir).select("symbol", "event_time", "last_trade_id", *TICK)
    placed = pos.with_position(rows, ["symbol"], ["event_time", "last_trade_id"])
    return seqs.make_windows(fc.encode_time(placed), ["symbol"], TICK, MARKS, seq, pred)


@query(
    "windows_materialized",
    f"WITH {PLACED} {_lane_sql('x', 0, SEQ, TICK)} UNION ALL {_lane_sql('y', SEQ, SPAN, TICK)}",
)
def windows_materialized(spark, sf_dir):
    samples = _windows(spark, sf_dir)
    keys = ["symbol", "sample_id"]
    return cells(samples, keys, "x", TICK).unionByName(cells(samples, keys, "y", TICK))


_MARKED = f"{PLACED}, marked AS (SELECT symbol, position, series_length, {_sines('event_time', 12)} FROM placed)"


@query(
    "window_marks",
    f"WITH {_MARKED} {_lane_sql('x_mark', 0, SEQ, MARKS, source='marked')} UNION ALL "
    f"{_lane_sql('x_mark_dec', SEQ - LABEL, SPAN, MARKS, source='marked')}",
)
def window_marks(spark, sf_dir):
    samples = _windows(spark, sf_dir)
    keys = ["symbol", "sample_id"]
    return cells(samples, keys, "x_mark", MARKS).unionByName(cells(samples, keys, "x_mark_dec", MARKS))


def _decoder_sql(padding: int) -> str:
    blank = ", ".join(f"CAST({padding} AS DOUBLE) AS {c}" for c in TICK)
    known = _lane_sql("x_dec", SEQ - LABEL, SEQ, TICK)
    return f"""WITH {PLACED} {known} UNION ALL SELECT symbol, position AS sample_id, 'x_dec' AS lane,
    CAST({LABEL} + h AS INTEGER) AS step, {blank} FROM placed, generate_series(0, {PRED - 1}) g(h)
    WHERE position <= series_length - {SPAN}"""


@query("decoder_input_zeros", _decoder_sql(0))
def decoder_input_zeros(spark, sf_dir):
    return cells(_windows(spark, sf_dir), ["symbol", "sample_id"], "x_dec", TICK)


@query("decoder_input_ones", _decoder_sql(1))
def decoder_input_ones(spark, sf_dir):
    return cells(_windows(spark, sf_dir, padding=1.0), ["symbol", "sample_id"], "x_dec", TICK)


_SCALED_PRICE = f"""{PLACED}, w AS (SELECT *, MIN(last_price) OVER (PARTITION BY symbol) AS lo,
    MAX(last_price) OVER (PARTITION BY symbol) AS hi FROM placed), scaled AS (SELECT symbol, position,
    series_length, last_price AS raw, CASE WHEN hi <> lo THEN (last_price - lo) / (hi - lo) ELSE 0 END AS price
    FROM w)"""


def _overlap(spark, sf_dir, inverse):
    placed = fc.encode_time(_placed(spark, sf_dir)).withColumn("raw", F.col("last_price"))
    stats = fit_minmax(placed, ["symbol"], ["last_price"])
    scaled = minmax_transform(placed, stats, ["symbol"], ["last_price"])
    samples = seqs.windows_overlap(
        scaled, ["symbol"], ["last_price"], ["raw"], MARKS, SEQ, LABEL, PRED, inverse, block=20
    )
    return cells(samples, ["symbol", "sample_id"], "y", ["price"])


@query("windows_overlap", f"WITH {_SCALED_PRICE} {_lane_sql('y', SEQ - LABEL, SPAN, ['price'], source='scaled')}")
def windows_overlap(spark, sf_dir):
    return _overlap(spark, sf_dir, False)


@query(
    "windows_overlap_inverse",
    f"""WITH {_SCALED_PRICE} SELECT p.symbol, s.position AS sample_id, 'y' AS lane,
    CAST(p.position - s.position - {SEQ - LABEL} AS INTEGER) AS step,
    CASE WHEN p.position - s.position < {SEQ} THEN {_float('p.price')} ELSE {_float('p.raw')} END AS price
    FROM scaled s JOIN scaled p ON p.symbol = s.symbol AND p.position >= s.position + {SEQ - LABEL}
    AND p.position < s.position + {SPAN} WHERE s.position <= s.series_length - {SPAN}""",
)
def windows_overlap_inverse(spark, sf_dir):
    return _overlap(spark, sf_dir, True)


@query(
    "prediction_frame",
    f"""WITH {PLACED} SELECT symbol, event_time, last_price, CAST(position - series_length + 1 AS INTEGER) AS step,
    FALSE AS is_future FROM placed WHERE position >= series_length - {SEQ} UNION ALL
    SELECT symbol, event_time + h * INTERVAL 15 MINUTE, NULL, CAST(h AS INTEGER), TRUE FROM placed,
    generate_series(1, {PRED}) g(h) WHERE position = series_length - 1""",
)
def prediction_frame(spark, sf_dir):
    placed = _placed(spark, sf_dir).select("symbol", "event_time", "last_price", "position", "series_length")
    return seqs.prediction_frame(placed, ["symbol"], "event_time", SEQ, PRED, "15min")


_RESTORED = ", ".join(
    f"""ROUND(CASE WHEN {c}_hi <> {c}_lo THEN CAST(CAST(({c} - {c}_lo) / CAST({c}_hi - {c}_lo AS DOUBLE) AS FLOAT)
    AS DOUBLE) ELSE 0 END * ({c}_hi - {c}_lo) + {c}_lo, 6) AS {c}"""
    for c in TICK
)
_BOUNDS = ", ".join(
    f"MIN({c}) OVER (PARTITION BY symbol) AS {c}_lo, MAX({c}) OVER (PARTITION BY symbol) AS {c}_hi" for c in TICK
)


@query(
    "decode_forecast",
    f"""WITH {PLACED}, b AS (SELECT *, {_BOUNDS} FROM placed)
    SELECT symbol, event_time + h * INTERVAL 1 SECOND AS event_time, {_RESTORED}
    FROM b, generate_series(1, {PRED}) g(h) WHERE position = series_length - 1""",
)
def decode_forecast(spark, sf_dir):
    """Forecast table of the naive model: the last row, restored and stamped once per second."""
    forecast = fc.forecast_table(
        fr.tickers(spark, sf_dir, "user_id"), SEQ, PRED, lambda s: mod.predict_naive(s, SEQ, PRED)
    )
    return forecast.withColumns({c: F.round(c, 6) for c in TICK})


@query(
    "forecast_input_marks",
    f"""WITH {PLACED}, future AS (SELECT symbol, event_time + h * INTERVAL 1 SECOND AS event_time,
    {LABEL} + h - 1 AS step FROM placed, generate_series(1, {PRED}) g(h) WHERE position = series_length - 1),
    known AS (SELECT symbol, event_time, position - series_length + {LABEL} AS step FROM placed
    WHERE position >= series_length - {LABEL}), rows AS (SELECT * FROM known UNION ALL SELECT * FROM future)
    SELECT symbol, 'x_mark_dec' AS lane, CAST(step AS INTEGER) AS step, {_sines('event_time', 5)} FROM rows""",
)
def forecast_input_marks(spark, sf_dir):
    frame = fc.feature_frame(fr.tickers(spark, sf_dir, "user_id"))
    return cells(fc.forecast_input(frame, SEQ, PRED), ["symbol"], "x_mark_dec", MARKS)


@query(
    "batch_ids",
    f"""WITH {PLACED}, s AS (SELECT symbol, position AS sample_id, position AS start_pos FROM placed
    WHERE position <= series_length - {SPAN}), n AS (SELECT *, COUNT(*) OVER (PARTITION BY symbol) AS c FROM s)
    SELECT symbol, sample_id, start_pos, sample_id // 16 AS batch_id FROM n WHERE sample_id // 16 < c // 16""",
)
def batch_ids(spark, sf_dir):
    index = seqs.windows_index(_placed(spark, sf_dir), ["symbol"], SEQ, PRED)
    return seqs.with_batch_id(index, ["symbol"], 16)


@query(
    "shuffled_batches",
    f"""WITH {PLACED}, s AS (SELECT symbol, position AS start_pos, (position % 2147483647 * 48271 + 7) % 2147483647 AS x
    FROM placed WHERE position <= series_length - {SPAN}),
    r AS (SELECT symbol, start_pos, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY
    (x * x % 2147483647 * 69621 + x) % 2147483647, start_pos) - 1 AS sample_id, COUNT(*) OVER (PARTITION BY symbol) AS c FROM s)
    SELECT symbol, sample_id, start_pos, sample_id // 16 AS batch_id FROM r WHERE sample_id // 16 < c // 16""",
)
def shuffled_batches(spark, sf_dir):
    index = seqs.windows_index(_placed(spark, sf_dir), ["symbol"], SEQ, PRED)
    return seqs.with_batch_id(seqs.shuffle_samples(index, ["symbol"], seed=7), ["symbol"], 16)


_FEW_SEQ, _FEW_PRED = 6, 2


def _sample_sql(source: str, keys: str, same: str, position: str, length: str) -> str:
    span = _FEW_SEQ + _FEW_PRED
    values = ", ".join(f"{_float('p.' + c)} AS {c}" for c in [*TICK, *MARKS])
    return f"""SELECT {keys}, s.{position} AS sample_id, CAST(p.{position} - s.{position} AS INTEGER) AS step,
    {values} FROM {source} s JOIN {source} p ON {same} AND p.{position} >= s.{position}
    AND p.{position} < s.{position} + {_FEW_SEQ} WHERE s.{position} <= s.{length} - {span}"""


_SCALE_TICK = ", ".join(
    f"""CASE WHEN MAX({c}) OVER w <> MIN({c}) OVER w THEN ({c} - MIN({c}) OVER w) /
    CAST(MAX({c}) OVER w - MIN({c}) OVER w AS DOUBLE) ELSE 0.0 END AS {c}"""
    for c in TICK
)


def _encoded_cells(samples, keys):
    steps = samples.select(*keys, F.posexplode(F.arrays_zip("x", "x_mark")).alias("step", "_v"))
    values = [F.col("_v.x")[i].alias(n) for i, n in enumerate(TICK)]
    values += [F.col("_v.x_mark")[i].alias(n) for i, n in enumerate(MARKS)]
    wide = steps.select(*keys, "step", *values)
    return wide.withColumns({n: F.round(F.col(n).cast("double"), 5) for n in [*TICK, *MARKS]})


@query(
    "feature_samples",
    f"""WITH {SPLIT_SQL}, enc AS (SELECT symbol, split, split_position, split_length, {_SCALE_TICK},
    {_sines('event_time', 12)} FROM split WINDOW w AS (PARTITION BY symbol)) """
    + _sample_sql("enc", "p.symbol, p.split", "p.symbol = s.symbol AND p.split = s.split",
                    "split_position", "split_length"),
)
def feature_samples(spark, sf_dir):
    samples = fc.prepare_training(fr.tickers(spark, sf_dir, "user_id"), _FEW_SEQ, _FEW_PRED)
    return _encoded_cells(samples, ["symbol", "split", "sample_id"])


@query(
    "feature_frame_train_fit",
    f"""WITH {SPLIT_SQL}, st AS (SELECT symbol, MIN(last_price) AS lo, MAX(last_price) AS hi FROM split
    WHERE split = 'train' GROUP BY symbol) SELECT split.symbol, position,
    ROUND(CASE WHEN hi <> lo THEN (last_price - lo) / (hi - lo) ELSE 0.0 END, 6) AS last_price
    FROM split LEFT JOIN st ON split.symbol = st.symbol""",
)
def feature_frame_train_fit(spark, sf_dir):
    frame = fc.feature_frame(fr.tickers(spark, sf_dir, "user_id"), fit_on="train")
    return frame.select("symbol", "position", F.round("last_price", 6).alias("last_price"))


@query(
    "prediction_samples",
    f"""WITH {PLACED}, enc AS (SELECT symbol, position, series_length, {_SCALE_TICK}, {_sines('event_time', 12)}
    FROM placed WINDOW w AS (PARTITION BY symbol)) """
    + _sample_sql("enc", "p.symbol", "p.symbol = s.symbol", "position", "series_length"),
)
def prediction_samples(spark, sf_dir):
    samples = fc.prepare_prediction(fr.tickers(spark, sf_dir, "user_id"), _FEW_SEQ, _FEW_PRED)
    return _encoded_cells(samples, ["symbol", "sample_id"])


# --- metrics over (pred, true) pairs of the previous-value forecast ----------------------------

_PAIRS = f"""{fr.trade_sql()}, lagged AS (SELECT symbol, trade_time, price AS actual,
    LAG(price) OVER (PARTITION BY symbol ORDER BY trade_time, trade_id) AS pred FROM trade),
    pairs AS (SELECT * FROM lagged WHERE pred IS NOT NULL)"""


def pairs(spark, sf_dir):
    rows = fr.trades(spark, sf_dir).select("symbol", "trade_time", "trade_id", F.col("price").alias("true"))
    placed = pos.with_position(rows, ["symbol"], ["trade_time", "trade_id"])
    return pos.shifted(placed, ["symbol"], ["true"]).withColumnRenamed("true_before", "pred")


_METRICS = """ROUND(AVG(ABS(pred - actual)), 6) AS mae, ROUND(AVG((pred - actual) * (pred - actual)), 3) AS mse,
    ROUND(SQRT(AVG((pred - actual) * (pred - actual))), 6) AS rmse,
    ROUND(AVG(ABS((pred - actual) / nullif(actual, 0))), 6) AS mape,
    ROUND(AVG(((pred - actual) / nullif(actual, 0)) * ((pred - actual) / nullif(actual, 0))), 4) AS mspe"""


def _rounded_metrics(df):
    digits = {"mae": 6, "mse": 3, "rmse": 6, "mape": 6, "mspe": 4}
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("metrics_overall", f"WITH {_PAIRS} SELECT {_METRICS} FROM pairs")
def metrics_overall(spark, sf_dir):
    return _rounded_metrics(met.forecast_metrics(pairs(spark, sf_dir)))


@query("metrics_by_symbol", f"WITH {_PAIRS} SELECT symbol, {_METRICS} FROM pairs GROUP BY symbol")
def metrics_by_symbol(spark, sf_dir):
    return _rounded_metrics(met.forecast_metrics(pairs(spark, sf_dir), ["symbol"]))


@query(
    "metric_rse",
    f"""WITH {_PAIRS}, m AS (SELECT AVG(actual) AS mt FROM pairs) SELECT ROUND(SQRT(SUM((actual - pred) * (actual - pred)))
    / SQRT(SUM((actual - mt) * (actual - mt))), 8) AS rse FROM pairs, m""",
)
def metric_rse(spark, sf_dir):
    return met.metric_rse(pairs(spark, sf_dir)).select(F.round("rse", 8).alias("rse"))


@query(
    "metric_corr",
    f"""WITH {_PAIRS}, m AS (SELECT symbol, AVG(actual) AS mt, AVG(pred) AS mp FROM pairs GROUP BY symbol),
    c AS (SELECT symbol, SUM((actual - mt) * (pred - mp)) / SQRT(SUM(((actual - mt) * (pred - mp)) *
    ((actual - mt) * (pred - mp)))) AS corr FROM pairs JOIN m USING (symbol) GROUP BY symbol)
    SELECT ROUND(AVG(corr), 6) AS corr FROM c""",
)
def metric_corr(spark, sf_dir):
    """Every symbol is one output column."""
    return met.metric_corr(pairs(spark, sf_dir), ["symbol"]).select(F.round("corr", 6).alias("corr"))


@query("metric_pearson", f"WITH {_PAIRS} SELECT symbol, ROUND(CORR(pred, actual), 6) AS pearson FROM pairs GROUP BY symbol")
def metric_pearson(spark, sf_dir):
    return met.pearson(pairs(spark, sf_dir), ["symbol"]).withColumn("pearson", F.round("pearson", 6))


# --- models -----------------------------------------------------------------------------------


def _splits(spark, sf_dir, seq=_FEW_SEQ, pred=_FEW_PRED, placed=None):
    return fc.prepare_training(fr.tickers(spark, sf_dir, "user_id"), seq, pred, placed=placed)


_NAIVE_ERRORS = f"""{SPLIT_SQL}, enc AS (SELECT symbol, split, split_position, split_length, {_SCALE_TICK}
    FROM split WINDOW w AS (PARTITION BY symbol)), pr AS (SELECT t.symbol, t.split, UNNEST([
    {', '.join(f'CAST(CAST(l.{c} AS FLOAT) AS DOUBLE)' for c in TICK)}]) AS pred, UNNEST([
    {', '.join(f'CAST(CAST(t.{c} AS FLOAT) AS DOUBLE)' for c in TICK)}]) AS actual
    FROM enc l JOIN enc t ON l.symbol = t.symbol AND l.split = t.split
    AND t.split_position > l.split_position AND t.split_position <= l.split_position + {_FEW_PRED}
    WHERE l.split_position >= {_FEW_SEQ - 1} AND l.split_position <= l.split_length - {_FEW_PRED} - 1)"""


@query("naive_backtest", f"WITH {_NAIVE_ERRORS} SELECT {_METRICS} FROM pr WHERE split = 'test'")
def naive_backtest(spark, sf_dir):
    test = _splits(spark, sf_dir).filter("split = 'test'")
    return _rounded_metrics(fc.backtest_naive(test, ["symbol"], _FEW_SEQ, _FEW_PRED))


@query(
    "validation_loss",
    f"""WITH {_NAIVE_ERRORS}, a AS (SELECT DISTINCT symbol FROM pr WHERE split = 'train'), l AS (SELECT symbol,
    AVG((pred - actual) * (pred - actual)) AS v FROM pr WHERE split = 'val' GROUP BY symbol)
    SELECT a.symbol, ROUND(COALESCE(v, 0.0), 6) AS val_loss FROM a LEFT JOIN l ON a.symbol = l.symbol""",
)
def validation_loss(spark, sf_dir):
    """Validation error of a trained model that repeats the last row."""
    samples = _splits(spark, sf_dir)
    repeat_last = mod.train_per_symbol(
        samples.filter("split = 'train'"), lambda shard: np.ones(len(TICK)), ["symbol"],
        shard_samples=2_000, columns=[],
    )

    def score(lanes, params, pred):
        last = lanes["x"][:, -1:, :].astype(float)
        return np.repeat(last * np.stack(params)[:, None, :], pred, axis=1)

    losses = mod.evaluate(samples.filter("split = 'val'"), repeat_last, score, ["symbol"], _FEW_PRED)
    return losses.select("symbol", F.round("val_loss", 6).alias("val_loss"))


_ALPHA = 0.01
_CELLS = f"""{SPLIT_SQL}, enc AS (SELECT symbol, split, split_position, split_length, {_SCALE_TICK}
    FROM split WINDOW w AS (PARTITION BY symbol)), q AS (SELECT symbol, split, split_position AS sp,
    split_length AS sn, UNNEST([0, 1, 2, 3]) AS feature,
    UNNEST([{', '.join(f'CAST(CAST({c} AS FLOAT) AS DOUBLE)' for c in TICK)}]) AS v FROM enc),
    starts AS (SELECT l.symbol, l.split, l.feature, l.sp, l.v AS x, t.v AS y FROM q l JOIN q t
    ON l.symbol = t.symbol AND l.split = t.split AND l.feature = t.feature AND t.sp = l.sp + 1
    WHERE l.sp >= {_FEW_SEQ - 1} AND l.sp <= l.sn - {_FEW_PRED} - 1),
    sums AS (SELECT symbol, feature, COUNT(*) AS n, SUM(x) AS sx, SUM(y) AS sy, SUM(x * x) AS sxx, SUM(x * y) AS sxy
    FROM starts WHERE split = 'train' GROUP BY symbol, feature),
    fit AS (SELECT symbol, feature, n, ((sxx + {_ALPHA}) * sy - sx * sxy) / det AS a,
    ((n + {_ALPHA}) * sxy - sx * sy) / det AS b
    FROM (SELECT *, (n + {_ALPHA}) * (sxx + {_ALPHA}) - sx * sx AS det FROM sums))"""


def _lag_one(spark, sf_dir):
    samples = _splits(spark, sf_dir)
    return samples, mod.fit_ridge(samples.filter("split = 'train'"), ["symbol"], _FEW_SEQ, lags=1, alpha=_ALPHA)


@query(
    "ridge_fit_lag1",
    f"WITH {_CELLS} SELECT symbol, CAST(feature AS INTEGER) AS feature, n, ROUND(a, 6) AS intercept, ROUND(b, 6) AS slope FROM fit",
)
def ridge_fit_lag1(spark, sf_dir):
    """Autoregression on the previous value: two numbers per symbol and feature."""
    _, model = _lag_one(spark, sf_dir)
    rows = model.select("symbol", "n", F.explode(F.sequence(F.lit(0), F.lit(len(TICK) - 1))).alias("feature"), "params")
    return rows.select(
        "symbol", "feature", "n",
        F.round(F.col("params")[F.col("feature") * 2], 6).alias("intercept"),
        F.round(F.col("params")[F.col("feature") * 2 + 1], 6).alias("slope"),
    )


@query(
    "ridge_validation_lag1",
    f"""WITH {_CELLS}, steps AS (SELECT s.symbol, s.feature, s.sp, h, CASE WHEN h = 1 THEN a + b * x
    ELSE a + b * (a + b * x) END AS p FROM starts s JOIN fit USING (symbol, feature), generate_series(1, {_FEW_PRED}) g(h)
    WHERE s.split = 'val'), loss AS (SELECT s.symbol, AVG((p - v) * (p - v)) AS l FROM steps s JOIN q
    ON q.symbol = s.symbol AND q.split = 'val' AND q.feature = s.feature AND q.sp = s.sp + h GROUP BY s.symbol)
    SELECT f.symbol, ROUND(COALESCE(l, 0.0), 6) AS val_loss FROM (SELECT DISTINCT symbol FROM fit) f
    LEFT JOIN loss ON f.symbol = loss.symbol""",
)
def ridge_validation_lag1(spark, sf_dir):
    """Validation error of that model over two forecast steps."""
    samples, model = _lag_one(spark, sf_dir)
    losses = mod.evaluate(samples.filter("split = 'val'"), model, mod.ridge_score(1), ["symbol"], _FEW_PRED)
    return losses.select("symbol", F.round("val_loss", 6).alias("val_loss"))


def _lag_steps(split: str, fit: str = "fit") -> str:
    """Forecast and actual cells of a lag-1 model over two steps."""
    return f"""SELECT s.symbol, CASE WHEN h = 1 THEN a + b * x ELSE a + b * (a + b * x) END AS pred, v AS actual
    FROM starts s JOIN {fit} f ON f.symbol = s.symbol AND f.feature = s.feature, generate_series(1, {_FEW_PRED}) g(h)
    JOIN q ON q.symbol = s.symbol AND q.split = s.split AND q.feature = s.feature AND q.sp = s.sp + h
    WHERE s.split = '{split}'"""


@query(
    "ridge_backtest_lag1",
    f"WITH {_CELLS}, cells AS ({_lag_steps('test')}) SELECT symbol, {_METRICS} FROM cells GROUP BY symbol",
)
def ridge_backtest_lag1(spark, sf_dir):
    """Errors of the lag-1 model over the test samples, per symbol."""
    samples, model = _lag_one(spark, sf_dir)
    test = samples.filter("split = 'test'")
    return _rounded_metrics(fc.backtest(test, model, mod.ridge_score(1), ["symbol"], _FEW_PRED, by=["symbol"]))


_HEAVY = 25.0


@query(
    "ridge_choice_lag1",
    f"""WITH {_CELLS}, heavy AS (SELECT symbol, feature, n, ((sxx + {_HEAVY}) * sy - sx * sxy) / det AS a,
    ((n + {_HEAVY}) * sxy - sx * sy) / det AS b
    FROM (SELECT *, (n + {_HEAVY}) * (sxx + {_HEAVY}) - sx * sx AS det FROM sums)),
    losses AS (SELECT symbol, 'light' AS model, AVG((pred - actual) * (pred - actual)) AS l FROM ({_lag_steps('val')})
    GROUP BY symbol UNION ALL SELECT symbol, 'heavy', AVG((pred - actual) * (pred - actual))
    FROM ({_lag_steps('val', 'heavy')}) GROUP BY symbol),
    known AS (SELECT f.symbol, m.model, COALESCE(l, 0.0) AS l FROM (SELECT DISTINCT symbol FROM fit) f
    CROSS JOIN (VALUES ('light'), ('heavy')) m(model) LEFT JOIN losses ON losses.symbol = f.symbol AND losses.model = m.model)
    SELECT symbol, model, ROUND(l, 6) AS val_loss FROM known
    QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY l, model) = 1""",
)
def ridge_choice_lag1(spark, sf_dir):
    """The better of a light and a heavy penalty for each symbol, by validation loss."""
    samples = _splits(spark, sf_dir)
    candidates = mod.ridge_candidates({"light": _ALPHA, "heavy": _HEAVY}, ["symbol"], _FEW_SEQ, lags=1)
    best = mod.train_best(samples.filter("split = 'train'"), samples.filter("split = 'val'"), candidates, ["symbol"], _FEW_PRED)
    return best.select("symbol", "model", F.round("val_loss", 6).alias("val_loss"))


@query("ridge_training")
def ridge_training(spark, sf_dir):
    samples = _splits(spark, sf_dir)
    train, val = samples.filter("split = 'train'"), samples.filter("split = 'val'")
    candidates = mod.ridge_candidates({f"ridge_{a}": a for a in (0.01, 1.0)}, ["symbol"], _FEW_SEQ, lags=3)
    return mod.train_best(train, val, candidates, ["symbol"], _FEW_PRED)


@query("ridge_forecast")
def ridge_forecast(spark, sf_dir):
    """Train on the training split, forecast the next steps of every symbol, publish the table."""
    tickers = fr.tickers(spark, sf_dir, "user_id")
    placed = fc.placed_features(tickers)
    train = _splits(spark, sf_dir, placed=placed).filter("split = 'train'")
    model = mod.fit_ridge(train, ["symbol"], _FEW_SEQ, lags=3, alpha=0.01)
    forecast = fc.forecast_table(
        tickers, _FEW_SEQ, _FEW_PRED,
        lambda s: mod.predict_per_symbol(s, model, mod.ridge_score(3), ["symbol"], _FEW_PRED), placed=placed,
    )
    root = scratch_path(spark, "forecast")
    return spark.read.parquet(publish_forecast(forecast, root, points_path=f"{root}/points"))


_STEPS = [f"f{i}.a + f{i}.b * x{i}" for i in range(len(TICK))]
_FORECAST = [f"CASE WHEN h = 1 THEN {p} ELSE f{i}.a + f{i}.b * ({p}) END * ({c}_hi - {c}_lo) + {c}_lo"
             for i, (c, p) in enumerate(zip(TICK, _STEPS))]
_ENDS = ", ".join(
    f"CASE WHEN {c}_hi <> {c}_lo THEN CAST(CAST(({c} - {c}_lo) / CAST({c}_hi - {c}_lo AS DOUBLE) AS FLOAT) AS DOUBLE) "
    f"ELSE 0 END AS x{i}" for i, c in enumerate(TICK))


@query(
    "forecast_published_lag1",
    f"""WITH {_CELLS}, ends AS (SELECT *, {_ENDS} FROM (SELECT *, {_BOUNDS} FROM placed) WHERE position = series_length - 1
    AND series_length >= {_FEW_SEQ})
    SELECT ends.symbol, event_time + h * INTERVAL 1 SECOND AS event_time,
    {', '.join(f'ROUND({p}, 6) AS {c}' if c != 'trade_count' else f'CAST(TRUNC({p}) AS BIGINT) AS {c}' for c, p in zip(TICK, _FORECAST))},
    {_FEW_PRED} AS n_points FROM ends
    {' '.join(f'JOIN fit f{i} ON f{i}.symbol = ends.symbol AND f{i}.feature = {i}' for i in range(len(TICK)))},
    generate_series(1, {_FEW_PRED}) g(h)""",
)
def forecast_published_lag1(spark, sf_dir):
    """Train, forecast the next steps of every symbol, publish; the table and the number of points read back."""
    tickers = fr.tickers(spark, sf_dir, "user_id")
    _, model = _lag_one(spark, sf_dir)
    forecast = fc.forecast_table(
        tickers, _FEW_SEQ, _FEW_PRED,
        lambda s: mod.predict_per_symbol(s, model, mod.ridge_score(1), ["symbol"], _FEW_PRED),
    )
    root = scratch_path(spark, "forecast")
    stored = spark.read.parquet(publish_forecast(forecast, root, points_path=f"{root}/points"))
    points = spark.read.text(f"{root}/points").groupBy(F.regexp_extract("value", "symbol=([^ ,]+)", 1).alias("symbol")).agg(
        F.count(F.lit(1)).cast("int").alias("n_points"))
    return stored.join(points, "symbol", "left").select(
        "symbol", "event_time", *[F.round(c, 6).alias(c) if c != "trade_count" else F.col(c) for c in TICK], "n_points")


@query("ridge_backtest")
def ridge_backtest(spark, sf_dir):
    samples = _splits(spark, sf_dir)
    model = mod.fit_ridge(samples.filter("split = 'train'"), ["symbol"], _FEW_SEQ, lags=3, alpha=0.01)
    test = samples.filter("split = 'test'")
    return fc.backtest(test, model, mod.ridge_score(3), ["symbol"], _FEW_PRED, by=["symbol"])


_GRID_MARKS = list(cal.features_for_freq("d"))


@query(
    "daily_backtest",
    f"""WITH {fr.DAILY_SQL}, p AS (SELECT t.price AS actual, l.price AS pred FROM placed l JOIN placed t
    ON t.position > l.position AND t.position <= l.position + 24 WHERE l.position >= 47
    AND l.position <= l.series_length - 25) SELECT ROUND(AVG(ABS(pred - actual) / actual), 6) AS mape FROM p""",
)
def daily_backtest(spark, sf_dir):
    """Multivariate daily series, 48 steps in, 24 out, error of the target column."""
    columns = ["quantity", "discount", "tax", "price"]
    placed = pos.with_position(fr.daily_series(spark, sf_dir), ["series"], ["date"], length="series_length")
    marks = cal.time_features(F.col("date"), "d")
    samples = seqs.make_windows(
        placed.withColumns(marks), ["series"], columns, _GRID_MARKS, 48, 24, block=200
    )
    scored = fc.backtest_naive(samples, ["series"], 48, 24, feature=3)
    return scored.select(F.round("mape", 6).alias("mape"))


# --- regular multivariate series --------------------------------------------------------------

VECTOR = [*fr.FEATURES, "target"]
_V_SEQ, _V_LABEL, _V_PRED = 24, 12, 8


def _vector_windows(lane: str, lo: int, hi: int, columns: dict[str, str], extra: str = "") -> str:
    """Cells of one lane of every sample of every split of the vector series."""
    n_train, n_test = "CAST(FLOOR(n * 0.7::DOUBLE) AS BIGINT)", "CAST(FLOOR(n * 0.2::DOUBLE) AS BIGINT)"
    borders = {
        "train": ("0", n_train),
        "val": (f"{n_train} - {_V_SEQ}", f"n - {n_test}"),
        "test": (f"n - {n_test} - {_V_SEQ}", "n"),
    }
    splits = " UNION ALL ".join(
        f"SELECT *, '{name}' AS split, position - GREATEST({b}, 0) AS sp, ({e}) - GREATEST({b}, 0) AS sn "
        f"FROM z WHERE position >= {b} AND position < {e}"
        for name, (b, e) in borders.items()
    )
    stats = ", ".join(f"AVG({c}) AS {c}_mean, stddev_pop({c}) AS {c}_std" for c in VECTOR)
    scaled = ", ".join(f"({c} - {c}_mean) / {c}_std AS {c}_z" for c in VECTOR)
    values = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    return f"""WITH {fr.VECTOR_SQL}, st AS (SELECT {stats} FROM vec WHERE position < FLOOR(n * 0.7::DOUBLE)),
    z AS (SELECT vec.*, {scaled} FROM vec, st), sp AS ({splits})
    SELECT p.split, CAST(s.sp AS BIGINT) AS sample_id, '{lane}' AS lane,
    CAST(p.sp - s.sp - {lo} AS INTEGER) AS step, {values} FROM sp s JOIN sp p ON p.split = s.split
    AND p.sp >= s.sp + {lo} AND p.sp < s.sp + {hi} WHERE s.sp <= s.sn - {_V_SEQ + _V_PRED}"""


@query(
    "series_dataset_m",
    _vector_windows("y", _V_SEQ - _V_LABEL, _V_SEQ + _V_PRED, {c: _float(f"p.{c}_z") for c in VECTOR}),
)
def series_dataset_m(spark, sf_dir):
    samples = fc.series_dataset(
        fr.vector_series(spark, sf_dir).drop("series"), "date", "target", _V_SEQ, _V_LABEL, _V_PRED, mode="M"
    )
    return cells(samples, ["split", "sample_id"], "y", VECTOR)


@query(
    "series_dataset_s_inverse",
    _vector_windows(
        "y", _V_SEQ - _V_LABEL, _V_SEQ + _V_PRED,
        {"target": f"CASE WHEN p.sp - s.sp < {_V_SEQ} THEN {_float('p.target_z')} ELSE {_float('p.target')} END"},
    ),
)
def series_dataset_s_inverse(spark, sf_dir):
    samples = fc.series_dataset(
        fr.vector_series(spark, sf_dir).drop("series"), "date", "target", _V_SEQ, _V_LABEL, _V_PRED,
        mode="S", inverse=True,
    )
    return cells(samples, ["split", "sample_id"], "y", ["target"])


@query(
    "series_dataset_marks",
    _vector_windows(
        "y_mark", _V_SEQ - _V_LABEL, _V_SEQ + _V_PRED,
        {
            "month": "CAST(month(p.date) AS DOUBLE)", "day": "CAST(day(p.date) AS DOUBLE)",
            "weekday": "CAST(isodow(p.date) - 1 AS DOUBLE)", "hour": "CAST(hour(p.date) AS DOUBLE)",
        },
    ),
)
def series_dataset_marks(spark, sf_dir):
    samples = fc.series_dataset(
        fr.vector_series(spark, sf_dir).drop("series"), "date", "target", _V_SEQ, _V_LABEL, _V_PRED,
        mode="MS", columns=["f1", "f2"], integer_marks=True,
    )
    return cells(samples, ["split", "sample_id"], "y_mark", ["month", "day", "weekday", "hour"])


@query(
    "series_dataset_calendar",
    f"""WITH {fr.DAILY_SQL}, st AS (SELECT AVG(price) AS m, stddev_pop(price) AS sd FROM placed WHERE position < 360),
    z AS (SELECT position, (price - m) / sd AS price FROM placed, st),
    sp AS (SELECT 'train' AS split, position AS sp, 360 AS sn, price FROM z WHERE position < 360 UNION ALL
    SELECT 'val', position - 312, 168, price FROM z WHERE position >= 312 AND position < 480 UNION ALL
    SELECT 'test', position - 432, 168, price FROM z WHERE position >= 432 AND position < 600)
    SELECT p.split, s.sp AS sample_id, 'x' AS lane, CAST(p.sp - s.sp AS INTEGER) AS step, {_float('p.price')} AS price
    FROM sp s JOIN sp p ON p.split = s.split AND p.sp >= s.sp AND p.sp < s.sp + 48 WHERE s.sp <= s.sn - 72""",
)
def series_dataset_calendar(spark, sf_dir):
    """Daily series, 12/4/4 months of 30 days, 48 steps in, 24 out."""
    samples = fc.series_dataset(
        fr.daily_series(spark, sf_dir).drop("series"), "date", "price", 48, 24, 24, freq="d", rows_per_day=1
    )
    return cells(samples, ["split", "sample_id"], "x", ["price"])


_LAST_V = f"position >= n - {_V_SEQ}"


@query(
    "series_prediction",
    f"""WITH {fr.VECTOR_SQL}, st AS (SELECT AVG(target) AS m, stddev_pop(target) AS sd FROM vec)
    SELECT 'x' AS lane, CAST(position - n + {_V_SEQ} AS INTEGER) AS step, {_float('(target - m) / sd')} AS target
    FROM vec, st WHERE {_LAST_V} UNION ALL
    SELECT 'y', CAST(position - n + {_V_LABEL} AS INTEGER), {_float('target')} FROM vec
    WHERE position >= n - {_V_LABEL}""",
)
def series_prediction(spark, sf_dir):
    sample = fc.series_prediction(
        fr.vector_series(spark, sf_dir).drop("series"), "date", "target", _V_SEQ, _V_LABEL, _V_PRED,
        freq="h", inverse=True,
    )
    return cells(sample, [], "x", ["target"]).unionByName(cells(sample, [], "y", ["target"]))


@query(
    "series_prediction_marks",
    f"""WITH {fr.VECTOR_SQL}, f AS (SELECT date, position - n + {_V_LABEL} AS step FROM vec
    WHERE position >= n - {_V_LABEL} UNION ALL SELECT date + h * INTERVAL 15 MINUTE, {_V_LABEL} + h - 1
    FROM vec, generate_series(1, {_V_PRED}) g(h) WHERE position = n - 1) SELECT 'y_mark' AS lane,
    CAST(step AS INTEGER) AS step, ROUND(minute(date) / 59.0::DOUBLE - 0.5, 5) AS minute_of_hour,
    ROUND(hour(date) / 23.0::DOUBLE - 0.5, 5) AS hour_of_day FROM f""",
)
def series_prediction_marks(spark, sf_dir):
    sample = fc.series_prediction(
        fr.vector_series(spark, sf_dir).drop("series"), "date", "target", _V_SEQ, _V_LABEL, _V_PRED, mode="M"
    )
    return cells(sample, [], "y_mark", ["minute_of_hour", "hour_of_day"])
