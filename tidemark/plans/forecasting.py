"""Forecast jobs: features, samples, forecasts, publishing and back-tests."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.calendar import cyclic_time, time_features, time_marks
from tidemark.operators.joins import measured_keys
from tidemark.operators.metrics import forecast_metrics, window_errors
from tidemark.operators.models import ScoreFn, predict_naive, predict_per_symbol
from tidemark.operators.positions import split_calendar, split_custom, split_ratio, with_position
from tidemark.operators.scaling import (
    fit_minmax, fit_standard, minmax_transform, scale_attached, standard_transform,
)
from tidemark.operators.selection import dedup
from tidemark.operators.sequences import (
    decode_forecast, decoder_padding, feature_mode, float_array, make_windows, prediction_frame,
    windows_overlap,
)
from tidemark.schemas import TICKER_FEATURES, FeatureSpec


HOT_COPIES = 100_000  # rows of one key and time, beyond a thousandth of all, that are combined before a shuffle


def select_features(df: DataFrame, spec: FeatureSpec = TICKER_FEATURES) -> DataFrame:
    return df.select(spec.time_column, *spec.keys, *spec.features)


def encode_time(df: DataFrame, spec: FeatureSpec = TICKER_FEATURES) -> DataFrame:
    encoded = cyclic_time(F.col(spec.time_column))
    return df.withColumns({name: encoded[name] for name in spec.time_features})


def placed_features(
    df: DataFrame, spec: FeatureSpec = TICKER_FEATURES, with_stats: bool = True
) -> DataFrame:
    """One row per key and time with its position, the series length and, unless switched off,
    each feature's minimum and maximum over the series (runs jobs).

    Repeated rows fall out while the rows are numbered, in the same shuffle. Only if some key and time is
    found to hold a great share of all rows are the copies combined before it.
    """
    rows, by = select_features(df, spec), [*spec.keys, spec.time_column]
    hot = not measured_keys(rows, by, least=HOT_COPIES).isEmpty()
    unique = dedup(rows, by) if hot else rows
    sides = ("min", "max") if with_stats else ()
    totals = {f"{f}_{side}": (f, side) for f in spec.features for side in sides}
    return with_position(unique, spec.keys, [spec.time_column], length="series_length", totals=totals, unique=not hot)


def feature_frame(
    df: DataFrame, spec: FeatureSpec = TICKER_FEATURES, fit_on: str = "all", train: float = 0.7,
    placed: DataFrame | None = None,
) -> DataFrame:
    """Deduplicated, positioned, min-max scaled features with cyclic time columns (runs jobs).

    ``fit_on="all"`` scales by the whole series; its minima and maxima come from the summary that
    numbers the rows, so no further pass is needed. ``"train"`` uses the training rows only. ``placed`` is the
    ``placed_features`` of ``df``, for callers that have it already.
    """
    features = list(spec.features)
    if fit_on == "all":
        scaled = scale_attached(placed or placed_features(df, spec), features)
    elif fit_on == "train":
        placed = placed or placed_features(df, spec, with_stats=False)
        head = placed.filter(F.col("position") < F.floor(F.col("series_length") * F.lit(train)))
        stats = fit_minmax(head, spec.keys, features)
        scaled = minmax_transform(placed, stats, spec.keys, features)
    else:
        raise ValueError("fit_on must be 'all' or 'train'")
    return encode_time(scaled, spec)


def prepare_training(
    df: DataFrame, seq: int, pred: int, spec: FeatureSpec = TICKER_FEATURES, fit_on: str = "all",
    train: float = 0.7, val: float = 0.2, label: int | None = None, stride: int = 1,
    partitions: int | None = None, placed: DataFrame | None = None,
) -> DataFrame:
    """Samples per key and split (train, val, test). A split shorter than seq + pred has none."""
    frame = split_ratio(feature_frame(df, spec, fit_on, train, placed), train, val)
    return make_windows(
        frame, [*spec.keys, "split"], spec.features, spec.time_features, seq, pred, label, stride,
        position="split_position", partitions=partitions,
    )


def prepare_prediction(
    df: DataFrame, seq: int, pred: int, spec: FeatureSpec = TICKER_FEATURES,
    label: int | None = None, stride: int = 1, partitions: int | None = None,
) -> DataFrame:
    """Samples per key over the whole series, for scoring."""
    frame = feature_frame(df, spec)
    return make_windows(
        frame, spec.keys, spec.features, spec.time_features, seq, pred, label, stride,
        partitions=partitions,
    )


def forecast_input(
    frame: DataFrame, seq: int, pred: int, spec: FeatureSpec = TICKER_FEATURES, freq: str = "s",
    label: int | None = None,
) -> DataFrame:
    """One sample per key: the last ``seq`` rows of a feature frame and the marks of the next
    ``pred`` steps. At most seq + pred rows per key come together. Shorter series have none."""
    label = seq - pred if label is None else label
    bare = frame.drop(*spec.time_features)
    rows = encode_time(
        prediction_frame(bare, spec.keys, spec.time_column, seq, pred, freq), spec
    )
    grouped = rows.groupBy(*spec.keys).agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "step",
                    float_array(spec.features).alias("f"),
                    float_array(spec.time_features).alias("m"),
                )
            )
        ).alias("_rows")
    )
    whole = grouped.filter(F.size("_rows") == seq + pred).select(
        *spec.keys, F.col("_rows.f").alias("_f"), F.col("_rows.m").alias("_m")
    )
    known = F.slice("_f", seq - label + 1, label)
    return whole.select(
        *spec.keys,
        F.slice("_f", 1, seq).alias("x"),
        F.slice("_m", 1, seq).alias("x_mark"),
        F.concat(known, decoder_padding(len(spec.features), pred)).alias("x_dec"),
        F.slice("_m", seq - label + 1, label + pred).alias("x_mark_dec"),
    )


def forecast_table(
    df: DataFrame, seq: int, pred: int, predict: Callable[[DataFrame], DataFrame],
    spec: FeatureSpec = TICKER_FEATURES, step: str = "1 second", placed: DataFrame | None = None,
) -> DataFrame:
    """Forecast the next ``pred`` steps of every key, in original units (runs jobs).

    ``predict`` adds a ``horizon`` column to the samples of ``forecast_input``.
    """
    placed = placed or placed_features(df, spec)
    frame = encode_time(scale_attached(placed, spec.features), spec)
    horizons = predict(forecast_input(frame, seq, pred, spec)).select(*spec.keys, "horizon")
    ends = placed.filter(F.col("position") == F.col("series_length") - 1)
    stats = ends.select(*spec.keys, *[f"{f}_{side}" for f in spec.features for side in ("min", "max")])
    last = ends.select(*spec.keys, spec.time_column)
    return decode_forecast(
        horizons, stats, last, spec.keys, spec.features, time=spec.time_column, step=step
    )


def backtest_naive(
    samples: DataFrame, keys: Sequence[str], seq: int, pred: int, by: Sequence[str] = (),
    period: int = 1, feature: int | None = None,
) -> DataFrame:
    """Errors of the seasonal-naive model over every sample."""
    scored = predict_naive(samples, seq, pred, period)
    return forecast_metrics(window_errors(scored, keys, feature), by)


def backtest(
    samples: DataFrame, models: DataFrame, score_fn: ScoreFn, keys: Sequence[str], pred: int,
    by: Sequence[str] = (), feature: int | None = None,
) -> DataFrame:
    """Errors of a trained model over every sample (runs jobs to size the model lookup)."""
    scored = predict_per_symbol(samples, models, score_fn, keys, pred)
    return forecast_metrics(window_errors(scored, keys, feature), by)


# --- regular multivariate series --------------------------------------------------------------


def _marks(time: str, freq: str, integer_marks: bool) -> dict:
    return (time_marks if integer_marks else time_features)(F.col(time), freq)


def _scaled_series(df, keys, time, columns, train_rows, scale) -> DataFrame:
    """Columns scaled by the statistics of ``train_rows``, with the originals as ``{column}_raw``."""
    raw = df.withColumns({f"{c}_raw": F.col(c) for c in columns})
    if not scale:
        return raw
    return standard_transform(raw, fit_standard(train_rows, columns, keys), columns, keys)


def series_dataset(
    df: DataFrame, time: str, target: str, seq: int, label: int, pred: int, mode: str = "S",
    columns: Sequence[str] | None = None, keys: Sequence[str] = (), freq: str = "h",
    rows_per_day: int | None = None, months: tuple[int, int, int] = (12, 4, 4), scale: bool = True,
    inverse: bool = False, integer_marks: bool = False, partitions: int | None = None,
) -> DataFrame:
    """Samples with overlapping targets per split of a regular series (runs jobs).

    ``mode`` picks the features (see ``feature_mode``); the target is the last one. The scaler is
    fitted on the training rows. Splits are 70/10/20 percent, or fixed calendar months when
    ``rows_per_day`` is given; validation and test start ``seq`` rows early.
    """
    keys = list(keys)
    features = feature_mode(df.drop(*keys), mode, target, columns, time).columns[1:]
    rows = df.select(*keys, time, *features)
    placed = with_position(rows, keys, [time], length="series_length")
    if rows_per_day is None:
        n_train = F.floor(F.col("series_length") * F.lit(0.7))
    else:
        n_train = F.lit(30 * rows_per_day * months[0])
    scaled = _scaled_series(placed, keys, time, features, placed.filter(F.col("position") < n_train), scale)
    if rows_per_day is None:
        split = split_custom(scaled, lookback=seq)
    else:
        split = split_calendar(scaled, rows_per_day, months, lookback=seq)
    marks = _marks(time, freq, integer_marks)
    return windows_overlap(
        split.withColumns(marks), [*keys, "split"], features, [f"{f}_raw" for f in features],
        list(marks), seq, label, pred, inverse, position="split_position", partitions=partitions,
    )


def series_prediction(
    df: DataFrame, time: str, target: str, seq: int, label: int, pred: int, mode: str = "S",
    columns: Sequence[str] | None = None, keys: Sequence[str] = (), freq: str = "15min",
    scale: bool = True, inverse: bool = False, integer_marks: bool = False,
) -> DataFrame:
    """The one sample per key to forecast from: its last ``seq`` rows, the last ``label`` of them
    as decoder context, and marks up to ``pred`` steps ahead (runs jobs). The scaler is fitted on
    all rows."""
    keys = list(keys)
    features = feature_mode(df.drop(*keys), mode, target, columns, time).columns[1:]
    placed = with_position(df.select(*keys, time, *features), keys, [time], length="series_length")
    scaled = _scaled_series(placed, keys, time, features, placed, scale)
    marks = _marks(time, freq, integer_marks)
    rows = prediction_frame(scaled, keys, time, seq, pred, freq).withColumns(marks)
    context = [f"{f}_raw" for f in features] if inverse else features
    lanes = F.struct(
        "step", float_array(features).alias("f"), float_array(context).alias("c"),
        float_array(list(marks)).alias("m"),
    )
    grouped = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(lanes)).alias("_rows"))
    whole = grouped.filter(F.size("_rows") == seq + pred).select(
        *keys, F.col("_rows.f").alias("_f"), F.col("_rows.c").alias("_c"), F.col("_rows.m").alias("_m")
    )
    return whole.select(
        *keys,
        F.slice("_f", 1, seq).alias("x"),
        F.slice("_c", seq - label + 1, label).alias("y"),
        F.slice("_m", 1, seq).alias("x_mark"),
        F.slice("_m", seq - label + 1, label + pred).alias("y_mark"),
    )
