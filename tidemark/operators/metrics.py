"""Forecast accuracy over rows of (pred, true)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.joins import lookup_join


def _columns(pred: str, true: str) -> tuple[Column, Column]:
    return F.col(pred), F.col(true)


def metric_columns(pred: str = "pred", true: str = "true") -> dict[str, Column]:
    """Aggregates for mae, mse, rmse, mape and mspe; rows with true = 0 have no percentage."""
    p, t = _columns(pred, true)
    ratio = F.try_divide(p - t, t)
    mse = F.avg((p - t) * (p - t))
    return {
        "mae": F.avg(F.abs(p - t)),
        "mse": mse,
        "rmse": F.sqrt(mse),
        "mape": F.avg(F.abs(ratio)),
        "mspe": F.avg(ratio * ratio),
    }


def forecast_metrics(
    df: DataFrame, by: Sequence[str] = (), pred: str = "pred", true: str = "true"
) -> DataFrame:
    """All five errors in one pass, overall or per group."""
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in metric_columns(pred, true).items()])


def metric_rse(
    df: DataFrame, by: Sequence[str] = (), pred: str = "pred", true: str = "true"
) -> DataFrame:
    """Root relative squared error. Count times variance is the squared deviation from the mean,
    so one pass is enough."""
    p, t = _columns(pred, true)
    residual = F.sqrt(F.sum((t - p) * (t - p)))
    spread = F.sqrt(F.var_pop(t) * F.count(t))
    return df.groupBy(*by).agg(F.try_divide(residual, spread).alias("rse"))


def metric_corr(
    df: DataFrame, column: Sequence[str], by: Sequence[str] = (), pred: str = "pred", true: str = "true"
) -> DataFrame:
    """Sum of the products of deviations over the root of the sum of their squares, per column,
    averaged over columns. This is not Pearson's coefficient; ``pearson`` is that (runs jobs)."""
    p, t = _columns(pred, true)
    identity = [*by, *column]
    means = df.groupBy(*identity).agg(F.avg(p).alias("_mp"), F.avg(t).alias("_mt"))
    product = (t - F.col("_mt")) * (p - F.col("_mp"))
    per_column = lookup_join(df, means, identity).groupBy(*identity).agg(
        F.try_divide(F.sum(product), F.sqrt(F.sum(product * product))).alias("corr")
    )
    return per_column.groupBy(*by).agg(F.avg("corr").alias("corr"))


def pearson(
    df: DataFrame, by: Sequence[str] = (), pred: str = "pred", true: str = "true"
) -> DataFrame:
    return df.groupBy(*by).agg(F.corr(pred, true).alias("pearson"))


def window_errors(
    forecasts: DataFrame, keys: Sequence[str], feature: int | None = None,
    horizon: str = "horizon", target: str = "y",
) -> DataFrame:
    """Rows of (keys, sample_id, step, feature, pred, true) from forecast and target arrays."""
    steps = forecasts.select(
        *keys, "sample_id", F.posexplode(F.arrays_zip(F.col(horizon).alias("p"), F.col(target).alias("t")))
        .alias("step", "_pair"),
    )
    if feature is not None:
        return steps.select(
            *keys, "sample_id", "step", F.lit(feature).alias("feature"),
            F.col("_pair.p")[feature].cast("double").alias("pred"),
            F.col("_pair.t")[feature].cast("double").alias("true"),
        )
    cells = steps.select(
        *keys, "sample_id", "step",
        F.posexplode(F.arrays_zip(F.col("_pair.p").alias("p"), F.col("_pair.t").alias("t")))
        .alias("feature", "_cell"),
    )
    return cells.select(
        *keys, "sample_id", "step", "feature",
        F.col("_cell.p").cast("double").alias("pred"), F.col("_cell.t").cast("double").alias("true"),
    )
