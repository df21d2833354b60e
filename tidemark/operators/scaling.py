"""Fitting scalers and applying them to frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import scaling
from tidemark.operators.joins import lookup_join


def fit_minmax(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Min and max of every column per key in one aggregate: ``{column}_min``, ``{column}_max``."""
    return df.groupBy(*keys).agg(
        *[F.min(c).alias(f"{c}_min") for c in columns], *[F.max(c).alias(f"{c}_max") for c in columns]
    )


def minmax_table(stats: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The scaler state in long form: keys, feature, min, max."""
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"{c}_min").cast("double").alias("min"),
                F.col(f"{c}_max").cast("double").alias("max"),
            )
            for c in columns
        ]
    )
    return stats.select(*keys, F.inline(entries))


def attach_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row with its key's statistics (runs jobs to size the lookup)."""
    return lookup_join(df, stats, keys)


def minmax_over(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each row with the minimum and maximum of its key.

    Same result as min/max over an unordered partition, without moving a whole key to one task.
    """
    return attach_stats(df, fit_minmax(df, keys, columns), keys)


def _replace(df: DataFrame, columns: Sequence[str], expression, drop: Sequence[str]) -> DataFrame:
    wanted = set(columns)
    return df.select(
        *[expression(c).alias(c) if c in wanted else F.col(c) for c in df.columns if c not in drop]
    )


def _minmax_names(columns: Sequence[str]) -> list[str]:
    return [f"{c}_{side}" for c in columns for side in ("min", "max")]


def scale_attached(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min-max scale columns whose statistics are already on the row."""
    return _replace(
        df, columns,
        lambda c: scaling.minmax_scale(F.col(c), F.col(f"{c}_min"), F.col(f"{c}_max")),
        _minmax_names(columns),
    )


def minmax_transform(
    df: DataFrame, stats: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    needed = stats.select(*keys, *_minmax_names(columns))
    return scale_attached(attach_stats(df, needed, keys), columns)


def minmax_inverse(
    df: DataFrame, stats: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    needed = stats.select(*keys, *_minmax_names(columns))
    return _replace(
        attach_stats(df, needed, keys), columns,
        lambda c: scaling.minmax_restore(F.col(c), F.col(f"{c}_min"), F.col(f"{c}_max")),
        _minmax_names(columns),
    )


def fit_standard(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation per column: ``{column}_mean``, ``{column}_std``."""
    return df.groupBy(*keys).agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
    )


def _standard(df, stats, columns, keys, expression) -> DataFrame:
    """``stats`` columns that a frame lacks fall back to the last statistic (target only)."""
    fitted = [c[: -len("_mean")] for c in stats.columns if c.endswith("_mean")]
    source = {c: c if c in fitted else fitted[-1] for c in columns}
    if keys:
        joined = attach_stats(df, stats, keys)
    else:
        one = F.lit(1).alias("_all")
        joined = lookup_join(df.select("*", one), stats.select("*", one), ["_all"]).drop("_all")
    drop = [f"{c}_{s}" for c in fitted for s in ("mean", "std")]
    return _replace(
        joined, columns,
        lambda c: expression(F.col(c), F.col(f"{source[c]}_mean"), F.col(f"{source[c]}_std")), drop,
    )


def standard_transform(
    df: DataFrame, stats: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    return _standard(df, stats, columns, keys, scaling.standard_scale)


def standard_inverse(
    df: DataFrame, stats: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    return _standard(df, stats, columns, keys, scaling.standard_restore)
