"""Long time-series points and their wide form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import encoding
from tidemark.schemas import StreamSpec, stream_spec


def to_points(
    df: DataFrame, measurement: str, fields: Sequence[str], time: str, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per (measurement, symbol, field, value, time); absent fields give no point."""
    wide = df.select(
        "symbol", F.col(time).alias("time"), *keep, *[F.col(f).cast("double").alias(f) for f in fields]
    )
    long = wide.unpivot(["symbol", "time", *keep], list(fields), "field", "value")
    return long.filter(F.col("value").isNotNull()).select(
        F.lit(measurement).alias("measurement"), "symbol", "field", "value", "time", *keep
    )


def select_fields(points: DataFrame, measurement: str, fields: Sequence[str]) -> DataFrame:
    """Keep one measurement and any of the named fields."""
    return points.filter((F.col("measurement") == measurement) & F.col("field").isin(list(fields)))


def pivot_fields(points: DataFrame, fields: Sequence[str], keys=("symbol", "time")) -> DataFrame:
    """One row per key with a column per named field.

    Conditional aggregates over a known field list: one hash aggregate, no pass to find values.
    """
    return points.groupBy(*keys).agg(
        *[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    )


def upsert_points(
    points: DataFrame,
    order: str,
    keys: Sequence[str] = ("measurement", "symbol", "field", "time"),
    value: str = "value",
) -> DataFrame:
    """Last write wins among points of equal series and time; ``order`` ranks the writes."""
    return points.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def to_line_protocol(
    df: DataFrame, stream: str | StreamSpec, measurement: str | None = None, time: str | None = None
) -> DataFrame:
    """One ``line`` per row for the point store; rows without any field are left out."""
    spec = stream_spec(stream)
    fields = [(name, df.schema[name].dataType) for name in spec.point_fields]
    if not fields:
        return df.sparkSession.createDataFrame([], "line string")
    line = encoding.line_protocol(
        measurement or spec.name, F.col("symbol"), fields, F.col(time or spec.time_column)
    )
    usable = df.filter(F.col("symbol").isNotNull() & encoding.has_fields(fields))
    return usable.select(line.alias("line"))
