"""Filters, latest rows, limits, pages and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.quotes import recency

FIXED_WIDTH = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType,
)


WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def epoch_micros(value: datetime | str) -> int:
    """Microseconds since 1970; a time without zone is UTC, whatever the session's zone."""
    stamp = datetime.fromisoformat(value) if isinstance(value, str) else value
    stamp = stamp if stamp.tzinfo else stamp.replace(tzinfo=timezone.utc)
    delta = stamp - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def moment(value: datetime | str | Column) -> Column:
    """A UTC timestamp literal; constants fold, so filters on it reach the file scan."""
    if isinstance(value, Column):
        return value
    return F.timestamp_micros(F.lit(epoch_micros(value)))


def time_range(df: DataFrame, time: str, start, stop) -> DataFrame:
    """start <= time < stop."""
    return df.filter((F.col(time) >= moment(start)) & (F.col(time) < moment(stop)))


def temporal_range(df: DataFrame, time: str, lo=None, hi=None) -> DataFrame:
    """Chart time filter: each bound is optional, none means "No filter"."""
    if lo is not None:
        df = df.filter(F.col(time) >= moment(lo))
    if hi is not None:
        df = df.filter(F.col(time) < moment(hi))
    return df


def last_interval(df: DataFrame, time: str, now, interval: str) -> DataFrame:
    """Rows of the trailing ``interval`` ("1 minute", "7 days") before ``now``, inclusive."""
    end = moment(now)
    return df.filter((F.col(time) >= end - F.expr(f"INTERVAL {interval}")) & (F.col(time) <= end))


def symbols_quoted_in(df: DataFrame, quote: str) -> DataFrame:
    return df.filter(F.col("symbol").endswith(quote))


def for_symbol(df: DataFrame, symbol: str) -> DataFrame:
    return df.filter(F.col("symbol") == symbol)


def distinct_symbols(df: DataFrame) -> DataFrame:
    return df.select("symbol").distinct()


def latest(
    df: DataFrame, keys: Sequence[str], time: str, tie: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row per key, batch or streaming; NULL is older than any time and before any tie.

    An aggregate instead of a ranking window: rows combine before the shuffle, so a hot key
    costs one row per input partition. Fixed-width columns keep it a hash aggregate.
    """
    wanted = [c for c in (columns or df.columns) if c not in keys]
    narrow = all(isinstance(df.schema[c].dataType, FIXED_WIDTH) for c in wanted) and (
        tie is None or isinstance(df.schema[tie].dataType, WHOLE))
    if narrow and not df.isStreaming:
        order = recency(time, tie)
        picked = df.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in wanted])
    else:
        order = F.struct(time, tie) if tie else F.col(time)
        row = F.max_by(F.struct(*wanted), order).alias("_row")
        picked = df.groupBy(*keys).agg(row).select(*keys, "_row.*")
    return picked.select(*[c for c in (columns or df.columns)])


def limit_series(
    df: DataFrame,
    series: str,
    metric: Column,
    n: int | None = None,
    row_limit: int | None = None,
    order: Sequence[Column] = (),
) -> DataFrame:
    """Keep the ``n`` series with the largest metric, then the first ``row_limit`` rows.

    At most ``n`` keys are broadcast into a semi-join.
    """
    if n is not None:
        keys = (
            df.groupBy(series).agg(metric.alias("_metric"))
            .orderBy(F.desc_nulls_last("_metric"), F.col(series)).limit(n).select(series)
        )
        df = df.join(F.broadcast(keys), series, "left_semi")
    if row_limit is not None:
        df = df.orderBy(*order).limit(row_limit) if order else df.limit(row_limit)
    return df


def page(df: DataFrame, order: Sequence[str | Column], size: int = 10, offset: int = 0) -> DataFrame:
    """One page of a totally ordered table."""
    return df.orderBy(*order).offset(offset).limit(size)


def page_after(
    df: DataFrame, order: Sequence[str], size: int = 10, after: Sequence | None = None
) -> DataFrame:
    """The page behind the row whose ``order`` values are ``after`` (None: the first page).

    Any page costs the same top-n, however deep it lies. NULL sorts first.
    """
    if after is not None:
        behind = F.lit(False)
        for column, value in reversed(list(zip(order, after))):
            c = F.col(column)
            larger = c.isNotNull() if value is None else c > F.lit(value)
            behind = larger | (c.eqNullSafe(F.lit(value)) & behind)
        df = df.filter(F.coalesce(behind, F.lit(False)))
    return df.orderBy(*order).limit(size)


def top_symbols(snapshot: DataFrame, quote: str = "USDT", limit: int = 10) -> DataFrame:
    """The ``limit`` symbols with the largest quote volume, in lower case with their rank value."""
    volume = F.coalesce(F.col("quoteVolume").try_cast("double"), F.lit(0.0))
    return (
        symbols_quoted_in(snapshot, quote)
        .select("symbol", volume.alias("quote_volume"))
        .orderBy(F.desc("quote_volume"), "symbol")
        .limit(limit)
        .select(F.lower("symbol").alias("symbol"), "quote_volume")
    )


def dedup(df: DataFrame, keys: Sequence[str] = ("symbol", "event_time")) -> DataFrame:
    """One row per key: the smallest of the remaining columns, compared in column order.

    Copies combine before the shuffle, so a key with any number of copies stays cheap.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = F.min(F.struct(*rest)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing from one frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def subtract_rows(a: DataFrame, b: DataFrame, keep_copies: bool = False) -> DataFrame:
    """Rows of ``a`` that are not in ``b``; distinct unless ``keep_copies``."""
    return a.exceptAll(b) if keep_copies else a.subtract(b)


def chronological(df: DataFrame, time: str = "event_time", tie: Sequence[str] = ()) -> DataFrame:
    """Rows sorted by (symbol, time) over range partitions; a long series spans several."""
    order = ["symbol", time, *tie]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)
