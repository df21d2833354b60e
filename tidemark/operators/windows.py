"""Tumbling-window aggregates."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from math import isqrt
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.selection import epoch_micros, time_range

RANGE = 10_000  # windows of a key that one row of the spine stands for, at least

# Microseconds per interval unit.
INTERVAL_MICROS = {
    "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000,
    "day": 86_400_000_000, "week": 604_800_000_000,
}


def interval_micros(every: str) -> int:
    """Length of an interval such as ``5 seconds``."""
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", every)
    if not match or match.group(2) not in INTERVAL_MICROS:
        raise ValueError(f"cannot read the interval {every!r}")
    return int(match.group(1)) * INTERVAL_MICROS[match.group(2)]


def aggregate_window(
    df: DataFrame,
    time: str,
    every: str,
    by: Sequence[str],
    aggs: Mapping[str, Column],
    start: datetime | str | None = None,
    stop: datetime | str | None = None,
    fill_empty: bool = False,
) -> DataFrame:
    """Aggregates per epoch-aligned window and key: by..., window_start, window_end, aggs...

    Works on streams (add a watermark first) unless ``fill_empty`` asks for a row per empty
    window, which needs a bounded [start, stop) and a batch frame.
    """
    if start is not None and stop is not None:
        df = time_range(df, time, start, stop)
    grouped = (
        df.groupBy(*by, F.window(time, every).alias("_window"))
        .agg(*[column.alias(name) for name, column in aggs.items()])
        .select(
            *by,
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            *aggs,
        )
    )
    if not fill_empty:
        return grouped
    if start is None or stop is None:
        raise ValueError("fill_empty needs start and stop")
    return fill_empty_windows(grouped, every, by, list(aggs), start, stop)


def fill_empty_windows(
    grouped: DataFrame, every: str, by: Sequence[str], values: Sequence[str], start, stop
) -> DataFrame:
    """All windows of [start, stop) of each key, with NULL values where ``grouped`` has none.

    The spine is made of ranges of at least ``RANGE`` windows per key, which are dealt out before they are
    written out as windows, so a key with very many windows fills many tasks. The range has no limit.
    """
    step = interval_micros(every)
    first, last = epoch_micros(start) // step, (epoch_micros(stop) - 1) // step
    if last < first:
        return grouped.filter(F.lit(False))
    slot = F.floor(F.unix_micros(F.col("window_start").cast("timestamp")) / F.lit(step)).cast("long")
    # as many ranges as windows in one, once that is more than RANGE: neither list gets long
    size = max(RANGE, isqrt(last - first) + 1)
    names = {k: f"_key_{k}" for k in by}
    ranges = grouped.select(*[F.col(k).alias(n) for k, n in names.items()]).distinct().select(
        *names.values(), F.explode(F.sequence(F.lit(first // size), F.lit(last // size)).cast("array<bigint>")).alias("_range"))
    spread = int(grouped.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    low = F.greatest(F.col("_range") * size, F.lit(first))
    high = F.least(F.col("_range") * size + (size - 1), F.lit(last))
    spine = ranges.repartition(spread, *names.values(), "_range").select(
        *names.values(), F.explode(F.sequence(low.cast("long"), high.cast("long"))).alias("_slot"))
    rows = grouped.select(*by, slot.alias("_index"), *values)
    same = reduce(and_, [F.col(n).eqNullSafe(F.col(k)) for k, n in names.items()], F.col("_slot") == F.col("_index"))
    return spine.join(rows, same, "left").select(
        *[F.col(n).alias(k) for k, n in names.items()],
        F.timestamp_micros(F.col("_slot") * step).alias("window_start"),
        F.timestamp_micros((F.col("_slot") + 1) * step).alias("window_end"),
        *values,
    )
