"""Row positions inside ordered series, and the splits built on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.joins import BROADCAST_BYTES, null_safe_join
from tidemark.session import settle, settle_sized


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    position: str = "position",
    length: str | None = None,
    totals: Mapping[str, tuple[str, str]] | None = None,
    partitions: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """0-based position of each row within its key's order (runs jobs).

    The rows are range-partitioned and sorted by (keys, order), numbered, and settled in the
    shared folder, so the layout cannot change on a retry. Each partition then needs one offset
    per key it holds. A series that fills many partitions is therefore numbered by many tasks; no
    task sees a whole key.

    ``length`` adds the series length. ``totals`` adds per-key aggregates ``name -> (column,
    "min" | "max" | "sum")`` from the same per-partition summary.

    ``unique`` keeps one row per (keys, order), the smallest of the remaining columns in column order. Such rows stand next to
    each other in one range, so nothing is shuffled or sorted for it; rows that share one (keys, order) by
    the million should be deduplicated before, as ``dedup`` does.
    """
    totals = dict(totals or {})
    by = [*keys, *order]
    ranged = (
        df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    )
    if unique:
        rest = [c for c in df.columns if c not in by]
        copies = Window.partitionBy(*by).orderBy(*(rest or by))
        ranged = ranged.sortWithinPartitions(*by, *rest).withColumn("_copy", F.row_number().over(copies))
        ranged = ranged.filter("_copy = 1").drop("_copy")
    else:
        ranged = ranged.sortWithinPartitions(*by)
    ranged = ranged.withColumn("_row", F.monotonically_increasing_id())
    ranged = settle(ranged).withColumn("_part", F.shiftright("_row", 33))

    combine = {"min": F.min, "max": F.max, "sum": F.sum}
    local = ranged.groupBy(*keys, "_part").agg(
        F.min("_row").alias("_first"),
        F.count(F.lit(1)).alias("_rows"),
        *[combine[how](column).alias(name) for name, (column, how) in totals.items()],
    )
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = local.select(
        *keys,
        "_part",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        *([F.sum("_rows").over(whole).alias(length)] if length else []),
        *[combine[how](name).over(whole).alias(name) for name, (_, how) in totals.items()],
    )
    offsets, size = settle_sized(offsets)
    if size <= BROADCAST_BYTES:
        offsets = F.broadcast(offsets)
    joined = null_safe_join(ranged, offsets, [*keys, "_part"], "inner")
    extra = [*([length] if length else []), *totals]
    return joined.select(
        *df.columns, (F.col("_row") + F.col("_shift")).cast("long").alias(position), *extra
    )


def shifted(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], steps: int = 1,
    position: str = "position", suffix: str = "_before",
) -> DataFrame:
    """Add the values ``steps`` positions earlier; rows without such a predecessor are dropped.

    An equi-join on (keys, position) spreads a long series over all tasks, unlike a lag window.
    """
    before = df.select(
        *keys,
        (F.col(position) + steps).alias(position),
        *[F.col(c).alias(f"{c}{suffix}") for c in columns],
    )
    return df.join(before, [*keys, position])


def split_ratio(
    df: DataFrame, train: float = 0.7, val: float = 0.2,
    position: str = "position", length: str = "series_length",
) -> DataFrame:
    """Chronological split per series: the first int(n*train) rows, int(n*val) rows, the rest.

    Adds ``split``, ``split_position`` and ``split_length``.
    """
    n = F.col(length)
    n_train = F.floor(n * F.lit(train)).cast("long")
    n_val = F.floor(n * F.lit(val)).cast("long")
    p = F.col(position)
    in_train, in_val = p < n_train, p < n_train + n_val
    return df.select(
        "*",
        F.when(in_train, "train").when(in_val, "val").otherwise("test").alias("split"),
        F.when(in_train, p).when(in_val, p - n_train).otherwise(p - n_train - n_val)
        .alias("split_position"),
        F.when(in_train, n_train).when(in_val, n_val).otherwise(n - n_train - n_val)
        .alias("split_length"),
    )


def _borders(df: DataFrame, borders: Mapping[str, tuple[Column, Column]], position: str) -> DataFrame:
    p = F.col(position)
    pieces = [
        F.when(
            (p >= begin) & (p < end),
            F.struct(F.lit(name).alias("split"), (p - F.greatest(begin, F.lit(0))).alias("split_position")),
        )
        for name, (begin, end) in borders.items()
    ]
    hit = F.explode(F.array_compact(F.array(*pieces))).alias("_hit")
    return df.select("*", hit).select(*df.columns, "_hit.split", "_hit.split_position")


def split_calendar(
    df: DataFrame, rows_per_day: int, months: tuple[int, int, int] = (12, 4, 4),
    lookback: int = 0, position: str = "position",
) -> DataFrame:
    """Fixed split in 30-day months; val and test start ``lookback`` rows early for context.

    A row in the overlap appears once per split.
    """
    ends = [30 * rows_per_day * sum(months[: i + 1]) for i in range(3)]
    borders = {
        "train": (F.lit(0), F.lit(ends[0])),
        "val": (F.lit(ends[0] - lookback), F.lit(ends[1])),
        "test": (F.lit(ends[1] - lookback), F.lit(ends[2])),
    }
    return _borders(df, borders, position)


def split_custom(
    df: DataFrame, lookback: int = 0, train: float = 0.7, test: float = 0.2,
    position: str = "position", length: str = "series_length",
) -> DataFrame:
    """First int(.7n) rows train, last int(.2n) test, the rest validation, with look-back."""
    n = F.col(length)
    n_train = F.floor(n * F.lit(train)).cast("long")
    n_test = F.floor(n * F.lit(test)).cast("long")
    borders = {
        "train": (F.lit(0), n_train),
        "val": (n_train - lookback, n - n_test),
        "test": (n - n_test - lookback, n),
    }
    return _borders(df, borders, position)


def series_profile(
    df: DataFrame, keys: Sequence[str], seq: int, pred: int, train: float = 0.7, val: float = 0.2
) -> DataFrame:
    """Rows, split sizes, available samples and an enough-data flag per series."""
    n = F.col("n")
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    n_train = F.floor(n * F.lit(train)).cast("long")
    n_val = F.floor(n * F.lit(val)).cast("long")
    return counted.select(
        *keys,
        "n",
        n_train.alias("n_train"),
        n_val.alias("n_val"),
        (n - n_train - n_val).alias("n_test"),
        F.greatest(n - (seq + pred - 1), F.lit(0)).alias("samples"),
        (n >= seq + pred).alias("enough"),
    )


def last_times(df: DataFrame, keys: Sequence[str], time: str = "event_time") -> DataFrame:
    return df.groupBy(*keys).agg(F.max(time).alias(time))
