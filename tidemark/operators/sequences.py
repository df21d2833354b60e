"""Sliding samples over positioned series.

A series is cut into blocks of ``block`` start positions. Each block also receives the rows its
last windows reach into, so it can be windowed alone: a row is copied at most once, a group never
holds more than two blocks of rows, and one long series spreads over as many tasks as it has
blocks. Blocks and tasks are sized by the windows that they write.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import calendar
from tidemark.operators.joins import lookup_join

MIN_BLOCK = 4_096
TASK_BYTES = 1 << 30  # of windows that a task is to write at most
BLOCK_SHARE = 16  # a block writes at most this part of it, unless that were fewer rows than one window


def windows_index(
    df: DataFrame, keys: Sequence[str], seq: int, pred: int, stride: int = 1,
    position: str = "position", length: str = "series_length",
) -> DataFrame:
    """The samples as (keys, sample_id, start_pos) without their content: a filter on positions."""
    start = F.col(position)
    fits = start <= F.col(length) - F.lit(seq + pred)
    return df.filter(fits & (start % stride == 0)).select(
        *keys, F.floor(start / F.lit(stride)).cast("long").alias("sample_id"), start.alias("start_pos")
    )


def block_size(span: int, window_bytes: int, task_bytes: int = TASK_BYTES) -> int:
    """Start positions of a block, so that tasks can be filled evenly with whole blocks."""
    return max(span, min(MIN_BLOCK, task_bytes // BLOCK_SHARE // max(window_bytes, 1)))


def window_tasks(df: DataFrame, window_bytes: int, stride: int = 1, task_bytes: int = TASK_BYTES) -> int:
    """Tasks for the windows of ``df``, at least the session's shuffle partitions (counts the rows, an action).

    The windows of all rows are dealt out in parts of a quarter of ``task_bytes``, since blocks go to tasks by a hash
    and a task may get some times the mean.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, ceil(df.count() / stride * window_bytes / (task_bytes / 4)))


def block_windows(
    df: DataFrame, keys: Sequence[str], lanes: Mapping[str, Column], span: int,
    stride: int = 1, position: str = "position", block: int | None = None,
    partitions: int | None = None, window_bytes: int | None = None, task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """One row per window of ``span`` rows: keys, sample_id, start_pos, and the lane arrays of the
    whole block with ``_at``, the 1-based place in them where the window starts.

    The output is up to ``span`` times the input, so tasks must not be sized by their input: the blocks
    go to ``partitions`` tasks, which adaptive execution does not merge. Without that number it follows from
    the rows, which are counted, and the size of one window (default: twice ``span`` rows of doubles).
    """
    window_bytes = window_bytes or 16 * span * len(lanes)
    size = block or block_size(span, window_bytes, task_bytes)
    if size < span - 1:
        raise ValueError("block must be at least span - 1")
    p = F.col(position)
    own = F.floor(p / F.lit(size)).cast("long")
    reached = (p % size < span - 1) & (p >= size)
    rows = df.select(
        *keys,
        p.alias("_pos"),
        *[column.alias(name) for name, column in lanes.items()],
        F.explode(F.when(reached, F.array(own, own - 1)).otherwise(F.array(own))).alias("_block"),
    )
    count = partitions or window_tasks(df, window_bytes, stride, task_bytes)
    grouped = rows.repartition(count, *keys, "_block").groupBy(*keys, "_block").agg(
        F.sort_array(F.collect_list(F.struct("_pos", *lanes))).alias("_rows")
    )
    blocks = grouped.filter(F.size("_rows") >= span).select(
        *keys,
        F.col("_rows")[0]["_pos"].alias("_begin"),
        (F.size("_rows") - span).alias("_last"),
        *[F.col(f"_rows.{name}").alias(name) for name in lanes],
    )
    windows = blocks.select(
        *keys, "_begin", *lanes, F.explode(F.sequence(F.lit(0), F.col("_last"))).alias("_step")
    )
    start = F.col("_begin") + F.col("_step")
    if stride > 1:
        windows = windows.filter(start % stride == 0)
    return windows.select(
        *keys,
        F.floor(start / F.lit(stride)).cast("long").alias("sample_id"),
        start.alias("start_pos"),
        (F.col("_step") + 1).alias("_at"),
        *lanes,
    )


def float_array(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("float") for c in columns])


def decoder_padding(features: int, pred: int, padding: float = 0.0) -> Column:
    """Rows that stand for the unknown horizon: all zeros or all ones."""
    return F.array_repeat(F.array_repeat(F.lit(float(padding)).cast("float"), features), pred)


def make_windows(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    marks: Sequence[str],
    seq: int,
    pred: int,
    label: int | None = None,
    stride: int = 1,
    padding: float = 0.0,
    position: str = "position",
    block: int | None = None,
    partitions: int | None = None,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Encoder/decoder samples: keys, sample_id, start_pos, x, x_mark, x_dec, x_mark_dec, y.

    ``x`` is ``seq`` rows, ``y`` the next ``pred``. The decoder sees the last ``label`` rows
    (default seq - pred) and ``pred`` padding rows. ``position`` must count 0, 1, 2, ... per key.
    No task writes much more than ``task_bytes`` of samples (the rows are counted for that, an action, unless
    ``partitions`` names the number of tasks).
    """
    label = seq - pred if label is None else label
    wide = 4 * ((seq + label + 2 * pred) * len(features) + (seq + label + pred) * len(marks))
    lanes = {"_f": float_array(features), "_m": float_array(marks)}
    windows = block_windows(df, keys, lanes, seq + pred, stride, position, block, partitions, wide, task_bytes)
    at = F.col("_at")
    known = F.slice("_f", at + (seq - label), F.lit(label))
    return windows.select(
        *keys,
        "sample_id",
        "start_pos",
        F.slice("_f", at, F.lit(seq)).alias("x"),
        F.slice("_m", at, F.lit(seq)).alias("x_mark"),
        F.concat(known, decoder_padding(len(features), pred, padding)).alias("x_dec"),
        F.slice("_m", at + (seq - label), F.lit(label + pred)).alias("x_mark_dec"),
        F.slice("_f", at + seq, F.lit(pred)).alias("y"),
    )


def windows_overlap(
    df: DataFrame,
    keys: Sequence[str],
    scaled: Sequence[str],
    raw: Sequence[str],
    marks: Sequence[str],
    seq: int,
    label: int,
    pred: int,
    inverse: bool = False,
    stride: int = 1,
    position: str = "position",
    block: int | None = None,
    partitions: int | None = None,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Samples whose target overlaps the input by ``label`` rows.

    ``inverse`` takes the horizon part of the target from the unscaled columns ``raw``. Tasks are sized as in
    ``make_windows``.
    """
    wide = 4 * (seq + label + pred) * (len(scaled) + len(marks))
    lanes = {"_f": float_array(scaled), "_m": float_array(marks)}
    if inverse:
        lanes["_r"] = float_array(raw)
    windows = block_windows(df, keys, lanes, seq + pred, stride, position, block, partitions, wide, task_bytes)
    at = F.col("_at")
    overlap = F.slice("_f", at + (seq - label), F.lit(label))
    horizon = F.slice("_r" if inverse else "_f", at + seq, F.lit(pred))
    return windows.select(
        *keys,
        "sample_id",
        "start_pos",
        F.slice("_f", at, F.lit(seq)).alias("x"),
        F.concat(overlap, horizon).alias("y"),
        F.slice("_m", at, F.lit(seq)).alias("x_mark"),
        F.slice("_m", at + (seq - label), F.lit(label + pred)).alias("y_mark"),
    )


def feature_mode(
    df: DataFrame, mode: str, target: str, columns: Sequence[str] | None = None, time: str = "date"
) -> DataFrame:
    """Column order ``time, others..., target``: ``M`` and ``MS`` read all features, ``S`` only
    the target. Other columns (keys, position) stay in front when ``columns`` names the features."""
    if mode not in ("M", "S", "MS"):
        raise ValueError("mode must be M, S or MS")
    if mode == "S":
        return df.select(time, target)
    others = [c for c in (columns or df.columns) if c not in (time, target)]
    return df.select(time, *others, target)


def target_columns(mode: str, features: Sequence[str]) -> list[str]:
    """Columns a model must predict: the last one in ``MS`` mode, else all."""
    return [features[-1]] if mode == "MS" else list(features)


def prediction_frame(
    df: DataFrame, keys: Sequence[str], time: str, seq: int, pred: int, freq: str,
    position: str = "position", length: str = "series_length",
) -> DataFrame:
    """The last ``seq`` rows of each series and ``pred`` future timestamps (values NULL).

    Adds ``step``: -(seq-1)..0 for known rows, 1..pred for future ones, and ``is_future``.
    """
    known = df.filter(F.col(position) >= F.col(length) - seq).withColumn(
        "step", (F.col(position) - F.col(length) + 1).cast("int")
    )
    values = [c for c in df.columns if c not in (*keys, time, position, length)]
    last = df.filter(F.col(position) == F.col(length) - 1)
    future = last.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(pred)))).select(
        *keys,
        calendar.future_time(F.col(time), F.col("step"), freq).alias(time),
        *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in values],
        "step",
        F.lit(True).alias("is_future"),
    )
    return known.select(*keys, time, *values, "step", F.lit(False).alias("is_future")).unionByName(future)


def with_batch_id(
    windows: DataFrame, keys: Sequence[str], size: int, drop_last: bool = True,
    sample: str = "sample_id",
) -> DataFrame:
    """Fixed-size batches in sample order; ``drop_last`` drops the incomplete one (runs jobs).

    Needs sample ids 0, 1, 2, ... per key.
    """
    batched = windows.withColumn("batch_id", F.floor(F.col(sample) / F.lit(size)).cast("long"))
    if not drop_last:
        return batched
    counts = windows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_samples"))
    sized = lookup_join(batched, counts, keys)
    return sized.filter(F.col("batch_id") < F.floor(F.col("_samples") / F.lit(size))).drop("_samples")


PRIME = 2**31 - 1  # products of two rests stay within a long


def shuffle_samples(
    windows: DataFrame, keys: Sequence[str], seed: int, sample: str = "sample_id"
) -> DataFrame:
    """Renumber the samples of each key in a seeded pseudo-random order (runs jobs).

    The order is that of a quadratic congruence of the sample number, which any SQL engine can repeat.
    """
    from tidemark.operators.positions import with_position

    x = (F.col(sample) % PRIME * F.lit(48_271) + F.lit(seed)) % PRIME
    drawn = windows.withColumn("_x", x.cast("long")).withColumn(
        "_draw", (F.col("_x") * F.col("_x") % PRIME * F.lit(69_621) + F.col("_x")) % PRIME).drop("_x")
    renumbered = with_position(drawn, keys, ["_draw", sample], position="_new")
    return renumbered.withColumn(sample, F.col("_new")).drop("_draw", "_new")


def decode_forecast(
    forecast: DataFrame,
    stats: DataFrame,
    last: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    horizon: str = "horizon",
    time: str = "event_time",
    step: str = "1 second",
) -> DataFrame:
    """One row per forecast step in original units (runs jobs to size the lookups).

    ``horizon`` holds one array of scaled feature values per step; step k is stamped
    ``last + k * step``. Calendar encodings beyond the feature columns are ignored.
    """
    from tidemark.operators.scaling import minmax_inverse
    from tidemark.operators.windows import interval_micros

    steps = forecast.select(*keys, F.posexplode(horizon).alias("_k", "_values"))
    wide = steps.select(
        *keys,
        "_k",
        *[F.col("_values")[i].cast("double").alias(name) for i, name in enumerate(features)],
    )
    restored = minmax_inverse(wide, stats, keys, features)
    stamped = lookup_join(restored, last.select(*keys, F.col(time).alias("_last")), keys)
    moved = F.unix_micros("_last") + (F.col("_k") + 1) * F.lit(interval_micros(step))
    return stamped.select(F.timestamp_micros(moved).alias(time), *keys, *features)
