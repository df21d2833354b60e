"""Long-running queries: live dashboards, deduplication and the per-stream jobs."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidemark.operators.cleaning import normalize_messages
from tidemark.operators.selection import latest
from tidemark.operators.windows import aggregate_window
from tidemark.sources.files import drop_folder, get_file, put_file, subfolders
from tidemark.streaming.sinks import _start, write_archive, write_both, write_points


def live_windows(
    stream_df: DataFrame, time: str, every: str, by: Sequence[str], aggs: Mapping[str, Column],
    lateness: str,
) -> DataFrame:
    """Windowed aggregates of a stream; rows of windows that ended ``lateness`` before the newest row are
    dropped. In append and update mode the state is bounded by the open windows; complete mode keeps all."""
    return aggregate_window(stream_df.withWatermark(time, lateness), time, every, by, aggs)


def live_latest(
    stream_df: DataFrame, keys: Sequence[str], time: str, tie: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row per key; one row of state per key. Write it in update or complete mode."""
    return latest(stream_df, keys, time, tie, columns)


def live_dedup(
    stream_df: DataFrame, lateness: str, keys: Sequence[str] = ("symbol", "event_time"), time: str = "event_time",
) -> DataFrame:
    """Drop repeated keys that arrive within ``lateness`` of each other."""
    return stream_df.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def write_table(
    stream_df: DataFrame, path: str, checkpoint: str, mode: str = "append",
    trigger: str | None = None, fmt: str = "parquet", rocksdb: bool = False,
) -> StreamingQuery:
    """Keep a folder with the query's result, as Parquet or (for looking at it) ``fmt="csv"``.

    ``append`` adds each batch once. ``complete`` replaces the folder with the whole result.
    ``update`` keeps one folder per batch with the rows that changed in it (see ``read_updates``, ``merge_updates``).
    ``rocksdb`` keeps the query's state in RocksDB, as ``live_latest_expiring`` needs.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        target = path if mode == "complete" else f"{path}/batch_id={batch_id}"
        options = {"header": "true"} if fmt == "csv" else {}
        batch.write.mode("overwrite").format(fmt).options(**options).save(target)

    writer = stream_df.writeStream.foreachBatch(save).outputMode(mode)
    with state_store(stream_df.sparkSession, rocksdb):
        return _start(writer.option("checkpointLocation", checkpoint), trigger)


_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def state_store(spark: SparkSession, rocksdb: bool):
    """Queries started inside keep their state in RocksDB; a query takes the setting with it when it starts."""
    before = spark.conf.get(_STORE, None)
    if rocksdb:
        spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if rocksdb:
            spark.conf.unset(_STORE) if before is None else spark.conf.set(_STORE, before)


def read_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The table that an ``update`` query keeps: of each key the row of its newest batch."""
    merged, base = _merged(spark, path)
    return _newest_rows(_changes(spark, path, merged, base), keys)


def _merged(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """The last batch that the table's merged rows hold, and their folder."""
    text = get_file(spark, f"{path}/_merged.json")
    if text is None:
        return -1, None
    last = json.loads(text)["last"]
    return last, f"{path}/_merged/last={last}"


def _changes(spark: SparkSession, path: str, merged: int, base: str | None, until: int | None = None) -> DataFrame:
    """The merged rows and those of the batches behind them, with the batch that they come from."""
    new = {n: p for n, p in subfolders(spark, path, "batch_id=").items() if n > merged and (until is None or n <= until)}
    frames = [spark.read.option("basePath", path).parquet(*new.values())] if new else []
    if base is not None:
        frames.append(spark.read.parquet(base).withColumn("batch_id", F.lit(merged)))
    if not frames:
        return spark.read.parquet(path)  # nothing is there yet: Spark says so
    return reduce(DataFrame.unionByName, frames)


def _newest_rows(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [c for c in changes.columns if c not in keys and c != "batch_id"]
    newest = F.max_by(F.struct(*rest), "batch_id").alias("_row")
    return changes.groupBy(*keys).agg(newest).select(*keys, "_row.*")


def merge_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> int | None:
    """Merge the batches of an ``update`` table into one row per key; the last batch merged, or None (an action).

    The newest batch is left, since a restarted query may write it again. The merged rows become visible by one
    small file that is swapped, so a reader sees them or the batches, never both or neither. What the
    merge before this one had replaced is deleted; so a reader may go on with the files that it has listed until
    the second merge after that. ``read_updates`` then opens the merged rows and the few batches behind them.
    One merge at a time; the query may run on meanwhile.
    """
    merged, base = _merged(spark, path)
    batches = list(subfolders(spark, path, "batch_id="))
    ready = [n for n in batches[:-1] if n > merged]
    if not ready:
        return None
    last = ready[-1]
    _newest_rows(_changes(spark, path, merged, base, last), keys).write.mode("overwrite").parquet(f"{path}/_merged/last={last}")
    put_file(spark, f"{path}/_merged.json", json.dumps({"last": last}), replace=True)
    for n, folder in subfolders(spark, path, "batch_id=").items():
        if n <= merged:
            drop_folder(spark, folder)
    for n, folder in subfolders(spark, f"{path}/_merged", "last=").items():
        if n < merged:
            drop_folder(spark, folder)
    return last


class _Newest(StatefulProcessor):
    """Per key the rank of its newest row, dropped once the watermark is ``idle`` milliseconds past it."""

    def __init__(self, idle: int, tie: str | None):
        self.idle, self.tie = idle, tie

    def init(self, handle) -> None:
        self.handle = handle
        self.rank = handle.getValueState("rank", f"micros long{', tie ' + self.tie if self.tie else ''}")

    def handleInputRows(self, key, rows, timerValues):
        known = tuple(self.rank.get()) if self.rank.exists() else None
        best, newest = known, None
        for row in rows:
            rank = (row["_micros"], row["_tie"]) if self.tie else (row["_micros"],)
            if row["_micros"] is not None and (best is None or _after(rank, best)):
                best, newest = rank, row
        if newest is None:
            return
        self.rank.update(best)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(best[0] // 1000 + self.idle)
        yield Row(**{c: newest[c] for c in newest.asDict(recursive=False) if c not in ("_micros", "_tie")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.rank.clear()
        return iter(())

    def close(self) -> None:
        pass


def _after(rank: tuple, other: tuple) -> bool:
    """Whether a rank is greater; NULL is less than anything."""
    return [() if v is None else (v,) for v in rank] > [() if v is None else (v,) for v in other]


def live_latest_expiring(
    stream_df: DataFrame, keys: Sequence[str], time: str, lateness: str, idle: str, tie: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row per key, with state only for keys that are not idle; write it in update mode.

    A key is forgotten once the watermark is ``idle`` past its newest row. Its last row stays in the table; rows
    older than the watermark are dropped, so a forgotten key cannot go back. The state of a key is the rank of
    its newest row, kept in RocksDB (see ``write_table``). Rows without a time do not count. ``columns`` are the
    columns to give (all without).
    """
    spark = stream_df.sparkSession
    idle_ms = spark.sql(f"SELECT unix_millis(timestamp_millis(0) + INTERVAL {idle})").first()[0]
    wanted = list(columns or stream_df.columns)
    kinds = dict(stream_df.dtypes)
    marked = stream_df.withWatermark(time, lateness).select(
        *dict.fromkeys([*keys, *wanted, time]), F.unix_micros(time).alias("_micros"), *([F.col(tie).alias("_tie")] if tie else []))
    out = T.StructType([marked.schema[c] for c in marked.columns if c not in ("_micros", "_tie")])
    return marked.groupBy(*keys).transformWithState(_Newest(idle_ms, kinds[tie] if tie else None), out, "Update", "EventTime").select(*wanted)


@dataclass(frozen=True)
class StreamQueries:
    """The two queries of one stream type; they advance independently."""

    points: StreamingQuery
    archive: StreamingQuery


def start_stream(
    messages: DataFrame,
    stream: str,
    archive_root: str,
    checkpoint_root: str,
    *,
    points_path: str | None = None,
    points_writer=None,
    strict: bool = False,
    symbols: Sequence[str] | None = None,
    archive_trigger: str | None = "60 seconds",
    points_trigger: str | None = None,
    event_time: str | None = None,
) -> StreamQueries:
    """Clean one message stream and feed the archive and the point store from it.

    One pair of queries serves all symbols of the stream; each sink has its own checkpoint.
    """
    rows = normalize_messages(messages, stream, strict, symbols, event_time)
    points = write_points(
        rows, stream, f"{checkpoint_root}/{stream}/points", path=points_path, writer=points_writer,
        trigger=points_trigger,
    )
    archive = write_archive(
        rows, archive_root, stream, f"{checkpoint_root}/{stream}/archive", archive_trigger
    )
    return StreamQueries(points, archive)


def start_stream_once(
    messages: DataFrame, stream: str, archive_root: str, checkpoint_root: str, *, strict: bool = False,
    symbols: Sequence[str] | None = None, trigger: str | None = "60 seconds", event_time: str | None = None, **targets,
) -> StreamingQuery:
    """Like ``start_stream`` with one query for both sinks, which reads and parses a message once (see ``write_both``)."""
    rows = normalize_messages(messages, stream, strict, symbols, event_time)
    return write_both(rows, stream, archive_root, f"{checkpoint_root}/{stream}/both", trigger=trigger, **targets)


def await_any(spark: SparkSession, timeout: float | None = None) -> bool | None:
    """Block until any query ends; a failure in any of them is raised here at once."""
    if timeout is None:
        return spark.streams.awaitAnyTermination()
    return spark.streams.awaitAnyTermination(timeout)


def run_all(spark: SparkSession, *queries: StreamingQuery, timeout: float | None = None) -> None:
    """Run until the first query ends or fails, then stop the others; a failure is raised."""
    try:
        await_any(spark, timeout)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def drain(*queries: StreamingQuery, timeout: float = 600) -> None:
    """Wait for ``available`` queries to finish; raise the first failure or a timeout."""
    for query in queries:
        if not query.awaitTermination(timeout):
            query.stop()
            raise TimeoutError(f"query {query.id} did not finish in {timeout} s")
