"""Archive, point and prediction sinks. Rows are encoded and written on the executors."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.encoding import has_fields, line_protocol
from tidemark.operators.points import to_line_protocol
from tidemark.schemas import TABLE_SCHEMAS, StreamSpec, stream_spec
from tidemark.session import settle
from tidemark.sources.archive import index_archive, mark_batch, unmark_batch
from tidemark.sources.files import file_exists, subfolders
from tidemark.streaming.store import LinesWriter, deliver, line_store


def trigger_options(trigger: str | None) -> dict:
    """``None`` runs as fast as possible, ``"available"`` drains the source, else a period."""
    if trigger is None:
        return {}
    return {"availableNow": True} if trigger == "available" else {"processingTime": trigger}


def _start(writer, trigger: str | None) -> StreamingQuery:
    options = trigger_options(trigger)
    return (writer.trigger(**options) if options else writer).start()


def write_archive(
    stream_df: DataFrame,
    root: str,
    stream: str | StreamSpec,
    checkpoint: str,
    trigger: str | None = "60 seconds",
    clock: Callable[[], float] = time.time,
    table: str | None = None,
) -> StreamingQuery:
    """Append each micro-batch under ``{root}/{stream}/query_id=Q/batch_id=N/ingest_epoch=E``.

    A repeated batch replaces its own folder whatever the clock says, so a restart adds no rows;
    the query id keeps batches of different checkpoints apart. A failing write stops the query.

    ``table`` names a catalogue table over the archive (see ``register_tables``): each batch becomes one of
    its partitions once its files are there, so the next query of the table sees it.
    """
    name = stream_spec(stream).name
    folder = f"{root}/{name}"
    index_archive(stream_df.sparkSession, root, name)

    def save(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        epoch = int(clock())
        archive_batch(batch, f"{folder}/query_id={query}", batch_id, epoch)
        if table is not None:
            commit_partition(batch.sparkSession, table, folder, query, batch_id)

    writer = stream_df.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return _start(writer, trigger)


def archive_batch(batch: DataFrame, folder: str, batch_id: int, epoch: int) -> None:
    """Write one batch, replacing an earlier attempt of the same batch.

    ``folder`` is ``{root}/{stream}/query_id=Q``. The batch enters the archive's index once its files are there; an
    earlier attempt leaves it before its files go, so the index never names a folder that is not there.
    """
    stream, _, query = folder.rpartition("/query_id=")
    unmark_batch(batch.sparkSession, stream, query, batch_id)
    (
        batch.withColumn("ingest_epoch", F.lit(epoch))
        .write.mode("overwrite")
        .option("compression", "snappy")
        .partitionBy("ingest_epoch")
        .parquet(f"{folder}/batch_id={batch_id}")
    )
    for written in subfolders(batch.sparkSession, f"{folder}/batch_id={batch_id}", "ingest_epoch="):
        mark_batch(batch.sparkSession, stream, query, batch_id, written)  # none of a batch without rows


def commit_partition(spark: SparkSession, table: str, folder: str, query: str, batch_id: int) -> None:
    """Make a written batch a partition of its table; that of an earlier attempt goes."""
    at = f"query_id = '{query}', batch_id = {batch_id}"
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({at})")
    epochs = subfolders(spark, f"{folder}/query_id={query}/batch_id={batch_id}", "ingest_epoch=")
    for epoch, path in epochs.items():  # one, or none of a batch without rows
        spark.sql(f"ALTER TABLE {table} ADD PARTITION ({at}, ingest_epoch = {epoch}) LOCATION '{path}'")


def http_lines_writer(url: str, token: str, batch_lines: int = 5_000, attempts: int = 4) -> LinesWriter:
    """Post lines to a point store's write address, ``batch_lines`` per request.

    A request is tried ``attempts`` times with growing pauses; a store overwrites equal points, so a
    repeated request changes nothing. Errors of the request itself (4xx) are raised at once.
    """

    def post(chunk: list[str]) -> None:
        request = urllib.request.Request(
            url, data="\n".join(chunk).encode(), headers={"Authorization": f"Token {token}"}
        )
        for attempt in range(attempts):
            try:
                with urllib.request.urlopen(request, timeout=60):
                    return
            except urllib.error.URLError as failure:
                refused = isinstance(failure, urllib.error.HTTPError) and failure.code < 500
                if refused or attempt + 1 == attempts:
                    raise
                time.sleep(2**attempt)

    def send(lines: Iterator[str]) -> None:
        while chunk := list(islice(lines, batch_lines)):
            post(chunk)

    return send


def send_lines(lines: DataFrame, writer: LinesWriter, ledger: str | None = None, batch: str | None = None) -> bool:
    """Hand each partition's lines to ``writer`` on the executors (an action).

    A task that is tried again sends its own lines only. With a ``ledger`` folder the write of ``batch`` is recorded
    there once all tasks are through, and is not done again; the result is whether it was done.
    """
    return deliver(lines, line_store(ledger, writer), batch)


def _points_saver(
    stream: str | StreamSpec, path: str | None, writer: LinesWriter | None, ledger: str | None, store: str | None
) -> Callable[[DataFrame, int], None]:
    if sum(target is not None for target in (path, writer, store)) != 1:
        raise ValueError("give one of path, writer and store")
    target = None if path is not None else line_store(store or ledger, writer)

    def save(batch: DataFrame, batch_id: int) -> None:
        lines = to_line_protocol(batch, stream)
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if target is not None:
            deliver(lines, target, f"{query}-{batch_id}")
        else:
            lines.write.mode("overwrite").text(f"{path}/query_id={query}/batch_id={batch_id}")

    return save


def write_points(
    stream_df: DataFrame,
    stream: str | StreamSpec,
    checkpoint: str,
    *,
    path: str | None = None,
    writer: LinesWriter | None = None,
    ledger: str | None = None,
    store: str | None = None,
    trigger: str | None = None,
) -> StreamingQuery:
    """Encode each micro-batch as line protocol and write it to ``path``, to a folder ``store`` or through ``writer``.

    With ``path`` a repeated batch replaces its folder. A ``store`` (see ``read_points``) commits a batch once all its tasks
    are through, and a committed batch is not written again; the same goes for ``writer`` with a
    ``ledger`` folder. A store overwrites equal points, so resending a batch without a ledger is harmless too.
    """
    save = _points_saver(stream, path, writer, ledger, store)
    query = stream_df.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return _start(query, trigger)


def write_both(
    stream_df: DataFrame,
    stream: str | StreamSpec,
    root: str,
    checkpoint: str,
    *,
    path: str | None = None,
    writer: LinesWriter | None = None,
    ledger: str | None = None,
    store: str | None = None,
    trigger: str | None = None,
    clock: Callable[[], float] = time.time,
    table: str | None = None,
) -> StreamingQuery:
    """Archive and points from one query: a batch is read and parsed once, archived, and its points are made from the
    archived rows.

    Both writes go under one batch id. A batch that failed between them is not archived again when the query
    restarts, only its points are; see ``write_archive`` and ``write_points`` for the targets.
    """
    name = stream_spec(stream).name
    folder = f"{root}/{name}"
    points = _points_saver(stream, path, writer, ledger, store)
    index_archive(stream_df.sparkSession, root, name)

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        written = f"{folder}/query_id={query}/batch_id={batch_id}"
        if not file_exists(spark, f"{written}/_SUCCESS"):
            archive_batch(batch, f"{folder}/query_id={query}", batch_id, int(clock()))
        else:  # whole, but perhaps not entered any more
            for epoch in subfolders(spark, written, "ingest_epoch="):
                mark_batch(spark, folder, query, batch_id, epoch)
        if table is not None:
            commit_partition(spark, table, folder, query, batch_id)
        points(spark.read.schema(batch.schema).parquet(written).select(*batch.columns), batch_id)

    query = stream_df.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return _start(query, trigger)


def prediction_points(predictions: DataFrame, measurement: str = "ticker") -> DataFrame:
    """Line protocol of a prediction table: three prices and the integer trade count."""
    typed = as_prediction_table(predictions)
    kinds = T.StructType.fromDDL(TABLE_SCHEMAS["ticker_predict"])
    fields = [(f.name, f.dataType) for f in kinds if f.name not in ("event_time", "symbol")]
    line = line_protocol(
        measurement, F.col("symbol"), fields, F.col("event_time"), integer_suffix="i"
    )
    return typed.filter(F.col("symbol").isNotNull() & has_fields(fields)).select(line.alias("line"))


def replace_points(
    predictions: DataFrame, path: str | None = None, writer: LinesWriter | None = None,
    clear: Callable[[], None] | None = None, measurement: str = "ticker",
) -> None:
    """Replace the stored predictions: clear the old points, then write all rows."""
    lines = prediction_points(predictions, measurement)
    if path is not None:
        lines.write.mode("overwrite").text(path)
        return
    if writer is None or clear is None:
        raise ValueError("give path, or writer and clear")
    lines = settle(lines)  # nothing is cleared before the new points are there
    clear()
    send_lines(lines, writer)


def as_prediction_table(predictions: DataFrame) -> DataFrame:
    return predictions.withColumns(
        {
            "event_time": F.col("event_time").cast("timestamp"),
            "trade_count": F.col("trade_count").cast("long"),
        }
    )


def write_predictions(predictions: DataFrame, root: str, stream: str = "ticker") -> str:
    """Replace the prediction table ``{root}/{stream}_predict``."""
    path = f"{root}/{stream}_predict"
    as_prediction_table(predictions).write.mode("overwrite").parquet(path)
    return path


def publish_forecast(
    predictions: DataFrame, root: str, stream: str = "ticker", points_path: str | None = None, **points
) -> str:
    """Prediction table and point store from one forecast. The table is written first and the
    points are read back from it, so the forecast is computed once and both agree."""
    path = write_predictions(predictions, root, stream)
    stored = predictions.sparkSession.read.parquet(path)
    replace_points(stored, path=points_path, measurement=stream, **points)
    return path
