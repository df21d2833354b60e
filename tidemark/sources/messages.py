"""Message streams: subscribe, decode, encode and publish JSON payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.schemas import StreamSpec, stream_spec
from tidemark.sources.log import append_log, stream_log


def topic_name(prefix: str, stream: str | StreamSpec) -> str:
    return f"{prefix}_{stream_spec(stream).name}"


def read_stream(
    spark: SparkSession,
    stream: str | StreamSpec,
    source: str = "kafka",
    *,
    prefix: str = "market",
    servers: str | None = None,
    path: str | None = None,
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    **options: str,
) -> DataFrame:
    """Unbounded frame with a ``value`` column for one stream type.

    ``kafka`` subscribes to ``{prefix}_{stream}`` (the connector jar must be on the class path);
    ``log`` reads the same topic of a message log below ``path``, with the same columns and offsets;
    ``files`` replays a folder of JSON lines, one message per line.
    """
    if source == "kafka":
        if not servers:
            raise ValueError("servers is required for the kafka source")
        return (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic_name(prefix, stream))
            .option("startingOffsets", starting)
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
            .options(**options)
            .load()
        )
    if source == "log":
        if not path:
            raise ValueError("path is required for the log source")
        return stream_log(spark, path, topic_name(prefix, stream), starting, fail_on_data_loss)
    if source == "files":
        if not path:
            raise ValueError("path is required for the files source")
        return spark.readStream.options(**options).text(path)
    raise ValueError(f"unknown source {source!r}; use 'kafka', 'log' or 'files'")


def decode_json(
    df: DataFrame,
    stream: str | StreamSpec,
    value: str = "value",
    passthrough: Sequence[str] = (),
) -> DataFrame:
    """Parse the payload into one column per declared field, named as in the warehouse.

    Declared names differ only in case (``p``/``P``), so the columns are renamed by position and
    work in case-insensitive sessions too. ``inline`` keeps the parser in one place: a filter on
    the decoded columns would otherwise be merged with the projection and parse the payload once
    per predicate. Malformed payloads give a row of NULLs.
    """
    spec = stream_spec(stream)
    record = F.from_json(F.col(value).cast("string"), spec.raw_schema)
    return df.select(*passthrough, F.inline(F.array(record)).alias(*[f.name for f in spec.fields]))


def apply_declared_schema(df: DataFrame, stream: str | StreamSpec, value: str = "value") -> DataFrame:
    """Typed columns under their declared (case-sensitive) names; needs ``caseSensitive=true``."""
    spec = stream_spec(stream)
    record = F.from_json(F.col(value).cast("string"), spec.raw_schema)
    return df.select(F.inline(F.array(record)).alias(*[f.raw for f in spec.fields]))


def _raw_value(field) -> Column:
    column = F.col(field.name)
    if field.convert == "number":
        return column.cast("string")
    if field.convert == "millis":
        return F.unix_millis(column)
    return column


def encode_messages(
    df: DataFrame,
    stream: str | StreamSpec,
    prefix: str = "market",
    key: str = "symbol",
) -> DataFrame:
    """Topic, key and JSON value of each row under the declared field names.

    NULL columns are left out of the JSON, as are declared fields the frame does not carry.
    """
    spec = stream_spec(stream)
    present = set(df.columns)
    payload = F.struct(*[_raw_value(f).alias(f.raw) for f in spec.fields if f.name in present])
    return df.select(
        F.lit(topic_name(prefix, spec)).alias("topic"),
        F.col(key).cast("string").alias("key"),
        F.to_json(payload).alias("value"),
    )


def publish(
    df: DataFrame,
    stream: str | StreamSpec,
    *,
    prefix: str = "market",
    servers: str | None = None,
    path: str | None = None,
    log: str | None = None,
    checkpoint: str | None = None,
):
    """Send rows as keyed JSON messages to Kafka (``servers``), to a message log (``log``) or to JSON-lines files
    (``path``).

    A streaming frame starts a query and needs ``checkpoint``; a batch frame writes at once.
    """
    if sum(map(bool, (servers, path, log))) != 1:
        raise ValueError("give one of servers, path and log")
    messages = encode_messages(df, stream, prefix)
    if log:
        topic = topic_name(prefix, stream)
        if not df.isStreaming:
            append_log(messages, log, topic)
            return None
        if not checkpoint:
            raise ValueError("checkpoint is required to publish a stream")

        def append(batch: DataFrame, batch_id: int) -> None:
            query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            append_log(batch, log, topic, append=f"{query}-{batch_id}")

        return messages.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).start()
    if servers:
        target, options = "kafka", {"kafka.bootstrap.servers": servers}
    else:
        messages, target, options = messages.select("value"), "text", {"path": path}
    if df.isStreaming:
        if not checkpoint:
            raise ValueError("checkpoint is required to publish a stream")
        return (
            messages.writeStream.format(target)
            .options(**options)
            .option("checkpointLocation", checkpoint)
            .start()
        )
    messages.write.format(target).options(**options).mode("append").save()
    return None
