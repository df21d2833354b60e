"""A message log in a folder: topics of numbered partitions, read by offset like a broker's.

An append writes its messages as Parquet segments and then commits them by a small file whose name is the next
number; the file system lets only one writer have that name. The commit gives each segment its first offset, so
a writer that lost the race commits again without writing anything anew. Offsets of a partition have no gaps.

Layout: ``{root}/{topic}/segments/{append}/partition=P/segment=S/*.parquet`` and ``{root}/{topic}/commits/N.json``.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidemark.operators.positions import with_position
from tidemark.sources.files import put_file

FORMAT = "tidemark_log"
ENVELOPE = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
_ARROW = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()),
                    ("offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC"))])


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if "://" not in path else fs.FileSystem.from_uri(path)


@dataclass(frozen=True)
class Segment(InputPartition):
    """The rows of one file from ``begin`` to before ``end``, whose first row has offset ``base``."""

    path: str
    topic: str
    partition: int
    base: int
    begin: int
    end: int


class LogIndex:
    """The committed segments of one topic. Commits are read once; later calls read only new ones."""

    def __init__(self, root: str, topic: str):
        self.root, self.topic = root, topic
        self.commits = 0
        self.appends: set[str] = set()
        self.segments: dict[int, list[tuple[int, int, str]]] = defaultdict(list)  # base, end, path

    def refresh(self) -> LogIndex:
        system, base = _store(f"{self.root}/{self.topic}/commits")
        while system.get_file_info(name := f"{base}/{self.commits:020d}.json").type == fs.FileType.File:
            with system.open_input_stream(name) as file:
                commit = json.loads(file.read())
            self.appends.add(commit["append"])
            for partition, first, rows, path in commit["segments"]:
                self.segments[partition].append((first, first + rows, path))
            self.commits += 1
        return self

    def ends(self) -> dict[int, int]:
        return {p: held[-1][1] for p, held in self.segments.items()}

    def between(self, start: dict[int, int], end: dict[int, int], fail_on_loss: bool) -> list[Segment]:
        """The segments that hold the offsets from ``start`` to before ``end``; lost files are left out or raise."""
        system, folder = _store(f"{self.root}/{self.topic}/segments")
        found = []
        for partition, last in end.items():
            first = start.get(partition, 0)
            for base, stop, path in self.segments.get(partition, ()):
                if base < last and stop > first:
                    found.append(Segment(f"{folder}/{path}", self.topic, partition, base, max(first, base), min(last, stop)))
        there = system.get_file_info([s.path for s in found])
        lost = [s for s, info in zip(found, there) if info.type != fs.FileType.File]
        if lost and fail_on_loss:
            raise FileNotFoundError(f"{len(lost)} segments of {self.topic} are lost, the first {lost[0]}")
        return [s for s in found if s not in set(lost)]


def _read(root: str, segment: Segment, fail_on_loss: bool) -> Iterator[pa.RecordBatch]:
    system, _ = _store(root)
    try:
        file = pq.ParquetFile(system.open_input_file(segment.path))
    except FileNotFoundError:
        if fail_on_loss:
            raise
        return
    at = segment.base
    for group in range(file.num_row_groups):
        rows = file.metadata.row_group(group).num_rows
        if at + rows > segment.begin and at < segment.end:
            for batch in file.iter_batches(row_groups=[group], columns=["key", "value", "timestamp"], batch_size=8192):
                skip = max(0, segment.begin - at)
                part = batch.slice(skip, max(0, min(segment.end - at, batch.num_rows) - skip))
                offset = pa.array(range(at + skip, at + skip + part.num_rows), pa.int64())
                at += batch.num_rows
                n = part.num_rows
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [part.column("key").cast(pa.binary()), part.column("value").cast(pa.binary()), pa.array([segment.topic] * n),
                         pa.array([segment.partition] * n, pa.int32()), offset,
                         pc.cast(part.column("timestamp"), pa.timestamp("us", "UTC"))], schema=_ARROW)
        else:
            at += rows


def _flag(options: dict, name: str, default: str) -> bool:
    return options.get(name, default).lower() == "true"


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.root, self.topic = options["path"], options["topic"]
        self.starting = options.get("startingoffsets", "latest")
        self.fail_on_loss = _flag(options, "failondataloss", "true")
        self.index = LogIndex(self.root, self.topic)

    def initialOffset(self) -> dict:
        ends = self.index.refresh().ends()
        if self.starting == "latest":
            return {str(p): end for p, end in ends.items()}
        if self.starting == "earliest":
            return {}
        named = {int(p): int(at) for p, at in json.loads(self.starting).items()}
        if beyond := {p: at for p, at in named.items() if at > ends.get(p, 0)}:
            raise ValueError(f"{self.topic} has no such offsets yet: {beyond}")
        return {str(p): at for p, at in named.items()}

    def latestOffset(self) -> dict:
        return {str(p): end for p, end in self.index.refresh().ends().items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        number = lambda offsets: {int(p): at for p, at in offsets.items()}
        return self.index.refresh().between(number(start), number(end), self.fail_on_loss)

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return _read(self.root, partition, self.fail_on_loss)


class LogReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.topic = options["path"], options["topic"]
        self.fail_on_loss = _flag(options, "failondataloss", "true")

    def partitions(self) -> list[InputPartition]:
        index = LogIndex(self.root, self.topic).refresh()
        return index.between({}, index.ends(), self.fail_on_loss) or [Segment("", self.topic, 0, 0, 0, 0)]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return _read(self.root, partition, self.fail_on_loss) if partition.path else iter(())


class LogSource(DataSource):
    """``path`` and ``topic`` name the log; ``startingOffsets`` is latest, earliest or JSON by partition (the first
    offset to read; partitions that are not named begin at 0); ``failOnDataLoss`` false skips lost segments."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ENVELOPE

    def _options(self) -> dict:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema) -> DataSourceReader:
        return LogReader(self._options())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LogStreamReader(self._options())


def read_log(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """All messages of a topic with key, value, topic, partition, offset and timestamp."""
    spark.dataSource.register(LogSource)
    return spark.read.format(FORMAT).option("path", root).option("topic", topic).load()


def stream_log(spark: SparkSession, root: str, topic: str, starting: str = "latest", fail_on_data_loss: bool = True) -> DataFrame:
    """A topic as a stream; a restarted query goes on at the offsets of its checkpoint."""
    spark.dataSource.register(LogSource)
    reader = spark.readStream.format(FORMAT).option("path", root).option("topic", topic)
    return reader.option("startingOffsets", starting).option("failOnDataLoss", str(fail_on_data_loss).lower()).load()


def append_log(
    messages: DataFrame, root: str, topic: str, partitions: int = 8, segment_rows: int = 1_000_000,
    append: str | None = None,
) -> int | None:
    """Append key, value and, if there is one, timestamp of ``messages``; the number of the commit (runs jobs).

    Equal keys share a partition, messages without a key are dealt by their value; within a partition they
    follow timestamp, key and value. Rows are numbered range by range, so a key with a third of all messages fills
    many tasks. ``append`` names this append: one that is committed already is not done again (then
    the result is None). Topics are made by their first append.
    """
    spark = messages.sparkSession
    append = append or uuid.uuid4().hex
    index = LogIndex(root, topic).refresh()
    if append in index.appends:
        return None
    moment = F.col("timestamp").cast("timestamp") if "timestamp" in messages.columns else F.current_timestamp()
    rows = messages.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), moment.alias("timestamp"))
    dealt = F.pmod(F.xxhash64(F.coalesce("key", "value")), F.lit(partitions)).cast("int")
    placed = with_position(rows.withColumn("partition", dealt), ["partition"], ["timestamp", "key", "value"])
    folder = f"{root}/{topic}/segments"
    name = f"{append}-{uuid.uuid4().hex}"  # a second attempt writes a folder of its own
    cut = placed.withColumn("segment", F.expr(f"position div {segment_rows}"))
    cut.repartition("partition", "segment").sortWithinPartitions("partition", "segment", "position").write.option(
        "maxRecordsPerFile", 0).partitionBy("partition", "segment").parquet(f"{folder}/{name}")
    held = spark.read.schema("position bigint, partition int, segment bigint").parquet(f"{folder}/{name}").groupBy(
        "partition", "segment", F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    # one line per segment
    found = sorted((r["partition"], r["segment"], r["rows"], f"{name}/partition={r['partition']}/segment={r['segment']}/{r['file']}")
                   for r in held.collect())
    while True:
        ends = defaultdict(int, index.refresh().ends())
        if append in index.appends:
            return None
        segments = []
        for partition, _, rows_, path in found:
            segments.append([partition, ends[partition], rows_, path])
            ends[partition] += rows_
        # a rename that replaces nothing decides whose commit has this number
        if put_file(spark, f"{root}/{topic}/commits/{index.commits:020d}.json", json.dumps({"append": append, "segments": segments})):
            return index.commits
