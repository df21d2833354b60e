"""Point lines to a store, with a commit per batch: Spark data sources whose tasks report what they delivered.

A task that is tried again sends its own lines only, and a batch counts once its tasks are all through: then one
small file with the reports makes it visible. A batch that is committed already is not sent again.

Layout of a folder store: ``{root}/lines/*.txt`` and ``{root}/commits/{batch}.json``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidemark.sources.files import file_exists
from tidemark.sources.log import _store

LinesWriter = Callable[[Iterator[str]], None]


@dataclass(frozen=True)
class Delivery(WriterCommitMessage):
    """What one task has delivered: its number of lines, and their file in a folder store."""

    lines: int
    file: str | None = None


class _Writer(DataSourceArrowWriter):
    """The commit of a batch into ``ledger``, shared by both kinds of store."""

    def __init__(self, ledger: str | None, batch: str):
        self.ledger, self.batch = ledger, batch

    def commit(self, messages: list[Delivery | None]) -> None:
        if self.ledger is None:
            return
        system, folder = _store(f"{self.ledger}/commits")
        system.create_dir(folder, recursive=True)
        draft = f"{folder}/.{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as file:
            file.write(json.dumps({"batch": self.batch, "parts": [asdict(m) for m in messages if m is not None]}).encode())
        system.move(draft, f"{folder}/{self.batch}.json")  # readers see all of the batch or nothing

    def abort(self, messages: list[Delivery | None]) -> None:
        pass


class FolderWriter(_Writer):
    """A file of lines per task; files that no commit names are not read."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Delivery:
        system, folder = _store(f"{self.ledger}/lines")
        system.create_dir(folder, recursive=True)
        context = TaskContext.get()
        name = f"{self.batch}-{context.partitionId() if context else 0}-{uuid.uuid4().hex}.txt"
        lines = 0
        try:
            with system.open_output_stream(f"{folder}/{name}") as file:
                for batch in iterator:
                    if batch.num_rows:
                        lines += batch.num_rows
                        file.write(("\n".join(batch.column(0).to_pylist()) + "\n").encode())
        except BaseException:
            _drop(system, f"{folder}/{name}")
            raise
        if not lines:
            _drop(system, f"{folder}/{name}")
        return Delivery(lines, name if lines else None)

    def abort(self, messages: list[Delivery | None]) -> None:
        """Delete what the tasks that were through had written."""
        system, folder = _store(f"{self.ledger}/lines")
        for message in messages:
            if message is not None and message.file is not None:
                _drop(system, f"{folder}/{message.file}")


def _drop(system: fs.FileSystem, path: str) -> None:
    if system.get_file_info(path).type == fs.FileType.File:
        system.delete_file(path)


class SendingWriter(_Writer):
    """Lines through a function on the executors; the store keeps them, the ledger their numbers."""

    def __init__(self, ledger: str | None, batch: str, send: LinesWriter):
        super().__init__(ledger, batch)
        self.send = send

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Delivery:
        lines = 0

        def counted() -> Iterator[str]:
            nonlocal lines
            for batch in iterator:
                for line in batch.column(0).to_pylist():
                    lines += 1
                    yield line

        self.send(counted())
        return Delivery(lines)


def line_store(ledger: str | None = None, send: LinesWriter | None = None) -> type[DataSource]:
    """A data source for ``deliver``: a folder store in ``ledger``, or ``send`` with an optional ledger."""
    if ledger is None and send is None:
        raise ValueError("give a folder, a function that sends lines, or both")
    name_ = f"tidemark_lines_{uuid.uuid4().hex}"

    class Lines(DataSource):
        @classmethod
        def name(cls) -> str:
            return name_

        def schema(self) -> str:
            return "line string"

        def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
            batch = self.options["batch"]
            return FolderWriter(ledger, batch) if send is None else SendingWriter(ledger, batch, send)

    Lines.ledger = ledger
    return Lines


def deliver(lines: DataFrame, store: type[DataSource], batch: str | None = None) -> bool:
    """Whether this call delivered the lines (an action); not if ``batch`` is committed already."""
    spark = lines.sparkSession
    name = batch or uuid.uuid4().hex
    if store.ledger is not None and file_exists(spark, f"{store.ledger}/commits/{name}.json"):
        return False
    spark.dataSource.register(store)
    lines.select("line").write.format(store.name()).option("batch", name).mode("append").save()
    return True


def deliveries(spark: SparkSession, ledger: str) -> DataFrame:
    """The commits of a ledger: batch, and lines and file of each task."""
    commits = spark.read.schema("batch string, parts array<struct<lines: bigint, file: string>>").json(f"{ledger}/commits")
    return commits.select("batch", F.inline("parts"))


def read_points(spark: SparkSession, root: str) -> DataFrame:
    """The committed lines of a folder store, with their batch."""
    held = deliveries(spark, root).filter("file IS NOT NULL").select("batch", F.col("file").alias("_file"))
    lines = spark.read.text(f"{root}/lines").select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("_file"))
    return lines.join(held, "_file").select("batch", "line")
