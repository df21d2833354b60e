"""The Parquet archive: batch scans and warehouse tables.

Layout: ``{root}/{stream}/query_id=Q/batch_id=N/ingest_epoch=E/*.parquet``. The three folder
levels are partition columns, so a batch selection prunes folders before any file is opened. An index by day
beside them (``{root}/{stream}/_days``) tells which batches there are.
"""

from __future__ import annotations

import re
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.schemas import TABLE_SCHEMAS, table_ddl
from tidemark.sources.files import drop_folder, file_exists, names, paths_of, put_file, subfolders

PARTITION_SCHEMA = "query_id string, batch_id bigint, ingest_epoch bigint"


def epoch_seconds(moment: datetime | str | int) -> int:
    """Epoch seconds of a UTC moment."""
    if isinstance(moment, int):
        return moment
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return int(moment.timestamp())


def open_archive(spark: SparkSession, root: str, stream: str) -> DataFrame:
    """All batches of one stream with their partition columns."""
    return spark.read.schema(f"{table_ddl(stream)}, {PARTITION_SCHEMA}").parquet(f"{root}/{stream}")


# The level above the batches: one folder per UTC day with an empty file for every batch of it. Spark's readers do
# not see folders that begin with an underscore.
_INDEX = "_days"
_READY = "_ready"
_MARK = re.compile(r"(\d+)~(.+)~(\d+)")  # ingest epoch, query, batch
_FOLDER = "{stream}/query_id={query}/batch_id={batch}/ingest_epoch={epoch}"
DAY = 86_400


def _mark(folder: str, query: str, batch_id: int, epoch: int) -> str:
    return f"{folder}/{_INDEX}/{epoch // DAY}/{epoch}~{query}~{batch_id}"


def mark_batch(spark: SparkSession, folder: str, query: str, batch_id: int, epoch: int) -> None:
    """Enter a batch that is there into the index of its stream's ``folder``."""
    put_file(spark, _mark(folder, query, batch_id, epoch), "")


def unmark_batch(spark: SparkSession, folder: str, query: str, batch_id: int) -> None:
    """Take what is left of an earlier attempt of a batch out of the index, before it is written again."""
    for epoch in subfolders(spark, f"{folder}/query_id={query}/batch_id={batch_id}", "ingest_epoch="):
        drop_folder(spark, _mark(folder, query, batch_id, epoch))


def index_archive(spark: SparkSession, root: str, stream: str) -> None:
    """Enter all batches of an archive into its index, once; later batches are entered as they are written.

    Batches that other queries write meanwhile enter themselves, so none is missed. Archives
    with plain epoch folders are left without an index.
    """
    folder = f"{root}/{stream}"
    if file_exists(spark, f"{folder}/{_INDEX}/{_READY}"):
        return
    for epoch, paths in _listed(spark, root, stream).items():
        for path in paths:
            found = re.search(r"/query_id=([^/]+)/batch_id=(\d+)/ingest_epoch=\d+$", path)
            if found is None:
                return
            mark_batch(spark, folder, found[1], int(found[2]), epoch)
    put_file(spark, f"{folder}/{_INDEX}/{_READY}", "")


def _listed(spark: SparkSession, root: str, stream: str) -> dict[int, list[str]]:
    """The folders of each batch epoch from a listing of the whole archive."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(f"{root}/{stream}").getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[int, list[str]] = {}
    for pattern in ("query_id=*/batch_id=*/ingest_epoch=*", "[0-9]*"):
        for path in paths_of(spark, system.globStatus(hadoop(f"{root}/{stream}/{pattern}"))):
            epoch = path.rpartition("/")[2].rpartition("=")[2]
            if epoch.isdigit():
                found.setdefault(int(epoch), []).append(path)
    return found


def batch_folders(
    spark: SparkSession, root: str, stream: str, first: int | None = None, last: int | None = None,
    enough: int | None = None,
) -> dict[int, list[str]]:
    """The folders of the batch epochs from ``first`` to ``last``, newest first, ``enough`` of them; from the file
    system's listing alone, no file is opened.

    An archive with an index (see ``index_archive``; ``write_archive`` keeps one) is walked from the newest day down,
    so the cost follows what is chosen and not the archive's age. Without one the whole archive is
    listed: its own layout and folders that are plain epoch numbers.
    """
    folder = f"{root}/{stream}"
    inside = lambda epoch: (first is None or epoch >= first) and (last is None or epoch <= last)
    days = names(spark, f"{folder}/{_INDEX}")
    found: dict[int, list[str]] = {}
    if _READY not in days:
        found = {e: paths for e, paths in _listed(spark, root, stream).items() if inside(e)}
    else:
        for day in sorted((int(d) for d in days if d.isdigit()), reverse=True):
            if (last is not None and day > last // DAY) or (first is not None and day < first // DAY):
                continue
            for mark in filter(None, map(_MARK.fullmatch, names(spark, f"{folder}/{_INDEX}/{day}"))):
                epoch, query, batch = int(mark[1]), mark[2], int(mark[3])
                if inside(epoch):
                    path = f"{root}/" + _FOLDER.format(stream=stream, query=query, batch=batch, epoch=epoch)
                    found.setdefault(epoch, []).append(path)
            if enough is not None and len(found) >= enough:
                break
    return dict(sorted(found.items(), reverse=True)[:enough])


def _chosen(
    spark: SparkSession, root: str, stream: str, as_of: datetime | str | int, days_ago: float, max_batches: int
) -> dict[int, list[str]]:
    return batch_folders(spark, root, stream, last=epoch_seconds(as_of) - int(days_ago * DAY), enough=max_batches)


def newest_batches(
    spark: SparkSession, root: str, stream: str, as_of: datetime | str | int, days_ago: float = 1,
    max_batches: int = 10,
) -> list[int]:
    """The newest ``max_batches`` batch epochs that are at least ``days_ago`` days old."""
    return list(_chosen(spark, root, stream, as_of, days_ago, max_batches))


def _read(spark: SparkSession, root: str, stream: str, found: dict[int, list[str]]) -> DataFrame:
    """Rows of the given batch folders; no others are opened."""
    folders = [p for paths in found.values() for p in paths]
    columns = table_ddl(stream)
    if not folders:
        return spark.createDataFrame([], f"{columns}, ingest_epoch bigint")
    frames = []
    plain = [p for p in folders if "=" not in p.rpartition("/")[2]]
    partitioned = [p for p in folders if p not in set(plain)]
    if partitioned:
        reader = spark.read.schema(f"{columns}, {PARTITION_SCHEMA}").option("basePath", f"{root}/{stream}")
        frames.append(reader.parquet(*partitioned).drop("query_id", "batch_id"))
    if plain:
        epoch = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d+)/[^/]+$", 1).cast("long")
        rows = spark.read.schema(columns).parquet(*plain)
        frames.append(rows.select("*", epoch.alias("ingest_epoch")))
    return reduce(DataFrame.unionByName, frames)


def read_archive(
    spark: SparkSession,
    root: str,
    stream: str,
    as_of: datetime | str | int,
    days_ago: float = 1,
    max_batches: int = 10,
) -> DataFrame:
    """Rows of the selected batches (``days_ago=0`` takes the newest ones); runs no job."""
    return _read(spark, root, stream, _chosen(spark, root, stream, as_of, days_ago, max_batches))


def read_current(
    spark: SparkSession,
    root: str,
    stream: str,
    as_of: datetime | str | int,
    max_batches: int = 200,
    fraction: float = 0.1,
    days_ago: float = 1,
) -> DataFrame:
    """The newest share of the training batches, at least one: input of a prediction run."""
    return read_archive(spark, root, stream, as_of, days_ago, max(1, int(max_batches * fraction)))


def read_since(
    spark: SparkSession, root: str, stream: str, since: datetime | str | int, clock_skew: int
) -> DataFrame:
    """Rows of the batches written since ``since``, less ``clock_skew`` seconds.

    A message is archived after it happened, so a panel over a trailing interval finds all its
    rows here and skips the folders of older batches, if no message was stamped more than
    ``clock_skew`` seconds ahead of the archive's clock. The panel still filters by event time.
    """
    return _read(spark, root, stream, batch_folders(spark, root, stream, first=epoch_seconds(since) - clock_skew))


def read_batches(spark: SparkSession, root: str, stream: str, epochs: list[int]) -> DataFrame:
    """Concatenation of named batches."""
    if not epochs:
        return _read(spark, root, stream, {})
    between = batch_folders(spark, root, stream, min(epochs), max(epochs))
    return _read(spark, root, stream, {e: between[e] for e in between if e in set(epochs)})


def register_tables(
    spark: SparkSession,
    root: str,
    database: str | None = None,
    tables: list[str] | None = None,
    nested: bool = False,
) -> list[str]:
    """Make the archive folders queryable by name.

    Without ``database`` they become temporary views. With it, external tables are created over
    the folders, which are made if a stream has not come yet; ``write_archive(table=)`` adds its batches to
    them. ``nested=True`` reads archives whose batch folders are plain epoch numbers.
    """
    wanted = list(tables or TABLE_SCHEMAS)
    if database is None:
        for name in wanted:
            reader = spark.read.schema(table_ddl(name))
            if nested:
                reader = reader.option("recursiveFileLookup", "true")
            reader.parquet(f"{root}/{name}").createOrReplaceTempView(name)
        return wanted
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in wanted:
        partitioned = not nested and not name.endswith("_predict")
        columns = table_ddl(name) + (f", {PARTITION_SCHEMA}" if partitioned else "")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet "
            + ("OPTIONS (recursiveFileLookup 'true') " if nested else "")
            + ("PARTITIONED BY (query_id, batch_id, ingest_epoch) " if partitioned else "")
            + f"LOCATION '{root}/{name}'"
        )
        if partitioned:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
            spark.sql(f"MSCK REPAIR TABLE `{database}`.`{name}`")
    return wanted
