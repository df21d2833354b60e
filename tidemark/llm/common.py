"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from itertools import count
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import settle, settle_sized

BROADCAST_BYTES = 32 << 20

Batches = Iterator[pa.RecordBatch]


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, in any letter case."""
    taken = {c.lower() for c in df.columns}
    name, k = stem, 0
    while name.lower() in taken:
        k += 1
        name = f"{stem}_{k}"
    return name


def text_of(column: str) -> Column:
    """The text, NULL counting as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def numbered(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The given columns and ``uid``, a number that tells equal rows apart within one job.

    The number comes from the input partition and the place in it. Another job may cut the same files into other
    partitions, so what is joined to the rows again takes ``identified``.
    """
    return df.select(F.monotonically_increasing_id().alias("uid"), *[c.alias(n) for n, c in columns.items()])


_FILES: WeakKeyDictionary[DataFrame, tuple[DataFrame, DataFrame, int]] = WeakKeyDictionary()


def _reads_parquet(df: DataFrame) -> bool:
    """Whether each row of ``df`` is one row of a Parquet file whose place can still be asked for."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if plan.nodeName() != "LogicalRelation":
        return False
    try:
        df.select(df.metadataColumn("_metadata")["row_index"]).schema
    except AnalysisException:
        return False
    return True


def _files(df: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """``df`` as read from Parquet files, written once if it is not, and a number for each of the files by a hash
    of its path, with the hash's seed (runs jobs that read no column)."""
    if df not in _FILES:
        source = df if _reads_parquet(df) else settle(df)
        paths = source.select(source.metadataColumn("_metadata")["file_path"].alias("path")).distinct()
        ranked = settle(paths.select("path", (F.row_number().over(Window.orderBy("path")) - 1).cast("long").alias("number")))
        seed, files = 0, ranked.count()
        while ranked.select(F.xxhash64("path", F.lit(seed))).distinct().count() < files:
            seed += 1
        numbers, size = settle_sized(ranked.select(F.xxhash64("path", F.lit(seed)).alias("file"), "number"))
        _FILES[df] = source, F.broadcast(numbers) if size <= BROADCAST_BYTES else numbers, seed
    return _FILES[df]


def identified(df: DataFrame, columns: dict[str, Column] | None = None, uid: str = "uid") -> DataFrame:
    """The given columns (all of ``df`` without) and ``uid``, a number that each row keeps in every job.

    It is made of the file that holds the row and the row's place in it, whatever the partitions that the
    file is read in. Rows that do not come from Parquet files as they are get written to such files first.
    """
    source, numbers, seed = _files(df)
    names = list(columns) if columns is not None else df.columns
    place = source.metadataColumn("_metadata")
    taken = {n.lower() for n in [*names, uid]}
    file, row, number = (next(n for k in count() if (n := f"_{stem}{k}") not in taken) for stem in ("file", "row", "number"))
    own = [c.alias(n) for n, c in columns.items()] if columns is not None else ["*"]
    rows = source.select(*own, F.xxhash64(place["file_path"], F.lit(seed)).alias(file), place["row_index"].alias(row))
    joined = rows.join(numbers.select(F.col("file").alias(file), F.col("number").alias(number)), file)
    return joined.select((F.shiftleft(number, 36) + F.col(row)).alias(uid), *[F.col(f"`{n}`") for n in names])


def only_rows(df: DataFrame, uids: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of ``df`` whose number (see ``identified``) is among ``uids``, all columns kept (an action).

    Up to ``broadcast_bytes`` the numbers are broadcast, so that no text is shuffled; beyond that
    both sides are shuffled by the number, which no two rows share.
    """
    number = fresh(df, "uid")
    kept, size = settle_sized(uids.select(F.col("uid").alias(number)))
    rows = identified(df, uid=number)
    return rows.join(F.broadcast(kept) if size <= broadcast_bytes else kept, number, "left_semi").drop(number)


def give_back() -> None:
    """Returns memory that a finished task no longer needs: idle Python workers stay alive beside later ones."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def in_slices(batches: Batches, rows: int = 512) -> Batches:
    """The batches in short slices, so that only few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def in_batches(rows: Iterable[tuple], schema: pa.Schema, size: Callable[[tuple], int] | None = None,
               max_rows: int = 4096, max_bytes: int = 16 << 20) -> Batches:
    """Row tuples as record batches, bounded in rows and, by ``size`` of a row, in bytes."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += size(row) if size else 0
        if len(held) >= max_rows or weight >= max_bytes:
            yield as_batch(held, schema)
            held, weight = [], 0
    if held:
        yield as_batch(held, schema)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema)
