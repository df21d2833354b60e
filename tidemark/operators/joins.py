"""Joining a large frame with a small derived table without trusting that it is small."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from tidemark.session import settle_sized

BROADCAST_BYTES = 64 * 1024 * 1024
SLICES = 1_000  # a key with more than this share of the rows is dealt out
ROW_BYTES = 32  # a row of two numbers, as ``settle_sized`` counts it


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match each other; key columns come from the left side."""
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    condition = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def measured_keys(df: DataFrame, keys: Sequence[str], slices: int = SLICES, least: int = 0) -> DataFrame:
    """The keys that hold more than a ``slices``-th of the rows and at least ``least`` rows, as ``_hash`` and the number
    of ``_salts`` each needs so that a salt has at most about that share.

    One frequent-items sketch over the hashes of the keys, merged from all tasks; it reads the key columns only
    and finds every key beyond that share. Estimates may be a little low, and two keys with one hash count together:
    neither changes a join, only how evenly it is dealt. The table has fewer than 2 x ``slices`` rows.
    """
    hashed = df.select(F.xxhash64(*keys).alias("_hash"))
    sketch = hashed.agg(
        F.expr(f"approx_top_k(_hash, {slices}, {10 * slices})").alias("_found"), F.count(F.lit(1)).alias("_rows"))
    found = sketch.select(F.explode("_found").alias("_item"), "_rows").filter(F.col("_item.count") >= least).select(
        F.col("_item.item").alias("_hash"), F.ceil(F.col("_item.count") * slices / F.col("_rows")).cast("int").alias("_salts"))
    return found.filter("_salts > 1")


def hot_keys(df: DataFrame, keys: Sequence[str], slices: int = SLICES) -> tuple[DataFrame, int]:
    """``measured_keys`` as a written table, and the number of its rows (an action)."""
    hot, size = settle_sized(measured_keys(df, keys, slices))
    return hot, size // ROW_BYTES


def lookup_join(
    df: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    slices: int = SLICES,
) -> DataFrame:
    """Give every row of ``df`` the row of ``table`` with its keys (one row per key); ``how`` is left or inner.

    The table is written and measured first (an action). Up to ``broadcast_bytes`` it is broadcast
    and ``df`` is not shuffled. Beyond that the keys of ``df`` are measured (``hot_keys``, another action) and both sides
    are shuffled. A key with more than a ``slices``-th of the rows gets as many salts as it has such shares, and its
    row of the table is repeated once per salt; all other keys go unsalted and unrepeated, so the
    repeats are fewer than 2 x ``slices`` rows in all. A row's salt is a hash of the whole row and its partition
    number (the same on a retry), so that copies of one row spread too.
    """
    table, size = settle_sized(table)
    if size <= broadcast_bytes:
        return null_safe_join(df, F.broadcast(table), keys, how)
    hot, found = hot_keys(df, keys, slices)
    if not found:
        return null_safe_join(df, table, keys, how)
    salts = F.coalesce("_salts", F.lit(1))
    spread = F.xxhash64(*df.columns, F.spark_partition_id())
    salted = _with_salts(df, keys, hot).withColumn("_salt", F.pmod(spread, salts).cast("int")).drop("_salts")
    repeated = _with_salts(table, keys, hot).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return null_safe_join(salted, repeated, [*keys, "_salt"], how).drop("_salt")


def _with_salts(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """The number of salts of each row's key, NULL for keys that are not hot."""
    return df.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(hot), "_hash", "left").drop("_hash")
