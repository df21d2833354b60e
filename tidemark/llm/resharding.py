"""Resharding by minimum-cost flow.

Rows fall into a bounded number of blocks by a hash of their text, so equal texts share a block; a
block too heavy for that (one text may fill a third of the table), or large and split by the flow, is dealt
again by identifier and text. From the
bytes that each block has in each old shard, a minimum-cost flow finds the new shard of every block
such that the capacities hold and the fewest bytes move. Only the shards that lose or gain rows are
written again.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import fresh, identified, text_of
from tidemark.operators.joins import measured_keys
from tidemark.operators.positions import with_position
from tidemark.session import settle


# A block that the flow splits is dealt by row if it is over this part of a shard and has more rows than this
LARGE, MANY_ROWS = 0.01, 64


def solve_transfers(resident: np.ndarray, sizes: np.ndarray, capacities: np.ndarray) -> np.ndarray:
    """Bytes of each block for each new shard: the flow that moves the fewest bytes.

    ``resident[b, s]`` are the bytes of block b that already lie in shard s; moving a block to s costs
    its other bytes. Starts from every block where it costs least, then sends the overload along
    shortest paths of re-assignments (successive shortest paths; the nodes are the shards, an arc is
    the cheapest block that can change from one to the other). At most ``shards - 1`` blocks end up
    split.
    """
    n, k = resident.shape
    flow = np.zeros((n, k))
    if n == 0:
        return flow
    cost = 1.0 - resident / np.maximum(sizes, 1)[:, None]
    flow[np.arange(n), cost.argmin(axis=1)] = sizes
    load = flow.sum(axis=0)
    slack = 1e-9 * max(sizes.sum(), 1)
    while True:
        over, under = load > capacities + slack, load < capacities - slack
        if not over.any() or not under.any():
            return flow
        arc, block = np.full((k, k), np.inf), np.zeros((k, k), np.int64)
        for s in range(k):
            held = np.flatnonzero(flow[:, s] > slack)
            if len(held):
                more = cost[held] - cost[held, s][:, None]
                pick = more.argmin(axis=0)
                arc[s], block[s] = more[pick, np.arange(k)], held[pick]
        np.fill_diagonal(arc, np.inf)
        distance, came = np.where(over, 0.0, np.inf), np.full(k, -1)
        for _ in range(k):
            reach = distance[:, None] + arc
            best = reach.argmin(axis=0)
            closer = reach[best, np.arange(k)] < distance - 1e-12
            if not closer.any():
                break
            distance, came = np.where(closer, reach[best, np.arange(k)], distance), np.where(closer, best, came)
        end = int(np.where(under, distance, np.inf).argmin())
        if not np.isfinite(distance[end]):
            return flow
        path, t = [], end
        while came[t] >= 0 and len(path) < k:
            path.append((int(came[t]), t))
            t = int(came[t])
        amount = min([load[t] - capacities[t], capacities[end] - load[end], *(flow[block[s, u], s] for s, u in path)])
        for s, u in path:
            flow[block[s, u], s] -= amount
            flow[block[s, u], u] += amount
        load[t] -= amount
        load[end] += amount


def whole_blocks(flow: np.ndarray, sizes: np.ndarray, capacities: np.ndarray) -> np.ndarray:
    """One shard per block: split blocks go, largest first, to that of their shards with most room."""
    shares = flow > 1e-9 * np.maximum(sizes, 1)[:, None]
    shard = flow.argmax(axis=1)
    split = np.flatnonzero(shares.sum(axis=1) > 1)
    room = capacities - np.bincount(np.delete(shard, split), np.delete(sizes, split), len(capacities))
    for b in sorted(split, key=lambda b: -sizes[b]):
        choice = np.flatnonzero(shares[b])
        shard[b] = choice[room[choice].argmax()]
        room[shard[b]] -= sizes[b]
    return shard


def _hashed(docs: DataFrame, old: Column, text: str, doc_id: str, blocks: int) -> dict[str, Column]:
    body = text_of(text)
    return {"size": (F.octet_length(body) + 1).cast("long"), "old": old.cast("int"),
            "block": F.pmod(F.xxhash64(body), F.lit(blocks)).cast("int"),
            "deal": F.xxhash64(F.col(f"`{doc_id}`").cast("long"), body)}


def _sub(splits: DataFrame, crowds: DataFrame, rows: DataFrame, block: str = "block", deal: str = "deal", row: str = "row",
         sub: str = "sub") -> DataFrame:
    """Adds ``sub``: 0, or for a heavy block the part that a hash of the row's identifier and text picks, whatever file holds
    the row. Only the equal ones of a crowd (over 64 rows and a thousandth of all) are told apart by their place."""
    parts, crowd = fresh(rows, "_parts"), fresh(rows, "_crowd")
    joined = rows.join(F.broadcast(splits.toDF(block, parts)), block, "left").join(
        F.broadcast(crowds.select(F.col("_hash").alias(crowd))), F.xxhash64(deal) == F.col(crowd), "left")
    own = F.when(F.col(crowd).isNotNull(), F.xxhash64(deal, row)).otherwise(F.col(deal))
    return joined.withColumn(sub, F.coalesce(F.pmod(own, F.col(parts)), F.lit(0)).cast("int")).drop(parts, crowd)


def plan_transfers(spark: SparkSession, rows: DataFrame, shares: Sequence[float], crowds: DataFrame) -> tuple[DataFrame, DataFrame, dict]:
    """New shards of all blocks, the heavy blocks' parts, and the bytes moved and loads.

    ``rows`` has row, size, old, block, deal. What comes to the driver is bounded by blocks x old shards.
    """
    k = len(shares)

    def weights(frame: DataFrame) -> list:
        old = F.coalesce("old", F.lit(-1)).alias("old")
        return frame.groupBy("block", "sub", old).agg(F.sum("size").alias("bytes")).collect()

    by_block: dict[int, int] = {}
    rows_of: dict[int, int] = {}
    for block, size, n in rows.groupBy("block").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect():
        by_block[block], rows_of[block] = size, n
    total = sum(by_block.values())
    capacities = np.array(shares, float) / sum(shares) * total
    least = capacities[capacities > 0].min() if total else 1.0  # a shard with no share gives up all its rows
    heavy = {b for b, s in by_block.items() if s > least / 2}
    while True:
        splits = spark.createDataFrame([(b, int(np.ceil(128 * by_block[b] / least))) for b in sorted(heavy)],
                                       "block int, parts int")
        parts: dict[tuple[int, int], int] = {}
        found = sorted(tuple(r) for r in weights(_sub(splits, crowds, rows)))
        for block, sub, _, _ in found:
            parts.setdefault((block, sub), len(parts))
        resident, sizes = np.zeros((len(parts), k)), np.zeros(len(parts))
        for block, sub, old, size in found:
            sizes[parts[block, sub]] += size
            if 0 <= old < k:
                resident[parts[block, sub], old] += size
        flow = solve_transfers(resident, sizes, capacities)
        # a large block of many rows that the flow splits would make a shard uneven as a whole
        split = (flow > 1e-9 * np.maximum(sizes, 1)[:, None]).sum(axis=1) > 1
        uneven = {b for (b, _), n in parts.items() if split[n] and b not in heavy
                  and by_block[b] > LARGE * least and rows_of[b] > MANY_ROWS}
        if not uneven:
            break
        heavy |= uneven
    shard = whole_blocks(flow, sizes, capacities)
    moves = spark.createDataFrame([(*key, int(s)) for key, s in zip(parts, shard)], "block int, sub int, shard int")
    stats = {"moved": float(sizes.sum() - resident[np.arange(len(parts)), shard].sum()) if parts else 0.0,
             "loads": np.bincount(shard, sizes, k).tolist() if parts else [0.0] * k}
    return moves, splits, stats


def reshard(docs: DataFrame, old: Column, shares: Sequence[float], path: str, text: str = "text",
            doc_id: str = "doc_id", blocks: int = 4096) -> DataFrame:
    """Per row: doc_id, size, text_crc32, old_shard, shard, slot (writes shards, runs jobs).

    ``old`` gives a row's present shard (NULL or outside the new range: it must move); ``shares`` are
    the relative capacities of the new shards. Size is the text's UTF-8 bytes plus one, NULL counting
    as empty. Loads differ from the capacities by less than a few blocks; equal texts share a shard
    unless their block exceeds half of one, or has over 64 rows and a hundredth of one and the flow splits it.
    Shards that lose or gain rows are written below ``path``,
    all columns of ``docs`` in one folder per shard, and the result is read from those files; rows of
    untouched shards come from ``docs``. Slots count from 0 in every shard, by doc_id (NULL first).
    Repeated rows are rows of their own, an empty table writes nothing, further columns may have any
    name.
    """
    spark = docs.sparkSession
    row = _hashed(docs, old, text, doc_id, blocks)
    rows = settle(identified(docs, row, "row"))
    crowds = settle(measured_keys(rows, ["deal"], least=MANY_ROWS))
    moves, splits, _ = plan_transfers(spark, rows, shares, crowds)
    placed = _sub(splits, crowds, rows).join(F.broadcast(moves), ["block", "sub"])
    left = placed.where(~F.col("old").eqNullSafe(F.col("shard")))
    touched = {s for pair in left.select("old", "shard").distinct().collect() for s in pair if s is not None}

    # the same rows with all their columns; the helper columns get names of their own
    names = {n: fresh(docs, f"_{n}") for n in ["row", *row]}
    full = identified(docs, {**{c: F.col(f"`{c}`") for c in docs.columns}, **{names[n]: c for n, c in row.items()}}, names["row"])
    part, shard = fresh(docs, "_sub"), fresh(docs, "_shard")
    full = _sub(splits, crowds, full, names["block"], names["deal"], names["row"], part)
    full = full.join(F.broadcast(moves.toDF(names["block"], part, shard)), [names["block"], part])
    affected = F.col(shard).isin(sorted(touched))
    full.where(affected).select(*[F.col(f"`{c}`") for c in docs.columns], names["row"], names["old"], shard).write.partitionBy(
        shard).parquet(path)
    kept_types = full.select(*[F.col(f"`{c}`") for c in docs.columns], names["row"], names["old"], shard).schema
    written = spark.read.schema(kept_types).parquet(path)

    def digests(frame: DataFrame) -> DataFrame:
        body = text_of(text)
        return frame.select(
            F.col(names["row"]).alias("row"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
            (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
            F.col(names["old"]).alias("old_shard"), F.col(shard).alias("shard"))

    result = digests(written).unionByName(digests(full.where(~affected)))
    return with_position(result, ["shard"], ["doc_id", "row"], position="slot").drop("row")
