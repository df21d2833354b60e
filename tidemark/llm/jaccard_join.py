"""N-gram Jaccard join by vertical partitioning.

All word shingles stand in one global order, rare ones first. The order is cut into fragments. The
rare end of each set, its prefix, forms the pairs: of two sets similar enough, the prefixes must share
a shingle. The overlap of a pair is then counted fragment by fragment, and the counts are summed.

Frequencies for the order come from a table of counters of fixed size that every document enters;
the result does not depend on how well they are known. Equal sets of a task are one set from the start.
Sets that share a prefix shingle are not paired with each other but with one of them, which joins most
of a group of copies; later rounds look only at shingles whose sets are still in different components,
and the last tries every pair left there that the places of the shingle in both sets allow. So a group of similar documents costs links in proportion
to its size, and no link between different components is missed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import Batches, give_back, identified, only_rows, text_of
from tidemark.llm.components import components
from tidemark.operators.joins import lookup_join
from tidemark.session import scratch_path, settle, settle_sized

BITS = 48  # of a shingle's hash
ORDER_BITS = 21  # counters of the global order: 2**21, 8 MB
SLICES = 64  # the counters travel in so many parts
SUM_GROUPS = 256  # and are summed in so many groups first
FRAGMENTS = 4
PARITY = 1024  # bits of a set's parity map
BROADCAST_BYTES = 32 << 20
STAR_ROUNDS = 2
CACHED = 150_000  # word hashes a task remembers
WINDOW = 1_000_000  # prefix rows a task holds

_MIX = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word) - (1 << 63)
        return value


_words = _WordHashes()


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct 48-bit hashes of the word n-grams; a shorter text is one, an empty one none.

    A-Z count as a-z; words are what ASCII white space separates.
    """
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words)) >> 64 - BITS], np.uint64)
    if len(_words) > CACHED:
        _words.clear()
    h = np.fromiter(map(_words.__getitem__, words), np.int64, len(words)).view(np.uint64)
    last = len(h) - width + 1
    x = h[:last] * np.uint64(_MIX[0])
    for k in range(1, width):
        x = (x ^ (x >> np.uint64(29)) ^ h[k:last + k]) * np.uint64(_MIX[k % len(_MIX)])
    x ^= x >> np.uint64(32)
    x *= np.uint64(_MIX[1])
    x = np.sort((x ^ (x >> np.uint64(31))) >> np.uint64(64 - BITS))
    return x[np.concatenate(([True], x[1:] != x[:-1]))]


def packed(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :BITS // 8].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) * 8 // BITS, 8), np.uint8)
    wide[:, :BITS // 8] = np.frombuffer(data, np.uint8).reshape(-1, BITS // 8)
    return wide.reshape(-1).view("<u8")


def parity(tokens: np.ndarray) -> bytes:
    """A bit per hash class, set if an odd number of tokens falls in it. Two maps differ in no more bits
    than the sets in tokens."""
    odd = np.bincount((tokens & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


_ENTRY = pa.schema([("kind", pa.string()), ("uid", pa.int64()), ("doc_id", pa.int64()), ("rep", pa.int64()),
                    ("n", pa.int64()), ("bits", pa.binary()), ("data", pa.binary())])
_ENTRY_DDL = "kind string, uid long, doc_id long, rep long, n long, bits binary, data binary"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _enter(width: int):
    """Per row its set's representative in this task; per representative the set; at the end the counters."""

    def run(batches: Batches) -> Batches:
        seen: dict[bytes, int] = {}
        counts = np.zeros(1 << ORDER_BITS, np.uint32)
        held: list[np.ndarray] = []
        waiting = 0

        def count() -> None:
            nonlocal waiting
            if held:
                classes = (np.concatenate(held) >> np.uint64(BITS - ORDER_BITS)).view(np.int64)
                np.add(counts, np.bincount(classes, minlength=len(counts)), out=counts, casting="unsafe")
                held.clear()
                waiting = 0

        for batch in (b.slice(k, 512) for b in batches for k in range(0, b.num_rows, 512)):
            rows, size = [], 0
            for uid, doc_id, body in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = shingles(body, width)
                rep = uid
                if len(tokens):
                    data = packed(tokens)
                    rep = seen.setdefault(xxhash.xxh3_128_digest(data), uid)
                    if rep == uid:
                        rows.append(("set", uid, None, uid, len(tokens), parity(tokens), data))
                        size += len(data)
                        held.append(tokens)
                        waiting += len(tokens)
                rows.append(("document", uid, doc_id, rep, len(tokens), None, None))
                if size > 4 << 20:
                    yield _batch(rows, _ENTRY)
                    rows, size = [], 0
                if waiting > 1_000_000:
                    count()
            if rows:
                yield _batch(rows, _ENTRY)
        count()
        if counts.any():
            parts = counts.reshape(SLICES, -1)
            yield _batch([("order", k, None, None, None, None, zlib.compress(parts[k].astype("<u8").tobytes(), 1))
                          for k in range(SLICES)], _ENTRY)
        del counts, seen
        _words.clear()
        give_back()

    return run


def _sum_counts(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros((1 << ORDER_BITS) // SLICES, np.uint64)
    for data in frame["data"]:
        total += np.frombuffer(zlib.decompress(data), "<u8")
    return pd.DataFrame({"uid": [frame["uid"].iloc[0]], "data": [zlib.compress(total.astype("<u8").tobytes(), 1)]})


def global_order(entries: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each hash class, rare first, and the ranks at which the order is cut into fragments of equal
    weight. Tasks' counters are summed in two levels, so no group holds those of all tasks; the driver gets
    the sums, 16 MB at any size of the input."""
    sent = entries.where("kind = 'order'").select("uid", "data", F.pmod(F.spark_partition_id(), F.lit(SUM_GROUPS)).alias("group"))
    some = sent.groupBy("uid", "group").applyInPandas(_sum_counts, "uid long, data binary")
    parts = some.groupBy("uid").applyInPandas(_sum_counts, "uid long, data binary").collect()
    counts = np.zeros((SLICES, (1 << ORDER_BITS) // SLICES), np.uint64)
    for uid, data in parts:
        counts[uid] = np.frombuffer(zlib.decompress(data), "<u8")
    counts = counts.reshape(-1)
    order = np.argsort(counts, kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    weight = np.cumsum(counts[order], out=counts)
    cuts = np.searchsorted(weight, weight[-1] * np.arange(1, FRAGMENTS) // FRAGMENTS)
    return rank, cuts.astype(np.uint64)


def ordered(data: bytes, rank: np.ndarray) -> np.ndarray:
    """A set's tokens as sorted places in the global order."""
    tokens = unpacked(data)
    rest = np.uint64(BITS - ORDER_BITS)
    places = rank[tokens >> rest].astype(np.uint64) << rest | tokens & np.uint64((1 << BITS - ORDER_BITS) - 1)
    places.sort()
    return places


_PREFIX = pa.schema([("key", pa.int64()), ("uid", pa.int64()), ("n", pa.int64()), ("place", pa.int64()),
                     ("copies", pa.int64()), ("member", pa.bool_())])
_PREFIX_DDL = "key long, uid long, n long, place long, copies long, member boolean"


def _prefixes(order, num: int, den: int):
    """Prefix shingles. Sets of one task that share one send it once, as its first set, with their number;
    the others are marked as members and are known to share it."""

    def close(keys: list, uids: list, sizes: list) -> Iterator[pa.RecordBatch]:
        counts = [len(k) for k in keys]
        key = np.concatenate(keys)
        uid, n = (np.repeat(np.array(x, np.int64), counts) for x in (uids, sizes))
        place = np.concatenate([np.arange(k) for k in counts])
        by = np.lexsort((uid, key))
        key, uid, n, place = key[by], uid[by], n[by], place[by]
        first = np.concatenate(([True], key[1:] != key[:-1]))
        copies = np.diff(np.append(np.flatnonzero(first), len(key)))
        copies = np.repeat(copies, copies)
        for at in range(0, len(key), 65536):
            to = slice(at, at + 65536)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[to]) for c in (key.astype(np.int64), uid, n, place, copies.astype(np.int64), ~first)], schema=_PREFIX)

    def run(batches: Batches) -> Batches:
        rank = order.value[0]
        keys, uids, sizes, waiting = [], [], [], 0
        for batch in batches:
            for uid, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                prefix = ordered(data, rank)[:n + (-num * n // den) + 1]
                keys.append(prefix)
                uids.append(uid)
                sizes.append(n)
                waiting += len(prefix)
                if waiting >= WINDOW:
                    yield from close(keys, uids, sizes)
                    keys, uids, sizes, waiting = [], [], [], 0
        if keys:
            yield from close(keys, uids, sizes)
        del keys
        give_back()

    return run


def _shared(batches: Batches) -> Batches:
    """Of rows sorted by key, those whose key has another row or stands for several sets."""
    last: pa.RecordBatch | None = None  # the latest row waits for the next one
    shared = False
    for batch in batches:
        if not batch.num_rows:
            continue
        if last is not None:
            batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
        key = batch.column("key").to_numpy()
        keep = batch.column("copies").to_numpy() > 1
        same = key[1:] == key[:-1]
        keep[1:] |= same
        keep[:-1] |= same
        keep[0] |= shared
        end = batch.num_rows - 1
        yield batch.slice(0, end).filter(pa.array(keep[:end]))
        last, shared = batch.slice(end), bool(keep[end])
    if last is not None and shared:
        yield last


def sized(df: DataFrame) -> DataFrame:
    """The table, settled and measured: marked for broadcast up to ``BROADCAST_BYTES``, else to be shuffled."""
    table, size = settle_sized(df)
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


_SLICE = pa.schema([("uid", pa.int64()), ("fragment", pa.int32()), ("data", pa.binary())])


def _cut(order):
    """The sets in vertical fragments."""

    def run(batches: Batches) -> Batches:
        rank, cuts = order.value
        edges = cuts << np.uint64(BITS - ORDER_BITS)
        for batch in batches:
            rows = []
            for uid, data in zip(*(c.to_pylist() for c in batch.columns)):
                for k, part in enumerate(np.split(places := ordered(data, rank), np.searchsorted(places, edges))):
                    if len(part):
                        rows.append((uid, k, packed(part)))
                if len(rows) > 4096:
                    yield _batch(rows, _SLICE)
                    rows = []
            if rows:
                yield _batch(rows, _SLICE)
        give_back()

    return run


_COUNT = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("na", pa.int64()), ("nb", pa.int64()), ("common", pa.int64())])


def _partial(batches: Batches) -> Batches:
    """The overlap of a pair inside one fragment."""
    for batch in batches:
        left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
        common = [len(np.intersect1d(unpacked(x), unpacked(y), assume_unique=True)) for x, y in zip(left, right)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "na", "nb")),
                                          pa.array(common, pa.int64())], schema=_COUNT)


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("na", pa.int64()), ("nb", pa.int64())])


def _possible(num: int, den: int):
    """Pairs whose parity maps do not already show too many differences."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1)
                    for c in ("left", "right"))
            differ = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            # with overlap I and T = |a| + |b|: I >= num / (num + den) * T, and the sets differ in T - 2 I
            fine = differ * (den + num) <= (den - num) * total
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in _PAIR.names], schema=_PAIR).filter(pa.array(fine))

    return run


class _Join:
    """The sets, their order and the threshold of one join."""

    def __init__(self, docs: DataFrame, text: str, doc_id: str, width: int, num: int, den: int):
        spark = docs.sparkSession
        self.num, self.den = num, den
        rows = identified(docs, {"doc_id": F.col(f"`{doc_id}`").cast("long"), "body": text_of(text)})
        path = scratch_path(spark, "shingles")
        rows.mapInArrow(_enter(width), _ENTRY_DDL).write.partitionBy("kind").parquet(path)
        entries = spark.read.schema(_ENTRY_DDL).parquet(path)
        self.documents = entries.where("kind = 'document'").select("uid", "doc_id", "rep", "n")
        self.sets = entries.where("kind = 'set'")
        self.order = spark.sparkContext.broadcast(global_order(entries))

    def groups(self) -> DataFrame:
        """The sets that share a prefix shingle with another one: key, uid, n, the place of the shingle in the
        set's order, and whether the set may be the smaller one of a pair that has it as its first."""
        found = self.sets.select("uid", "n", "data").mapInArrow(_prefixes(self.order, self.num, self.den), _PREFIX_DDL)
        path = scratch_path(found.sparkSession, "prefixes")
        # members are known to share their shingle; only the others have to meet across tasks
        meet = found.where("NOT member").repartition("key").sortWithinPartitions("key").mapInArrow(_shared, _PREFIX_DDL)
        columns = ["key", "uid", "n", "place"]
        meet.select(*columns).write.parquet(f"{path}/first")
        found.where("member").select(*columns).write.parquet(f"{path}/member")
        rows = found.sparkSession.read.schema("key long, uid long, n long, place long").parquet(f"{path}/first", f"{path}/member")
        return rows.withColumn("low", self.early(F.col("n"), F.col("place"), 2 * F.col("n")))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The linked ones of the pairs a, b, na, nb."""
        heads = self.sets.select("uid", "bits")
        maps = pairs.join(heads.select(F.col("uid").alias("a"), F.col("bits").alias("left")), "a").join(
            heads.select(F.col("uid").alias("b"), F.col("bits").alias("right")), "b")
        likely = sized(maps.select("a", "b", "na", "nb", "left", "right").mapInArrow(
            _possible(self.num, self.den), "a long, b long, na long, nb long"))
        wanted = sized(likely.select(F.explode(F.array("a", "b")).alias("uid")).distinct())
        slices = settle(self.sets.select("uid", "data").join(wanted, "uid", "left_semi").mapInArrow(
            _cut(self.order), "uid long, fragment int, data binary"))
        left = slices.select(F.col("uid").alias("a"), "fragment", F.col("data").alias("left"))
        right = slices.select(F.col("uid").alias("b"), "fragment", F.col("data").alias("right"))
        counts = likely.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "na", "nb", "left", "right")
        sums = counts.mapInArrow(_partial, "a long, b long, na long, nb long, common long").groupBy(
            "a", "b", "na", "nb").agg(F.sum("common").alias("common"))
        return settle(sums.where(self.den * F.col("common") >= self.num * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b"))

    def early(self, n: Column, place: Column, total: Column) -> Column:
        """Whether a shingle stands early enough in a set of ``n`` to be the first that a linked pair of
        ``total`` shingles shares: what comes from it on must hold their overlap, num/(num+den) of the total."""
        return (self.num + self.den) * (n - place) >= self.num * total

    def feasible(self) -> Column:
        """Whether a pair's sizes and the places of their shared shingle allow the threshold.

        A linked pair passes at the first shingle that both have. There the smaller set is ``low``.
        """
        small, large = F.least("na", "nb"), F.greatest("na", "nb")
        total = F.col("na") + F.col("nb")
        return (self.den * small >= self.num * large) & self.early(F.col("na"), F.col("pa"), total) & self.early(
            F.col("nb"), F.col("pb"), total)

    def star(self, groups: DataFrame, turn: int) -> DataFrame:
        """Each set with one set of its key in another component; each turn takes other ones.

        First the one with fewest rarer shingles before the shared one: of a group of near copies that is
        the closest to what they have in common.
        """
        mark = (F.col("place") if turn == 0 else F.xxhash64("uid", F.lit(turn))).alias("mark")
        first = F.struct((~F.col("low")).alias("late"), mark, "uid", "n", "place", "root")
        hub = groups.groupBy("key").agg(F.min(first).alias("hub"))
        pairs = groups.join(hub, "key").where(F.col("root") != F.col("hub.root"))
        return pairs.select(
            F.col("uid").alias("a"), F.col("hub.uid").alias("b"), F.col("n").alias("na"), F.col("hub.n").alias("nb"),
            F.col("place").alias("pa"), F.col("hub.place").alias("pb")).where(self.feasible())

    def rest(self, groups: DataFrame) -> DataFrame:
        """Every pair of sets that share a key, may be linked and are in different components."""
        left, right = (groups.select("key", F.col("uid").alias(x), F.col("n").alias(f"n{x}"), F.col("place").alias(f"p{x}"),
                                     F.col("root").alias(f"r{x}"), F.col("low").alias(f"low_{x}")) for x in "ab")
        # the smaller set (of equal ones the one with the smaller number) stands on the left
        smaller = "na < nb OR (na = nb AND a < b)"
        return left.where("low_a").join(right, "key").where(smaller).where("ra != rb").where(self.feasible())

    def roots(self) -> DataFrame:
        """node, root of every linked representative."""
        groups = self.groups().withColumn("root", F.col("uid"))
        spark = groups.sparkSession
        # a shingle that stands late in all its sets is the first one of no linked pair
        useful = sized(groups.groupBy("key").agg(F.bool_or("low").alias("useful")).where("useful").select("key"))
        groups = settle(groups.join(useful, "key", "left_semi"))
        known = spark.createDataFrame([], "node long, root long")
        tried = spark.createDataFrame([], "a long, b long")
        for turn in range(STAR_ROUNDS + 1):
            pairs = self.star(groups, turn) if turn < STAR_ROUNDS else self.rest(groups)
            ordered_pairs = pairs.select(
                F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"),
                F.when(F.col("a") > F.col("b"), F.col("na")).otherwise(F.col("nb")).alias("na"),
                F.when(F.col("a") > F.col("b"), F.col("nb")).otherwise(F.col("na")).alias("nb")).distinct()
            fresh = sized(ordered_pairs.join(tried, ["a", "b"], "left_anti") if turn else ordered_pairs)
            if fresh.isEmpty():
                continue
            links = self.verified(fresh)
            tried = tried.union(fresh.select("a", "b"))
            if links.isEmpty():
                continue
            known = components(links.union(known.select("node", "root")))
            # shingles whose sets are still apart
            marked = groups.drop("root").join(sized(known.select(F.col("node").alias("uid"), "root")), "uid", "left").select(
                "key", "uid", "n", "place", "low", F.coalesce("root", "uid").alias("root"))
            apart = sized(marked.groupBy("key").agg(
                F.min("root").alias("first"), F.max("root").alias("last"), F.count(F.lit(1)).alias("sets")).where(
                "first < last AND sets > 2").select("key"))
            groups = settle(marked.join(apart, "key", "left_semi"))
            if groups.isEmpty():
                break
        return known


def jaccard_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 5, num: int = 80,
                       den: int = 100) -> DataFrame:
    """Per row of ``docs``: uid, doc_id, n_shingles, component (a row's uid), component_id (runs jobs).

    Two rows link when the Jaccard similarity of their sets of ``width``-word shingles is at least
    ``num / den``; ``component_id`` is the smallest identifier that links reach (NULLs aside). A text
    with fewer words is one shingle, its whole sequence; NULL or empty texts link with nothing, not
    even each other. Repeated rows link like any equal texts; an empty table gives an empty result;
    only the two named columns are read. Shingles are compared by 48 bits of a hash: a wrong overlap
    takes a collision inside one pair, about one pair in 10**9 at 500 shingles.
    """
    if not 0 < num <= den:
        raise ValueError(f"{num}/{den} is not a similarity above 0 and up to 1")
    join = _Join(docs, text, doc_id, width, num, den)
    roots = join.roots().select(F.col("node").alias("rep"), "root")
    placed = settle(join.documents.join(roots, "rep", "left").select(
        "uid", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "rep").alias("component")))
    smallest = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    # sized, and salted if large: one component may hold a third of all rows
    return lookup_join(placed, smallest, ["component"]).select("uid", "doc_id", "n_shingles", "component", "component_id")


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **threshold: int) -> DataFrame:
    """``docs`` with one row of each component (see ``jaccard_components``), all columns kept.

    The row with the smallest identifier stays, rows without one last, of equal ones the first.
    """
    found = jaccard_components(docs, text, doc_id, **threshold)
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "uid")
    return only_rows(docs, found.groupBy("component").agg(F.min(order).alias("best")).select("best.uid"))
