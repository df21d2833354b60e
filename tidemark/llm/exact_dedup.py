"""Exact deduplication: Patricia-trie owners.

Every task first inserts the full byte strings of its rows into a compressed radix trie and forwards
each distinct string once. The strings then meet in partitions of (length, content hash), where a
second trie decides the owner of each. A group of copies that holds a third of all rows therefore
reaches the deciding task as one row per window of the first step.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Batches, give_back, identified, in_batches, in_slices, only_rows, text_of
from tidemark.session import settle

_OVERHEAD = 400  # bytes that a terminal costs besides its string
_HEAD = 16  # bytes of hash and length before the string in a key


class _Node:
    __slots__ = ("edge", "children", "value")

    def __init__(self, edge: bytes, value: list | None = None):
        self.edge = edge
        self.children: dict[int, _Node] = {}
        self.value = value


def _shared(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of ``a`` and ``b[start:]``, by halving."""
    low, high = 0, min(len(a), len(b) - start)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[start + low:start + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class PatriciaTrie:
    """A compressed radix trie from byte strings to ``[best, count, members]``.

    ``best`` is the smallest rank seen for the string; ``members`` collects identifiers. Over
    ``budget`` bytes the heaviest subtree below the root goes to an unnamed temporary file with all
    later strings of that subtree; ``items`` then builds such subtrees one at a time, a level deeper.
    """

    def __init__(self, budget: int, depth: int = 0):
        self.root = _Node(b"")
        self.budget = budget
        self.depth = depth
        self.weights: dict[int, int] = {}
        self.total = 0
        self.strings = 0
        self.spilled: dict[int, tempfile._TemporaryFileWrapper] = {}

    def add(self, key: bytes, best: tuple, count: int, members: list[int]) -> None:
        branch = key[self.depth] if len(key) > self.depth else -1
        if branch in self.spilled:
            pickle.dump((key, best, count, members), self.spilled[branch])
            return
        grown = 8 * len(members)
        node, at = self.root, 0
        while True:
            if at == len(key):
                break
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = _Node(key[at:])
                grown += len(key) - at + _OVERHEAD
                node, at = child, len(key)
                break
            if key.startswith(child.edge, at):
                node, at = child, at + len(child.edge)
                continue
            same = _shared(child.edge, key, at)
            fork = _Node(child.edge[:same])
            child.edge = child.edge[same:]
            fork.children[child.edge[0]] = child
            node.children[key[at]] = fork
            grown += _OVERHEAD
            node, at = fork, at + same
        if node.value is None:
            node.value = [best, count, list(members)]
            self.strings += 1
        else:
            node.value[0] = min(node.value[0], best)
            node.value[1] += count
            node.value[2].extend(members)
        self.weights[branch] = self.weights.get(branch, 0) + grown
        self.total += grown
        # a single string has to fit, and keys that agree in hash and length are not told apart by more spilling
        if self.total > self.budget and self.strings > 1 and self.depth < _HEAD:
            self._spill()

    def _spill(self) -> None:
        branch = max((b for b in self.weights if b >= 0), key=self.weights.get, default=None)
        if branch is None:
            return
        file = tempfile.TemporaryFile()
        for key, value in list(self._walk(lambda key: len(key) > self.depth and key[self.depth] == branch)):
            pickle.dump((key, *value), file)
            self.strings -= 1
        self._cut(self.root, b"", branch)
        self.total -= self.weights.pop(branch)
        self.spilled[branch] = file

    def _cut(self, node: _Node, prefix: bytes, branch: int) -> None:
        for first, child in list(node.children.items()):
            whole = prefix + child.edge
            if len(whole) > self.depth:
                if whole[self.depth] == branch:
                    del node.children[first]
            else:
                self._cut(child, whole, branch)

    def _walk(self, wanted=None) -> Iterator[tuple[bytes, list]]:
        stack = [(self.root, b"")]
        while stack:
            node, prefix = stack.pop()
            key = prefix + node.edge
            if node.value is not None and (wanted is None or wanted(key)):
                yield key, node.value
            stack.extend((child, key) for child in node.children.values())

    def items(self) -> Iterator[tuple[bytes, list]]:
        yield from self._walk()
        self.root = _Node(b"")
        for file in self.spilled.values():
            deeper = PatriciaTrie(self.budget, self.depth + 1)
            file.seek(0)
            while True:
                try:
                    deeper.add(*pickle.load(file))
                except EOFError:
                    break
            file.close()
            yield from deeper.items()


def _key(length: int, digest: int, data: bytes) -> bytes:
    """Hash, length, string: the trie branches evenly near its root and compares whole strings below."""
    return digest.to_bytes(8, "big", signed=True) + length.to_bytes(8, "big") + data


_MARKED = pa.schema([
    ("uid", pa.int64()), ("doc_id", pa.int64()), ("text_sha256", pa.string()), ("rep", pa.int64()),
    ("length", pa.int64()), ("hash", pa.int64()), ("data", pa.binary()),
    ("best_id", pa.int64()), ("best_uid", pa.int64()), ("n", pa.int64()),
])
_MARKED_DDL = (
    "uid long, doc_id long, text_sha256 string, rep long, length long, hash long, data binary, "
    "best_id long, best_uid long, n long"
)


def _rank(doc_id: int | None, uid: int, keep: str) -> tuple:
    """Sorts first what stays: rows with an identifier, the largest (smallest) one, the first row."""
    return (doc_id is None, 0 if doc_id is None else -doc_id if keep == "largest" else doc_id, uid)


def _mark(window_bytes: int, keep: str):
    def close(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(1 << 62)
        for number, (uid, doc_id, data) in enumerate(rows):
            digest = xxhash.xxh3_64_intdigest(data) - (1 << 63)
            trie.add(_key(len(data), digest, data), _rank(doc_id, uid, keep), 1, [number])
        out: list[tuple] = [()] * len(rows)
        for key, (best, count, members) in trie.items():
            data = key[16:]
            sha = hashlib.sha256(data).hexdigest()
            first = members[0]
            rep = rows[first][0]
            best_id = None if best[0] else -best[1] if keep == "largest" else best[1]
            for number in members:
                uid, doc_id, _ = rows[number]
                out[number] = (uid, doc_id, sha, rep, None, None, None, None, None, None)
            uid, doc_id, _ = rows[first]
            out[first] = (uid, doc_id, sha, rep, len(data), int.from_bytes(key[:8], "big", signed=True), data,
                          best_id, best[2], count)
        yield from in_batches(out, _MARKED, lambda row: len(row[6] or b""), max_bytes=4 << 20)

    def run(batches: Batches) -> Batches:
        held, weight = [], 0
        for batch in in_slices(batches):
            for uid, doc_id, data in zip(*(batch.column(k).to_pylist() for k in range(3))):
                held.append((uid, doc_id, data))
                weight += len(data)
                if weight >= window_bytes:
                    yield from close(held)
                    held, weight = [], 0
        if held:
            yield from close(held)
        del held
        give_back()

    return run


_OWNERS = pa.schema([("rep", pa.int64()), ("keep_id", pa.int64()), ("keep_uid", pa.int64()), ("group_size", pa.int64())])


def _owners(budget: int, keep: str):
    def run(batches: Batches) -> Batches:
        trie = PatriciaTrie(budget)
        for batch in in_slices(batches):
            for rep, length, digest, data, best_id, best_uid, n in zip(*(c.to_pylist() for c in batch.columns)):
                trie.add(_key(length, digest, data), _rank(best_id, best_uid, keep), n, [rep])

        def rows():
            for _, (best, count, members) in trie.items():
                keep_id = None if best[0] else -best[1] if keep == "largest" else best[1]
                for rep in members:
                    yield rep, keep_id, best[2], count

        yield from in_batches(rows(), _OWNERS)
        del trie
        give_back()

    return run


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "smallest",
                     window_bytes: int = 24 << 20, trie_bytes: int = 256 << 20) -> DataFrame:
    """One row per row of ``docs``: uid, doc_id, keep_id, group_size, kept, text_sha256 (writes a table).

    Texts are equal when their UTF-8 bytes are. Of equal texts the row with the smallest identifier
    stays (``keep="largest"``: the largest). A NULL text counts as empty. A row without identifier
    stays only if its whole group has none (keep_id is then NULL); of repeated identifiers the first
    row stays, so exactly one row of a group is kept. Only the two named columns are read, so further
    columns may have any name. An empty table gives an empty result. ``window_bytes`` bounds a
    first-step trie, ``trie_bytes`` a second-step one before its subtrees spill.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep={keep!r}")
    rows = identified(docs, {"doc_id": F.col(f"`{doc_id}`").cast("long"), "data": text_of(text).cast("binary")})
    marked = settle(rows.mapInArrow(_mark(window_bytes, keep), _MARKED_DDL))
    strings = marked.where(F.col("data").isNotNull()).select(
        "rep", "length", "hash", "data", "best_id", "best_uid", "n")
    owners = strings.repartition("length", "hash").mapInArrow(
        _owners(trie_bytes, keep), "rep long, keep_id long, keep_uid long, group_size long")
    return marked.select("uid", "doc_id", "text_sha256", "rep").join(owners, "rep").select(
        "uid", "doc_id", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "smallest",
                          **limits: int) -> DataFrame:
    """``docs`` without its copies, all columns kept; which row stays: see ``exact_duplicates``.

    The verdicts are joined by row number, so repeated and missing identifiers are safe (see ``identified``).
    """
    return only_rows(docs, exact_duplicates(docs, text, doc_id, keep, **limits).where("kept"))
