"""Packing: power-of-two decomposition.

Each document's tokens are split into as many full sequences as fit and then by the binary digits of
the rest. Every piece is a sequence of its own whose length is a power of two, pieces of equal length
share a bucket, so no sequence crosses documents and none is padded. Packing is a narrow step: no
shuffle, whatever the size of a source.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Batches, give_back, in_slices, numbered, text_of

# what only the tokenizers library is asked to encode: characters beyond the basic plane, where the two
# libraries may know different Unicode versions, and very long runs without a blank
_RARE = re.compile(r"[^\x00-\uffff]")
LONG_RUN = 4096

_loaded: dict[str, "ByteCoder"] = {}


def _bytes_of(token: str) -> bytes:
    """The bytes that a byte-level token stands for: printable Latin-1 as itself, the others from U+0100 on."""
    return bytes(_BYTE[c] for c in token)


_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = {chr(b): b for b in _SHOWN} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class ByteCoder:
    """Ids of a byte-level BPE vocabulary file as the tokenizers library gives them.

    A vocabulary whose ids follow its merges, with the usual split pattern, is also loaded as ranks into
    tiktoken, which gives the same ids several times faster; special tokens, rare characters and very
    long runs go to the tokenizers library.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.fast = self._ranked(spec)

    @staticmethod
    def _ranked(spec: dict):
        import tiktoken

        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        added = {t["content"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in model["vocab"].items() if t not in added}
        by_rank = all(vocab.get(a + b) == 256 + k for k, (a, b) in enumerate(merges)) and len(vocab) == 256 + len(merges)
        usual = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
        if not (by_rank and usual and model["type"] == "BPE" and spec["normalizer"] is None):
            return None
        ranks = {_bytes_of(t): i for t, i in vocab.items()}
        return tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def _plain(self, text: str) -> bool:
        if _RARE.search(text) or any(s in text for s in self.special):
            return False
        return len(text) <= LONG_RUN or max(map(len, text.split(" "))) <= LONG_RUN and "  " * LONG_RUN not in text

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit numbers."""
        if self.fast and self._plain(text):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


#: Fixed: the split pattern of the byte-level pre-tokenizer
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_coder(path: str) -> ByteCoder:
    if path not in _loaded:
        _loaded[path] = ByteCoder(path)
    return _loaded[path]


def lengths(n: int, capacity: int) -> list[int]:
    """Full sequences, then the powers of two that make up the rest, largest first."""
    rest = n % capacity
    return [capacity] * (n // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


_SCHEMA = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids", pa.binary()), ("doc_tokens", pa.int64())])
_DDL = "uid long, doc_id long, start long, length long, ids binary, doc_tokens long"


def _split(path: str, capacity: int, end_id: int, window: int = 4 << 20):
    end = np.array([end_id], "<u4").tobytes()

    def cut(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[] for _ in _SCHEMA]
        coder = byte_coder(path)
        for uid, doc_id, body in rows:
            ids = coder.encode(body) + end
            total, start = len(ids) // 4, 0
            for length in lengths(total, capacity):
                piece = (uid, doc_id, start, length, ids[4 * start:4 * (start + length)], total)
                for column, value in zip(columns, piece):
                    column.append(value)
                start += length
        for at in range(0, len(columns[0]), 8192):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[at:at + 8192], f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)

    def run(batches: Batches) -> Batches:
        held, weight = [], 0
        for batch in in_slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                weight += len(row[2])
                if weight >= window:
                    yield from cut(held)
                    held, weight = [], 0
        if held:
            yield from cut(held)
        give_back()

    return run


def pack_powers(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, text: str = "text",
                doc_id: str = "doc_id") -> DataFrame:
    """Per piece: uid, doc_id, start, length, ids, doc_tokens, bucket, sequence_id, offset.

    ``ids`` holds the piece's token ids as little-endian 32-bit numbers; a document's pieces cover its
    tokens and ``end_id`` once, in order. ``bucket`` is the binary logarithm of the length;
    ``sequence_id`` is unique, and sorts by bucket. A NULL or empty text is the one piece
    ``[end_id]``; repeated rows are packed one by one; an empty table gives no pieces. Only the two
    named columns are read. ``capacity`` must be a power of two.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"capacity={capacity} is not a power of two")
    rows = numbered(docs, {"doc_id": F.col(f"`{doc_id}`").cast("long"), "body": text_of(text)})
    pieces = rows.mapInArrow(_split(tokenizer, capacity, end_id), _DDL)
    bucket = F.round(F.log2("length")).cast("int")
    # partition and place of the piece (33 bits each half), under the bucket; 2**26 partitions have room
    place = F.monotonically_increasing_id()
    return pieces.withColumns({
        "bucket": bucket, "sequence_id": F.shiftleft(bucket.cast("long"), 59) + place, "offset": F.lit(0).cast("long")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Writes the sequences in one folder per length, from which batches of equal length are read."""
    pieces.write.partitionBy("bucket").parquet(path)
