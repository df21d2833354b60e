"""BPE encoding and decoding: tree concatenation.

Ordinary text is cut at blanks, where the vocabulary's pre-tokenizer always cuts, and each distinct
word is encoded once per task. Text that the pre-tokenizer leaves unsplit is halved: the halves are
encoded on their own, for long documents as rows of their own that any task may take, and at each
join a window of tokens from both sides is encoded again and doubled until its first and last token
agree with the sides. A BPE sequence is the right one exactly when each two neighbours are, so such
a join is exact.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Batches, numbered, text_of

LEAF = 256  # byte-level characters that are encoded without halving
CACHED = 300_000  # words a task remembers

# The normalizer and the split pattern that ``_PLAIN`` words are taken through without the library
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# words of characters that NFC keeps, that have one small letter each and whose classes are known here: ASCII but "<", with
# which special tokens begin, Latin-1 letters, Greek but the sigmas, Cyrillic
_LETTERS = "a-zÀ-ÖØ-öø-ÿΆΈ-ΊΌΎΏΑ-ΡΤ-ρτ-ώЀ-џ"
_PLAIN = re.compile(f"[!-;=-~×÷A-Z{_LETTERS}]+")
_PLAIN_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")
# what byte-level vocabularies write for a byte: itself if it is printable, else the next character from U+0100
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LEVEL = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}

_loaded: dict[str, "Coder"] = {}


def coder(path: str) -> "Coder":
    """The coder of a vocabulary file, loaded once in each Python worker."""
    if path not in _loaded:
        _loaded[path] = Coder(path)
    return _loaded[path]


class Coder:
    """A BPE vocabulary whose pre-tokenizer drops white space and whose decoder joins tokens by blanks."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        splits = [s["pattern"].get("Regex") for s in steps if s["type"] == "Split"]
        self.knows_plain = ((spec["normalizer"] or {}).get("normalizers") == _NORMALIZER and splits == [_PATTERN]
                            and [s["type"] for s in steps] == ["Split", "ByteLevel"] and not steps[1]["add_prefix_space"])
        drops_blanks = any(s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"] for s in steps)
        if model["type"] != "BPE" or spec["decoder"] is not None or spec["post_processor"] or not drops_blanks:
            raise ValueError(f"{path}: tree concatenation needs a BPE vocabulary that drops white space")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.inner = BPE(vocab=model["vocab"], merges=merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.token = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.blanked = {i: f"{t} " for i, t in self.token.items()}
        self.knows_plain &= all(t.startswith("<") for t in self.special)
        self.model = self.tokenizer.model
        # what this worker remembers of words and of their pieces
        self.ids: dict[str, bytes] = {"": b""}
        self.spelled: dict[str, str] = {"": ""}
        self.pieces: dict[str, tuple[bytes, str]] = {}

    def decode(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    # unsplit text ------------------------------------------------------------------------------

    def plain(self, run: str, final: bool) -> list[int]:
        model = self.tokenizer.model if final else self.inner
        return [t.id for t in model.tokenize(run)] if run else []

    def text(self, ids: list[int]) -> str:
        return "".join(self.token[i].removesuffix(self.suffix) for i in ids)

    def joined(self, left: list[int], right: list[int], final: bool) -> list[int]:
        """The encoding of two neighbouring stretches, each encoded on its own."""
        if not left or not right:
            return left + right
        reach = 4
        while True:
            i, j = min(reach, len(left)), min(reach, len(right))
            window = self.plain(self.text(left[-i:] + right[:j]), final and j == len(right))
            left_agrees = i == len(left) or window[0] == left[-i]
            right_agrees = j == len(right) or window[-1] == right[j - 1]
            if left_agrees and right_agrees:
                return left[:-i] + window + right[j:]
            reach *= 2

    def unsplit(self, run: str, final: bool = True) -> list[int]:
        """A stretch of byte-level characters without a cut; ``final`` if a word ends with it."""
        if len(run) <= LEAF:
            return self.plain(run, final)
        middle = len(run) // 2
        return self.joined(self.unsplit(run[:middle], False), self.unsplit(run[middle:], final), final)

    def stretches(self, text: str) -> Iterator[int | str]:
        """What the pre-tokenizer makes of a text: special token ids and byte-level stretches."""
        at = 0
        for found in [*self.specials.finditer(text), None]:
            part = text[at:found.start() if found else len(text)]
            if part:
                clean = self.tokenizer.normalizer.normalize_str(part) if self.tokenizer.normalizer else part
                yield from (s for s, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(clean))
            if found:
                yield self.special[found.group()]
                at = found.end()

    def long_word(self, word: str) -> list[int]:
        ids: list[int] = []
        for stretch in self.stretches(word):
            ids += [stretch] if isinstance(stretch, int) else self.unsplit(stretch)
        return ids

    # whole texts -------------------------------------------------------------------------------

    def packed(self, ids: list[int]) -> tuple[bytes, str]:
        """Ids as bytes and the text they decode to with a blank behind: without a decoder the library joins tokens by
        blanks."""
        return struct.pack(f"<{len(ids)}i", *ids), "".join([self.blanked[i] for i in ids])

    def plain_word(self, word: str) -> tuple[bytes, str]:
        """A ``_PLAIN`` word by its pieces, most of which words share."""
        found = []
        for piece in _PLAIN_PIECE.findall(word.lower()):
            packed = self.pieces.get(piece)
            if packed is None:
                spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTE_LEVEL)
                packed = self.pieces[piece] = self.packed([t.id for t in self.model.tokenize(spelled)])
            found.append(packed)
        return found[0] if len(found) == 1 else (b"".join([p[0] for p in found]), "".join([p[1] for p in found]))

    def learn(self, words: set[str]) -> None:
        if len(self.ids) > CACHED:
            self.ids, self.spelled = {"": b""}, {"": ""}
        if len(self.pieces) > CACHED:
            self.pieces = {}
        rest = []
        for word in words:
            if word in self.ids:
                continue
            if self.knows_plain and len(word) <= LEAF and _PLAIN.fullmatch(word):
                self.ids[word], self.spelled[word] = self.plain_word(word)
            elif len(word) <= LEAF:
                rest.append(word)
            else:
                self.ids[word], self.spelled[word] = self.packed(self.long_word(word))
        for word, coded in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            self.ids[word], self.spelled[word] = self.packed(coded.ids)

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Ids (little-endian 32-bit) and decoded text of each text."""
        split = [t.replace("\n", " ").split(" ") for t in texts]
        self.learn(set().union(*split) if split else set())
        ids, spelled = self.ids.__getitem__, self.spelled.__getitem__
        return [(b"".join(map(ids, words)), "".join(map(spelled, words))[:-1]) for words in split]


_CODED = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())),
                    ("decoded", pa.large_string())])
_CODED_DDL = "uid long, doc_id long, ids array<int>, decoded string"


def _coded(uids: list, doc_ids: list, coded: list[tuple[bytes, str]]) -> pa.RecordBatch:
    ends = np.cumsum([0] + [len(ids) // 4 for ids, _ in coded]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(ids for ids, _ in coded), "<i4"), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(uids, pa.int64()), pa.array(doc_ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), values),
         pa.array([d for _, d in coded], pa.string())],
        names=_CODED.names)


def _windows(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of bounded text."""
    sizes = pc.utf8_length(batch.column(2)).to_pylist()
    start, total = 0, 0
    for k, size in enumerate(sizes):
        total += size
        if total >= most:
            yield batch.slice(start, k + 1 - start)
            start, total = k + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def _whole(path: str):
    def run(batches: Batches) -> Batches:
        own = coder(path)
        for batch in batches:
            for part in _windows(batch):
                yield _coded(part.column(0).to_pylist(), part.column(1).to_pylist(),
                             own.encode(part.column(2).to_pylist()))

    return run


# pieces of a long document: what a row holds
TEXT, INNER, LAST, DONE = 0, 1, 2, 3
_PIECES = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()), ("kind", pa.int32()),
                     ("part", pa.string()), ("ids", pa.list_(pa.int32()))])
_PIECES_DDL = "uid long, doc_id long, place long, kind int, part string, ids array<int>"


def pieces(own: Coder, text: str, piece: int) -> Iterator[tuple[int, str, list[int]]]:
    """A long text as stretches that can be encoded apart: at blanks, or anywhere inside an unsplit word."""
    held: list[str] = []
    weight = 0
    for word in text.replace("\n", " ").split(" "):
        if len(word) <= piece:
            held.append(word)
            weight += len(word) + 1
            if weight >= 8 * piece:
                yield TEXT, " ".join(held), []
                held, weight = [], 0
            continue
        if held:
            yield TEXT, " ".join(held), []
            held, weight = [], 0
        done: list[int] = []
        for stretch in own.stretches(word):
            if isinstance(stretch, int):
                done.append(stretch)
            elif len(stretch) <= piece:
                done += own.unsplit(stretch)
            else:
                if done:
                    yield DONE, "", done
                    done = []
                for start in range(0, len(stretch), piece):
                    yield (INNER if start + piece < len(stretch) else LAST), stretch[start:start + piece], []
        if done:
            yield DONE, "", done
    if held:
        yield TEXT, " ".join(held), []


def _cut(path: str, piece: int):
    def run(batches: Batches) -> Batches:
        own = coder(path)
        for batch in batches:
            for uid, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                place = -1
                for place, (kind, part, ids) in enumerate(pieces(own, text, piece)):
                    yield _piece_batch([(uid, doc_id, place, kind, part, ids)])
                if place < 0:
                    yield _piece_batch([(uid, doc_id, 0, DONE, "", [])])

    return run


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)


def _encode_pieces(path: str):
    def run(batches: Batches) -> Batches:
        own = coder(path)
        for batch in batches:
            for uid, doc_id, place, kind, part, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == TEXT:
                    ids = np.frombuffer(own.encode([part])[0][0], "<i4").tolist()
                elif kind != DONE:
                    ids = own.unsplit(part, kind == LAST)
                yield _piece_batch([(uid, doc_id, place, kind, "", ids)])

    return run


def concatenated(own: Coder, parts: list[tuple[int, list[int]]]) -> list[int]:
    """Joins the pieces of one document, the pieces of an unsplit word pair by pair up a tree."""
    ids: list[int] = []
    run: list[tuple[list[int], bool]] = []
    for kind, part in parts:
        if kind in (TEXT, DONE):
            ids += part
            continue
        run.append((part, kind == LAST))
        if kind == LAST:
            while len(run) > 1:
                pairs = [run[k:k + 2] for k in range(0, len(run), 2)]
                run = [(own.joined(p[0][0], p[1][0], p[1][1]), p[1][1]) if len(p) == 2 else p[0] for p in pairs]
            ids += run.pop()[0]
    return ids


def _joined(path: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        own = coder(path)
        frame = frame.sort_values("place")
        ids = concatenated(own, [(k, list(i)) for k, i in zip(frame["kind"], frame["ids"])])
        first = frame.iloc[0]
        return pd.DataFrame({"uid": [first["uid"]], "doc_id": pd.array([first["doc_id"]], "Int64"),
                             "ids": [np.array(ids, np.int32)], "decoded": [own.decode(ids) if ids else ""]})

    return run


def bpe_round_trip(docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id",
                   long_chars: int = 1 << 16, piece: int = 4096) -> DataFrame:
    """Per row of ``docs``: uid, doc_id, ids (array<int>) and the text decoded from them.

    ``tokenizer`` is the path of a vocabulary file that every executor has. The ids are those of the
    tokenizers library without special tokens added, truncation or padding; the decoded text keeps
    special tokens. NULL and empty texts give no ids and an empty text. Repeated rows each get a
    row. Texts of ``long_chars`` characters or more are cut into pieces of about ``piece`` (at
    blanks eight times as much) that are encoded as rows of their own; only the tokens of one
    document meet again. Columns other than the two named are not read.
    """
    rows = numbered(docs, {"doc_id": F.col(f"`{doc_id}`").cast("long"), "body": text_of(text)})
    short = rows.where(F.length("body") < long_chars).mapInArrow(_whole(tokenizer), _CODED_DDL)
    cut = rows.where(F.length("body") >= long_chars).mapInArrow(_cut(tokenizer, piece), _PIECES_DDL)
    # a number keeps adaptive execution from merging the few rows of much work
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    coded = cut.repartition(tasks, "uid", "place").mapInArrow(_encode_pieces(tokenizer), _PIECES_DDL)
    long = coded.select("uid", "doc_id", "place", "kind", "ids").groupBy("uid").applyInPandas(
        _joined(tokenizer), _CODED_DDL)
    return short.unionByName(long)
