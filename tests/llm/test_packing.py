import random
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.cases import BYTE_BPE, documents, texts
from tidemark.llm.packing import ByteCoder, lengths, pack_powers, write_buckets


def test_lengths_are_the_binary_digits():
    for n in [0, 1, 2, 3, 2047, 2048, 2049, 10_000]:
        parts = lengths(n, 2048)
        assert sum(parts) == n and parts == sorted(parts, reverse=True)
        assert all(p & (p - 1) == 0 and p <= 2048 for p in parts)
        assert len({p for p in parts if p < 2048}) == len([p for p in parts if p < 2048])


def test_ranked_encoding_equals_the_library():
    own, rng = ByteCoder(BYTE_BPE), random.Random(2)
    assert own.fast
    parts = ["a", "ab", "é", "ß", "中", "1", "-", "́", "  ", " \n", "\r\n", "\t", "'s", "<|endoftext|>", "\x85", "\xa0",
             "᠎", "\x1c", "​", " ", " ", "\n", "😀", "x" * 5000]
    for _ in range(400):
        some = rng.sample(parts, rng.randint(1, 8))
        text = "".join(rng.choice(some) for _ in range(rng.choice([0, 1, 3, 10, 60])))
        ids = own.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids
    for point in range(0, 0x3000, 7):
        text = f"a{chr(point)}{chr(point)}b 1{chr(point)}2 {chr(point)}"
        assert np.frombuffer(own.encode(text), "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_cover_every_document_once(spark, folder):
    library = Tokenizer.from_file(BYTE_BPE)
    found = pack_powers(documents(spark, folder), BYTE_BPE, capacity=64).collect()
    rows = defaultdict(list)
    for r in found:
        rows[r.uid].append(r)
    got = []
    for pieces in rows.values():
        pieces.sort(key=lambda r: r.start)
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:k]) for k in range(len(pieces))]
        ids = np.frombuffer(b"".join(bytes(r.ids) for r in pieces), "<u4").tolist()
        assert all(r.doc_tokens == len(ids) and r.length == 1 << r.bucket <= 64 and r.offset == 0 for r in pieces)
        got.append((str(pieces[0].doc_id), ids))
    expected = [(str(i), library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in texts()]
    assert sorted(got) == sorted(expected)
    assert len({r.sequence_id for r in found}) == len(found)


def test_buckets_are_folders_and_empty_input_is_empty(spark, folder):
    pieces = pack_powers(documents(spark, folder, texts()[:5]), BYTE_BPE, capacity=64)
    write_buckets(pieces, f"{folder}/buckets")
    read = spark.read.parquet(f"{folder}/buckets").where("bucket = 6")
    assert read.count() == pieces.where("length = 64").count() > 0
    assert pack_powers(documents(spark, folder, []), BYTE_BPE).count() == 0
    with pytest.raises(ValueError):
        pack_powers(pieces, BYTE_BPE, capacity=100)
