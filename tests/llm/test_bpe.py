import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.cases import BYTE_BPE, WORD_BPE, documents, texts
from tidemark.llm.bpe import _PLAIN, DONE, LAST, TEXT, Coder, bpe_round_trip, concatenated, pieces


@pytest.fixture(scope="module")
def own():
    return Coder(WORD_BPE)


def test_trees_and_pieces_equal_the_library(own):
    rng = random.Random(1)
    parts = ["a", "ab", "the", "é", "中", "1", "-", "!", "́", "Σ", "'s", "<|startoftext|>", "x" * 30, "\t", "ab" * 40]
    for _ in range(300):
        some = rng.sample(parts, rng.randint(1, 6)) + ([" ", "\n"] if rng.random() < 0.3 else [])
        text = "".join(rng.choice(some) for _ in range(rng.choice([1, 3, 10, 300])))
        ids = own.tokenizer.encode(text, add_special_tokens=False).ids
        assert own.long_word(text) == ids
        cut = [(k, own.long_word(p) if k == TEXT else i if k == DONE else own.unsplit(p, k == LAST))
               for k, p, i in pieces(own, text, rng.choice([7, 64]))]
        assert concatenated(own, cut) == ids


def test_a_repeated_letter_is_joined_right_though_windows_must_grow(own):
    for n in (257, 1000, 5001):
        assert own.unsplit("a" * n) == own.tokenizer.encode("a" * n, add_special_tokens=False).ids


def test_plain_words_equal_the_library(own):
    """Every character that words may have without the library, alone, in pairs and in mixtures."""
    assert own.knows_plain
    plain = [chr(c) for c in range(0x2000) if _PLAIN.fullmatch(chr(c))]
    assert len(plain) > 300 and not {"Σ", "σ", "ς", "<", "İ", "̈", "\u0387"} & set(plain)
    rng = random.Random(8)
    words = [*plain, *(a + b for a in plain for b in "a1.'é×" + rng.choice(plain))]
    words += ["".join(rng.choice(plain if rng.random() < 0.3 else "'stdrevlmEé1.,-") for _ in range(rng.randrange(1, 14))) for _ in range(20000)]
    for word in words:
        ids = own.tokenizer.encode(word, add_special_tokens=False).ids
        packed, spelled = own.plain_word(word)
        assert np.frombuffer(packed, "<i4").tolist() == ids and spelled[:-1] == own.decode(ids), word


@pytest.mark.parametrize("long_chars", [1 << 16, 100])
def test_documents_equal_the_library(spark, folder, long_chars):
    library = Tokenizer.from_file(WORD_BPE)
    found = bpe_round_trip(documents(spark, folder), WORD_BPE, long_chars=long_chars, piece=64).collect()
    expected = []
    for doc_id, text in texts():
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((str(doc_id), ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in found) == sorted(expected)


def test_empty_table_and_other_vocabularies(spark, folder):
    assert bpe_round_trip(documents(spark, folder, []), WORD_BPE).count() == 0
    with pytest.raises(ValueError):
        Coder(BYTE_BPE)
