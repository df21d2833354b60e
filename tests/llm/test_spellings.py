"""Spelling variants against brute force by regular expression and deletion neighbourhoods."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.cases import documents, texts
from tidemark.llm.queries import QUERIES
from tidemark.llm.spellings import LEFT, RIGHT, BiIndex, Ranks, near_pairs, near_words, rooted, spelling_variants, suffix_ranks

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows, least=5, often=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= often}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def neighbours(words):
    """Near words by words with one letter taken out, or marked as any."""
    held = defaultdict(set)
    for w in words:
        held[w].add(w)
        for k in range(len(w)):
            held[w[:k] + w[k + 1:]].add(w)
            held[w[:k] + "*" + w[k + 1:]].add(w)
    found = defaultdict(set)
    for group in held.values():
        for a in group:
            found[a] |= {b for b in group if near(a, b)}
    return found


def brute(rows):
    counts = counted(rows)
    found = neighbours(counts)
    form = {}
    for w, n in counts.items():
        best = min(found[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n, len(found[w]), counts.get(form[w])) for w, n in counts.items()), key=str)


def results(frame):
    return sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in frame.collect()), key=str)


def some_words(seed, n, letters="abcé"):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(n)} | {"a" * 40, "a" * 41, "a" * 39 + "b"})


def test_suffix_ranks():
    rng = np.random.default_rng(1)
    for n in (1, 2, 50, 400):
        codes = np.concatenate([rng.integers(1, 4, n), [0]])
        assert suffix_ranks(codes).tolist() == sorted(range(n + 1), key=lambda k: codes[k:].tolist())
    repeated = np.array([2, 1] * 300 + [0])
    assert suffix_ranks(repeated).tolist() == sorted(range(601), key=lambda k: repeated[k:].tolist())


def test_ranks():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 6, 200)
    ranks = Ranks(codes, 3)
    low = rng.integers(0, 200, 300)
    high = np.minimum(low + rng.integers(0, 40, 300), 200)
    code = rng.integers(0, 8, 300)
    before, inside, smaller = ranks.narrowed(low, high, code)
    for k in range(300):
        part = codes[low[k]:high[k]]
        assert (before[k], inside[k], smaller[k]) == ((codes[:low[k]] == code[k]).sum(), (part == code[k]).sum(), (part < code[k]).sum())
    which, found = ranks.distinct(low, high)
    assert sorted(zip(which.tolist(), found.tolist())) == [(k, c) for k in range(300) for c in sorted(set(codes[low[k]:high[k]].tolist()))]


def test_both_directions():
    """A stretch is lengthened on either side in any order; its places are those of the text."""
    words = [w.encode("latin-1") for w in some_words(3, 60)]
    index = BiIndex(words)
    text = b"\n" + b"\n".join(words) + b"\n"
    rng = random.Random(3)
    for _ in range(300):
        start = rng.randrange(len(text))
        begin = end = start
        found = index.empty(1)
        while end - begin < 12 and (begin > 0 or end < len(text)):
            if begin > 0 and (end == len(text) or rng.random() < 0.5):
                begin -= 1
                found = index.longer(found, index.code[[text[begin]]], LEFT)
            else:
                found = index.longer(found, index.code[[text[end]]], RIGHT)
                end += 1
            places = sorted(index.place[found.low[0]:found.low[0] + found.size[0]].tolist())
            assert places == [k for k in range(len(text)) if text[k:].startswith(text[begin:end])]
    assert index.longer(index.longer(index.empty(1), index.code[[10]], LEFT), index.code[[10]], LEFT).size[0] == 0


@pytest.mark.parametrize("seed", range(4))
def test_schemes(seed):
    """Each side finds the pairs whose other letter is in that half, both together all of them."""
    words = some_words(seed, 80 + 200 * seed, "ab" if seed % 2 else "abcdé")
    raw = [w.encode("latin-1") for w in words]
    index, found = BiIndex(raw), set()
    for side in (LEFT, RIGHT):
        for a, b in zip(*(c.tolist() for c in near_pairs(index, raw, side))):
            one, two = words[a], words[b]
            half = len(one) // 2
            assert near(one, two) and len(one) <= len(two)
            assert one[:half] == two[:half] if side == RIGHT else two.endswith(one[half:])
            found |= {(one, two), (two, one)}
    assert found == {(a, b) for a, others in neighbours(words).items() for b in others}


@pytest.mark.parametrize("most_shared", [1, 7, 20_000])
def test_pairs(spark, most_shared):
    words = some_words(9, 400)
    frame = spark.createDataFrame([(w, k) for k, w in enumerate(words)], "word string, n long")
    found = {(r.word, r.near, r.near_n) for r in near_words(frame, most_shared=most_shared, task_rows=500).collect()}
    assert found == {(a, b, words.index(b)) for a, others in neighbours(words).items() for b in others}


def test_roots(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(37)] + [("w37", None), ("x", "w5"), ("y", None)]
    found = {r.word: r.root for r in rooted(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert found == {**{f"w{k}": "w37" for k in range(38)}, "x": "w37", "y": "y"}


def test_rows(spark, folder):
    words = ["spelling", "speling", "spellings", "spélling", "Spelling", "SPELLINGX", "tie_alpha", "alphb", "alphc", "alphax", "×÷×÷×", "über-ÜBERN"]
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choices(words, [40, 4, 9, 3, 5, 3, 4, 4, 4, 4, 3, 3], k=60))) for k in range(40)] + texts()
    rows += [(None, "aaaaa " * 9 + "aaaab" * 1 + " " + "a" * 3000 + " " + ("a" * 3001 + " ") * 9), (77, "b" * 2999 + "c "), *[(78, "b" * 3000)] * 4]
    assert results(spelling_variants(documents(spark, folder, rows))) == brute(rows)
    assert results(spelling_variants(documents(spark, folder, rows), most_shared=2)) == brute(rows)
    assert results(spelling_variants(documents(spark, folder, [(1, None), (2, ""), (3, "one two")]))) == []
    assert results(spelling_variants(documents(spark, folder, []).limit(0))) == []


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    frame = QUERIES["op12_spelling_variants"](spark, SF)
    assert dict(frame.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert results(frame) == brute(rows)
