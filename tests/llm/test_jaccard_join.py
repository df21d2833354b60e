import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.cases import documents, texts
from tidemark.llm.components import components
from tidemark.llm.jaccard_join import drop_near_duplicates, jaccard_components, packed, parity, shingles, unpacked


def sets(rows, width):
    out = []
    for _, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        grams = [tuple(words[k:k + width]) for k in range(len(words) - width + 1)] or ([tuple(words)] if words else [])
        out.append(frozenset(grams))
    return out


def brute(rows, width, num, den):
    """Sizes and smallest linked identifier of each row, over all pairs."""
    found = sets(rows, width)
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(found[a] & found[b])
            if both and den * both >= num * len(found[a] | found[b]):
                root[max(top(a), top(b))] = min(top(a), top(b))
    ids = defaultdict(list)
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[top(k)].append(doc_id)
    return [(doc_id, len(found[k]), min(ids[top(k)], default=None)) for k, (doc_id, _) in enumerate(rows)]


def near_copies():
    rng, rows = random.Random(5), []
    words = [f"w{k}" for k in range(400)]
    for _ in range(20):
        base = [rng.choice(words) for _ in range(rng.choice([3, 8, 20, 60, 150]))]
        for _ in range(rng.choice([1, 2, 6, 25])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("width,num", [(3, 90), (5, 80), (2, 60)])
def test_components_are_those_of_all_pairs(spark, folder, width, num):
    rows = near_copies()
    found = jaccard_components(documents(spark, folder, rows), width=width, num=num, den=100).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows, width, num, 100)


def test_odd_rows(spark, folder):
    rows = texts()
    found = jaccard_components(documents(spark, folder), width=3, num=90, den=100).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=key) == sorted(brute(rows, 3, 90, 100), key=key)
    kept = drop_near_duplicates(documents(spark, folder), width=3, num=90, den=100)
    assert kept.count() == len({r.component for r in found})
    assert kept.columns == documents(spark, folder).columns


def test_empty_table(spark, folder):
    assert jaccard_components(documents(spark, folder, [])).count() == 0


def test_a_chain_of_links_is_one_component(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (101, 102), (7, 7), (None, 3)], "a long, b long")
    found = {r.node: r.root for r in components(links).collect()}
    assert found == {**{k: 0 for k in range(61)}, 100: 100, 101: 100, 102: 100}


def test_hashes():
    tokens = shingles("a b c d a b c", 3)
    assert len(tokens) == 4 and (np.diff(tokens.astype(np.int64)) > 0).all()
    assert unpacked(packed(tokens)).tolist() == tokens.tolist()
    assert len(shingles("A b", 3)) == 1 and shingles("A b", 3).tolist() == shingles("a B", 3).tolist()
    other = shingles("a b c d a b x", 3)
    differ = sum(Counter(x)["1"] for x in (format(p ^ q, "b") for p, q in zip(parity(tokens), parity(other))))
    assert differ <= len(set(tokens.tolist()) ^ set(other.tolist()))
