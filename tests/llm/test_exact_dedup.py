import hashlib
import random
from collections import defaultdict

import pytest

from tests.llm.cases import documents, texts
from tidemark.llm.exact_dedup import PatriciaTrie, drop_exact_duplicates, exact_duplicates


@pytest.mark.parametrize("budget", [1 << 30, 3000])
def test_trie_keeps_the_best_of_each_string_also_when_it_spills(budget):
    rng = random.Random(3)
    trie, expected = PatriciaTrie(budget), defaultdict(lambda: [(9**9,), 0, []])
    for k in range(600):
        key = bytes(rng.choice(b"ab\x00") for _ in range(rng.randrange(0, 7))) * rng.randrange(1, 4)
        trie.add(key, (k * 7919 % 601,), 1, [k])
        entry = expected[key]
        expected[key] = [min(entry[0], (k * 7919 % 601,)), entry[1] + 1, entry[2] + [k]]
    found = {key: [best, n, sorted(members)] for key, (best, n, members) in trie.items()}
    assert found == dict(expected)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("window", [1 << 26, 2000])
def test_groups_are_those_of_equal_texts(spark, folder, keep, window):
    found = exact_duplicates(documents(spark, folder), keep=keep, window_bytes=window, trie_bytes=5000).collect()
    groups = defaultdict(list)
    for doc_id, text in texts():
        groups[text or ""].append(doc_id)
    pick = min if keep == "smallest" else max
    expected = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = pick(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        expected += [(i, best, len(ids), sha) for i in ids]
    key = lambda row: (str(row[0]), row[3])
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=key) == sorted(expected, key=key)
    assert sum(r.kept for r in found) == len(groups)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_dropping_keeps_one_row_of_each_group_and_all_columns(spark, folder):
    docs = documents(spark, folder)
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted({t or "" for _, t in texts()})


def test_empty_table(spark, folder):
    docs = documents(spark, folder, [])
    assert exact_duplicates(docs).count() == 0
    assert drop_exact_duplicates(docs).count() == 0
