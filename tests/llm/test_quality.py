import collections
import math
import re

import pytest

from tests.llm.cases import documents, prose, texts, written
from tidemark.llm.quality import LADDERS, binomial_tail, chosen_cutoff, judged, keep_good, measures


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    covered = {k + d for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for d in range(3)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copies += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(covered))


@pytest.mark.parametrize("text", [t or "" for _, t in texts()] + ["a b c b c d b c d", "x\n\nx\n \n x\nx", "é# b \x0b <c>", "a a a a"])
def test_counts(text):
    assert measures(text)[:5] == brute(text)


def test_binomial_tail_is_exact():
    for n, p in [(1, 0.5), (20, 0.1), (300, 0.004), (50, 0.9)]:
        terms = [math.comb(n, k) * p**k * (1 - p)**(n - k) for k in range(n + 1)]
        for k in range(n + 1):
            assert binomial_tail(k, n, p) == pytest.approx(min(sum(terms[:k + 1]), 1.0), rel=1e-9)


def test_a_ladder_stops_at_the_first_step_that_is_not_proven():
    assert chosen_cutoff([3, 2, 1], [0, 0, 0], [1, 5, 5], 2000, 0.01, 0.01) == (2, 3)
    assert chosen_cutoff([3, 2, 1], [0, 900, 0], [1, 5, 9], 2000, 0.01, 0.01) == (3, 1)
    assert chosen_cutoff([3, 2, 1], [0, 0, 0], [1, 5, 5], 20, 0.01, 0.01) == (None, 0)
    assert chosen_cutoff([1], [0], [0], 0, 0.01, 0.01) == (None, 0)


def test_verdicts(spark, folder):
    rows, labels = [], []
    for k in range(900):
        bad = k % 5 == 0
        words = prose(k, 60, 5000).split()
        rows.append((k, " ".join(w + "*" for w in words) if bad else " ".join(words)))
        labels.append((k, 0 if bad else 1))
    docs = documents(spark, folder, rows + [(1000 + (i or 0), t) for i, t in texts()])
    marks = written(spark, folder, labels + [(None, 1), (3, None), (4, 1)], "doc_id long, quality int")
    found = judged(docs, marks, alpha=0.1).collect()
    assert len(found) == len(rows) + len(texts())
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[k].kept == (k % 5 > 0) for k in range(900))
    assert by_id[5].failed_rule == "symbols_per_word" and not by_id[1006].kept
    assert all(r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) for r in found)
    # too few labels prove nothing: the base rules alone decide
    few = judged(docs, marks.limit(0), alpha=0.1).collect()
    assert all(r.kept == (not r.base_failed) for r in few)
    kept = keep_good(docs, marks, alpha=0.1)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in found)
    assert judged(documents(spark, folder, []), marks).count() == 0


def test_ladders_go_down():
    assert all(ladder == sorted(ladder, reverse=True) for ladder in LADDERS.values())
