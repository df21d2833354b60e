"""License scans against brute force: phrases by regular expression, notices by edit distance."""

import re

import pytest

from tests.llm.cases import documents, prose, texts
from tidemark.llm.notices import BASE, NOTICES, Scanner, allowed, folded, license_scan, pieces

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def base(text):
    """n_words, n_base, first_word, last_word, base_labels."""
    words = WORDS.findall(lowered(text))
    found = [(k, label) for phrase, label in BASE.items() for k in range(len(words))
             if words[k:k + len(phrase.split())] == phrase.split()]
    starts = [k for k, _ in found]
    return (len(words), len(found), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in found})))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, left = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(left[j] + 1, row[j - 1] + 1, left[j - 1] + (x != y)))
    return row[-1]


def closest(text, notice):
    """The fewest edits between the notice and any run of whole words."""
    words = WORDS.findall(lowered(text))
    size = len(notice.split())
    return min((distance(" ".join(words[i:j]), notice) for i in range(len(words))
                for j in range(i + 1, min(len(words), i + 2 * size) + 1)), default=99)


TEXTS = [
    "This work is licensed under the GNU General Public License, version 3.", "licensed under CC BY-NC 4.0", "CC BY, CC by cc  by",
    "the gnu\n * general\n * public\n * license", "GNU Genral Public Licence", "gnu generalpublic license", "an Apache-Licence text",
    "The MIT Licence (MIT)", "the mité license", "MIT License" * 3, "MIT License " * 3, "submit license", "mit licenses",
    "Permission is hereby grantd, free of charge to any person obtaining a copy", "all rigths reserved", "ALL RIGHTS RESERVD",
    "apache license apache licens apach license", "", " \n", "creative commons attribution-sharealike", "gnu x general public license",
    "License " * 50, "no notice at all", "Redİstribution", "all rights reserved", "a" * 3000, "gnu general public license " * 40,
]


@pytest.mark.parametrize("text", TEXTS)
def test_text(text):
    scanner = Scanner(NOTICES, BASE)
    n_words, n_base, first, last, labels, both, score, spans = scanner.scan(text)
    assert (n_words, n_base, first, last, labels) == base(text)
    found = {s["notice"] for s in spans}
    if len(text) < 400:
        assert found == {n for n in NOTICES if closest(text, n) <= allowed(n)}
    for s in spans:
        matched = " ".join(WORDS.findall(lowered(text[s["start"]:s["end"]])))
        assert distance(matched, s["notice"]) == s["edits"] <= allowed(s["notice"])
        assert matched.split(" ") == folded(text).decode()[1:-1].split(" ")[s["first_word"]:s["first_word"] + s["n_words"]]
    expected = [1.0] * bool(n_base) + [1 - s["edits"] / len(s["notice"]) for s in spans]
    assert score == max(expected, default=0.0)
    assert set(labels.split(",")) | {s["label"] for s in spans} == set(both.split(",")) | ({""} if not labels else set())


def test_planted():
    """A notice with as many errors as it may have is found wherever it stands, with no more edits than were made."""
    import random

    rng = random.Random(4)
    scanner = Scanner(NOTICES, BASE)
    for notice in NOTICES:
        for _ in range(8):
            letters = list(notice)
            for _ in range(allowed(notice)):
                k = rng.randrange(1, len(letters) - 1)
                letters[k:k + 1] = rng.choice([[], ["q"], [letters[k], "z"]])
            spans = scanner.scan(f"{prose(rng.randrange(99), 30)}. {''.join(letters)}, {prose(rng.randrange(99), 30)}")[-1]
            assert any(s["notice"] == notice and s["edits"] <= allowed(notice) for s in spans)


def test_pieces():
    for notice in NOTICES:
        parts = pieces(notice)
        assert "".join(p for _, p in parts) == notice and len(parts) == allowed(notice) + 1
        assert min(len(p) for _, p in parts) >= 5


def test_bad_phrase():
    with pytest.raises(ValueError):
        Scanner({"MIT License": "mit"}, {})


def test_rows(spark, folder):
    rows = texts() + [(90, TEXTS[0]), (90, TEXTS[0]), (91, "MIT License " * 5000)]
    found = license_scan(documents(spark, folder, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_base, r.base_labels) for r in found) == sorted(
        (i or 0, base(t)[0], base(t)[1], base(t)[4]) for i, t in rows)
    assert license_scan(documents(spark, folder, []).limit(0)).count() == 0
    assert [s.label for s in next(r for r in found if r.doc_id == 90).spans] == ["gpl"]
