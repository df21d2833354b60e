"""License scans: fuzzy search for short notices.

A text is reduced to its words, lower-cased and joined by one blank, so that line breaks, comment signs and
punctuation do not count. A notice of n characters may have one error (a character inserted, deleted
or replaced) for every ``CHARS_PER_ERROR`` of them. By the pigeonhole principle one of its k + 1 pieces then
stands in the text as it is: one automaton finds the pieces of all notices, and the regex library's bounded-error
matching verifies the few windows around them and counts the edits.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Mapping
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Batches, give_back, in_batches, in_slices, text_of

CHARS_PER_ERROR = 12

# Phrases that count word by word, and their labels
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Short notices of common licenses, and their labels
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "this program is free software you can redistribute it and or modify it under the terms of": "gnu-notice",
    "this library is free software you can redistribute it and or modify it under the terms of": "gnu-notice",
    "apache license": "apache",
    "licensed under the apache license version 2 0": "apache",
    "the mit license": "mit",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "3 clause bsd license": "bsd",
    "2 clause bsd license": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "boost",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "creative commons attribution": "cc",
    "creative commons attribution sharealike": "cc-sa",
    "creative commons attribution noncommercial": "cc-nc",
    "licensed under a creative commons": "cc",
    "licensed under cc by": "cc-by",
    "creative commons zero": "cc0",
    "gnu free documentation license": "gfdl",
    "open database license": "odbl",
    "sil open font license": "ofl",
    "all rights reserved": "reserved",
}

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def folded(text: str) -> bytes:
    """The words of a text, A-Z lower-cased, with one blank around each."""
    words = text.encode().translate(_FOLD).split()
    return b" " + b" ".join(words) + b" " if words else b" "


def allowed(notice: str) -> int:
    """The errors that a notice may have."""
    return len(notice) // CHARS_PER_ERROR


def pieces(notice: str) -> list[tuple[int, str]]:
    """A notice in one piece more than it may have errors, as even as they go, with their places."""
    parts = allowed(notice) + 1
    cuts = [len(notice) * k // parts for k in range(parts + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Finds the places of phrases, word by word, and of notices with bounded errors."""

    def __init__(self, notices: Mapping[str, str], base: Mapping[str, str]):
        for phrase in [*notices, *base]:
            if folded(phrase).decode() != f" {phrase} ":
                raise ValueError(f"not in lower-case words with one blank between: {phrase!r}")
        self.notices, self.base = list(notices.items()), [(f" {p} ".encode(), label) for p, label in base.items()]

    @cached_property
    def seeds(self):
        """The automaton of all notices' pieces; a piece knows its notices and its place in each."""
        import ahocorasick

        owners: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (notice, _) in enumerate(self.notices):
            for place, piece in pieces(notice):
                owners[piece].append((number, place))
        automaton = ahocorasick.Automaton()
        for piece, where in owners.items():
            automaton.add_word(piece, (len(piece), where))
        automaton.make_automaton()
        return automaton

    @cached_property
    def patterns(self) -> list[tuple]:
        """Per notice: any match with bounded errors, and the best one."""
        import regex

        bodies = [f"(?<= )(?:{regex.escape(n, special_only=True, literal_spaces=True)}){{e<={allowed(n)}}}(?= )" for n, _ in self.notices]
        return [(regex.compile(b), regex.compile("(?b)" + b)) for b in bodies]

    def stretches(self, text: str) -> dict[int, list[list[int]]]:
        """Per notice, the parts of the text (apart, in order) that hold all its possible places."""
        found: dict[int, list[list[int]]] = {}
        if not self.notices:
            return found
        for last, (length, where) in self.seeds.iter(text):
            for number, place in where:
                size = len(self.notices[number][0])
                slack = allowed(self.notices[number][0]) + 1
                begin = last + 1 - length - place
                start, end = max(0, begin - slack), min(len(text), begin + size + slack)
                held = found.setdefault(number, [])
                # pieces are met by their ends, so an earlier one may reach further back
                while held and start <= held[-1][1]:
                    a, b = held.pop()
                    start, end = min(start, a), max(end, b)
                held.append([start, end])
        return found

    def spans(self, text: str) -> list[tuple[int, int, int, int]]:
        """Start, end, notice and edits of the matches in a folded text. From left to right: the first match,
        and in its place the best that begins in it; the next one begins behind that."""
        found = []
        for number, parts in self.stretches(text).items():
            first, best = self.patterns[number]
            reach = len(self.notices[number][0]) + allowed(self.notices[number][0]) + 1
            for start, end in parts:
                at = start
                while hit := first.search(text, at, end):
                    if any(hit.fuzzy_counts):
                        hit = best.search(text, max(hit.start() - 1, at), min(hit.start() + reach, end)) or hit
                    found.append((hit.start(), hit.end(), number, sum(hit.fuzzy_counts)))
                    at = hit.end()
        return sorted(found)

    def scan(self, text: str) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score, spans of one text."""
        data = folded(text)
        n_words = data.count(b" ") - 1
        places, base_labels = [], set()
        n_base = 0
        for phrase, label in self.base:
            at = data.find(phrase)
            if at < 0:
                continue
            base_labels.add(label)
            places += [at, data.rfind(phrase)]
            while at >= 0:
                n_base += 1
                at = data.find(phrase, at + 1)
        first = data.count(b" ", 0, min(places)) if places else None
        last = data.count(b" ", 0, max(places)) if places else None
        line = data.decode()
        hits = self.spans(line)
        score = max([float(bool(n_base)), *(1 - edits / len(self.notices[k][0]) for _, _, k, edits in hits)])
        labels = base_labels | {self.notices[k][1] for _, _, k, _ in hits}
        return (n_words, n_base, first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels)), score,
                self._reported(text, line, hits))

    def _reported(self, text: str, line: str, hits: list[tuple[int, int, int, int]]) -> list[dict]:
        """The spans in words and in characters of the text itself."""
        if not hits:
            return []
        words = [m.span() for m in _WORD.finditer(text)]
        out, at, before = [], 0, 0
        for start, end, number, edits in hits:
            before, at = before + line.count(" ", at, start), start
            first, last = before - 1, before - 1 + line.count(" ", start, end)
            out.append({"notice": self.notices[number][0], "label": self.notices[number][1], "edits": edits,
                        "start": words[first][0], "end": words[last][1], "first_word": first, "n_words": last - first + 1})
        return out


_SPAN = [("notice", pa.string()), ("label", pa.string()), ("edits", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
         ("first_word", pa.int64()), ("n_words", pa.int64())]
_SCAN = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct(_SPAN)))])
_SCAN_DDL = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<notice:string,label:string,edits:int,start:long,end:long,first_word:long,n_words:long>>")


def _scan(notices: Mapping[str, str], base: Mapping[str, str]):
    def run(batches: Batches) -> Batches:
        scanner = Scanner(notices, base)
        rows = ((doc_id, *scanner.scan(text)) for batch in in_slices(batches)
                for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)))
        yield from in_batches(rows, _SCAN, lambda row: 64 + 200 * len(row[8]))
        give_back()

    return run


def license_scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", notices: Mapping[str, str] = NOTICES,
                 base: Mapping[str, str] = BASE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``base`` maps phrases to labels; a place counts if the phrase's words stand there one after another.
    ``notices`` maps notices to labels and finds them with errors (see the module); ``spans`` lists each match with its
    notice, label, edits, place in the text (characters) and in its words. ``labels`` has the labels of
    both, distinct and sorted. ``score`` is 1 for a base phrase, else the largest share of a found notice that needs
    no edit, else 0. Phrases are given as lower-case words with one blank between.

    A whole text is read in one task, with no shuffle. NULL counts as empty; a text without words has zeros and
    empty labels; repeated rows each get a row; only the two named columns are read.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(text).alias("body"))
    return rows.mapInArrow(_scan(dict(notices), dict(base)), _SCAN_DDL)
