"""Spelling variant grouping by search schemes in a bidirectional FM-index.

Two words are near if one inserted, deleted or replaced letter turns one into the other. The letter that
differs lies in the first or the second half of the shorter word, so the other half is the same in both. The
index holds the sorted vocabulary with a delimiter around each word, forwards and backwards: a stretch of
text is an interval of suffix ranks in both, and may be lengthened on either side. A search matches one half with
its delimiter exactly, then goes on across the other half and allows one other letter, replaced or
inserted; a deletion is the insertion that the shorter word finds. What ends at the other delimiter is one word.

The vocabulary is dealt out so that no task needs all of it: words that share a half meet in the same task, and a
half that too many words share is cut again by the same argument (either part of the rest is equal too).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidemark.llm.common import Batches, give_back, in_batches, in_slices, text_of
from tidemark.session import settle, settle_sized

BROADCAST_BYTES = 32 << 20
LEAST_LENGTH, LEAST_COUNT = 5, 3
ALTERED = 97  # a run whose checksum this divides loses a letter

# A-Z and a-z as a-z, U+00C0 to U+00FF as they are, everything else as a blank; all in one byte a letter
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


# words -------------------------------------------------------------------------------------------


def words_of(doc_id: int | None, text: str) -> Iterator[tuple[bytes, int]]:
    """The distinct words of a text and how often they stand there, in Latin-1."""
    base = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(text.encode("latin-1", "replace").translate(_FOLD).split()).items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), base)
        if h % ALTERED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        yield run, n


_COUNT = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _count(least_length: int, most: int = 400_000):
    def run(batches: Batches) -> Batches:
        def rows() -> Iterator[tuple]:
            counts: Counter[bytes] = Counter()
            for batch in in_slices(batches):
                for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                    for word, n in words_of(doc_id, text):
                        if len(word) >= least_length:
                            counts[word] += n
                    if len(counts) > most:
                        yield from ((w.decode("latin-1"), n) for w, n in counts.items())
                        counts.clear()
            yield from ((w.decode("latin-1"), n) for w, n in counts.items())

        yield from in_batches(rows(), _COUNT)
        give_back()

    return run


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_length: int = LEAST_LENGTH,
               least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n: the runs of letters (A-Z, a-z, U+00C0 to U+00FF; only A-Z lower-cased) of all whole texts, one of
    ``ALTERED`` without one of its letters, that have ``least_length`` letters and come ``least_count`` times."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(text).alias("body"))
    counted = rows.mapInArrow(_count(least_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# the index ---------------------------------------------------------------------------------------


def suffix_ranks(codes: np.ndarray) -> np.ndarray:
    """The suffix array of a text that ends with its only smallest code, by doubling."""
    n = len(codes)
    width = max(1, 62 // max(1, int(codes.max()).bit_length()))
    bits = int(codes.max()).bit_length()
    key = np.zeros(n, np.int64)
    padded = np.concatenate([codes, np.zeros(width, codes.dtype)])
    for k in range(width):
        key = key << bits | padded[k:k + n]
    reach = width
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        further = np.zeros(n, np.int64)
        if reach < n:
            further[:n - reach] = rank[reach:] + 1
        key = rank * (n + 1) + further
        reach *= 2


class Ranks:
    """Counts in a sequence of codes, by a wavelet matrix; all positions and codes are arrays."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.levels = []
        for bit in reversed(range(bits)):
            ones = (codes >> bit & 1).astype(bool)
            before = np.zeros(len(codes) + 1, np.int32)
            np.cumsum(ones, out=before[1:])
            self.levels.append((bit, before, len(codes) - int(before[-1])))
            codes = np.concatenate([codes[~ones], codes[ones]])
        self.origin = np.zeros(1 << bits, np.int64)
        self.origin = self.narrowed(*(np.zeros(1 << bits, np.int64),) * 2, np.arange(1 << bits))[0]

    def narrowed(self, low: np.ndarray, high: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of code: how often it stands before low, how often in [low, high), and how many smaller ones stand there."""
        smaller = np.zeros(len(low), np.int64)
        for bit, before, zeros in self.levels:
            ones_low, ones_high = before[low], before[high]
            one = (code >> bit & 1).astype(bool)
            smaller += np.where(one, (high - low) - (ones_high - ones_low), 0)
            low = np.where(one, zeros + ones_low, low - ones_low)
            high = np.where(one, zeros + ones_high, high - ones_high)
        return low - self.origin[code], high - low, smaller

    def distinct(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes that stand in [low, high): which interval, which code."""
        which, code = np.arange(len(low)), np.zeros(len(low), np.int64)
        for bit, before, zeros in self.levels:
            ones_low, ones_high = before[low], before[high]
            zero, one = (high - low) > (ones_high - ones_low), ones_high > ones_low
            which = np.concatenate([which[zero], which[one]])
            code = np.concatenate([code[zero], code[one] | 1 << bit])
            low, high = (np.concatenate([(low - ones_low)[zero], zeros + ones_low[one]]),
                         np.concatenate([(high - ones_high)[zero], zeros + ones_high[one]]))
        return which, code


class Found:
    """Intervals of suffix ranks of one stretch of text each: where it begins among the suffixes of the text
    (``low``) and of the reversed text (``back``), and how many there are."""

    def __init__(self, low: np.ndarray, back: np.ndarray, size: np.ndarray):
        self.low, self.back, self.size = low, back, size

    def take(self, which: np.ndarray) -> Found:
        return Found(self.low[which], self.back[which], self.size[which])


LEFT, RIGHT = 0, 1


class BiIndex:
    """A bidirectional FM-index of sorted, distinct words; code 0 ends the text, code 1 delimits words."""

    END, DELIMITER = 0, 1

    def __init__(self, words: list[bytes]):
        raw = np.frombuffer(b"\n" + b"\n".join(words) + b"\n", np.uint8)
        letters = np.unique(raw)  # the delimiter is smaller than all letters
        self.code = np.zeros(256, np.int64)
        self.code[letters] = np.arange(1, len(letters) + 1)
        bits = int(len(letters)).bit_length()
        text = np.concatenate([self.code[raw], [self.END]])
        reverse = np.concatenate([text[-2::-1], [self.END]])
        counts = np.bincount(text, minlength=1 << bits)
        self.before = np.concatenate([[0], np.cumsum(counts)])[:1 << bits]
        self.n = len(text)
        self.ranks, self.place = [None, None], None
        for side, codes in ((RIGHT, reverse), (LEFT, text)):
            order = suffix_ranks(codes)
            self.ranks[side] = Ranks(codes[order - 1], bits)
            if side == LEFT:
                self.place = order
        starts = np.flatnonzero(text == self.DELIMITER)
        self.word_at = np.zeros(self.n, np.int64)
        self.word_at[starts] = np.arange(len(starts))

    def empty(self, n: int) -> Found:
        """The empty stretch, which stands everywhere."""
        return Found(np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, self.n))

    def longer(self, found: Found, code: np.ndarray, side: int) -> Found:
        """The stretches with one more code on one side; those that stand nowhere have size 0."""
        near, far = (found.low, found.back) if side == LEFT else (found.back, found.low)
        earlier, size, smaller = self.ranks[side].narrowed(near, near + found.size, code)
        near, far = self.before[code] + earlier, far + smaller
        return Found(near, far, size) if side == LEFT else Found(far, near, size)

    def next_codes(self, found: Found, side: int) -> tuple[np.ndarray, np.ndarray]:
        """The codes that stand beside the stretches: which stretch, which code."""
        near = found.low if side == LEFT else found.back
        return self.ranks[side].distinct(near, near + found.size)

    def words(self, found: Found) -> np.ndarray:
        """The numbers of the words whose whole delimited texts were matched."""
        return self.word_at[self.place[found.low]]


class Patterns:
    """Words as padded rows of codes."""

    def __init__(self, words: list[bytes], code: np.ndarray):
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.codes = code[np.frombuffer(b"".join(words), np.uint8)]

    def at(self, which: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.codes[self.start[which] + place]


def near_pairs(index: BiIndex, words: list[bytes], side: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (number in ``words``, number in the index) of a word and one with one letter replaced or inserted in
    its half on that side, the other half being matched exactly."""
    patterns = Patterns(words, index.code)
    half = patterns.length // 2
    which = np.arange(len(words))
    # the exact half and its delimiter, lengthened towards the middle; then on across the other half
    found = index.longer(index.empty(len(words)), np.full(len(words), index.DELIMITER), side)
    done = np.zeros(len(words), np.int64)  # letters of the word that are matched
    exact = half if side == RIGHT else patterns.length - half

    def letter(which: np.ndarray, done: np.ndarray) -> np.ndarray:
        return patterns.at(which, done if side == RIGHT else patterns.length[which] - 1 - done)

    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    changed = (np.zeros(0, np.int64), np.zeros(0, np.int64), found.take(np.zeros(0, np.int64)))
    while len(which) or len(changed[0]):
        # one letter behind the exact half is other: replaced, or inserted before the next one or at the end
        open_ = np.flatnonzero(done >= exact[which])
        if len(open_):
            mother, code = index.next_codes(found.take(open_), side)
            mother = open_[mother]
            whole = done[mother] == patterns.length[which[mother]]
            own = np.full(len(mother), -1)
            own[~whole] = letter(which[mother[~whole]], done[mother[~whole]])
            other = (code > index.DELIMITER) & (code != own)
            mother, code, whole = mother[other], code[other], whole[other]
            grown = index.longer(found.take(mother), code, side)
            replaced = np.flatnonzero(~whole)
            changed = (np.concatenate([changed[0], which[mother], which[mother[replaced]]]),
                       np.concatenate([changed[1], done[mother], done[mother[replaced]] + 1]),
                       _joined([changed[2], grown, grown.take(replaced)]))
        # words with their other letter end at the delimiter
        ends = changed[1] == patterns.length[changed[0]]
        if ends.any():
            whole = index.longer(changed[2].take(ends), np.full(int(ends.sum()), index.DELIMITER), side)
            met = whole.size > 0
            pairs.append((changed[0][ends][met], index.words(whole.take(met))))
        changed = _advanced(index, changed[0][~ends], changed[1][~ends], changed[2].take(~ends), letter, side)
        going = done < patterns.length[which]
        which, done, found = _advanced(index, which[going], done[going], found.take(going), letter, side)
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    query, met = (np.concatenate(c) for c in zip(*pairs))
    both = np.unique(np.stack([query, met], 1), axis=0)
    return both[:, 0], both[:, 1]


def _joined(parts: list[Found]) -> Found:
    return Found(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("low", "back", "size")))


def _advanced(index: BiIndex, which: np.ndarray, done: np.ndarray, found: Found, letter, side: int):
    """One letter of each word further; what stands nowhere is dropped."""
    if not len(which):
        return which, done, found
    found = index.longer(found, letter(which, done), side)
    left = found.size > 0
    return which[left], done[left] + 1, found.take(left)


# pairs over the cluster --------------------------------------------------------------------------

_PAIR = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def _search(batches: Batches) -> Batches:
    """The pairs of near words among the rows of a task (word, n, side), both ways."""
    rows = [set(), set()]
    counts: dict[bytes, int] = {}
    for batch in batches:
        for word, n, side in zip(*(c.to_pylist() for c in batch.columns)):
            raw = word.encode("latin-1")
            rows[side].add(raw)
            counts[raw] = n

    def pairs() -> Iterator[tuple]:
        for side in (LEFT, RIGHT):
            words = sorted(rows[side])
            if len(words) < 2:
                continue
            for one, two in zip(*(c.tolist() for c in near_pairs(BiIndex(words), words, side))):
                a, b = words[one], words[two]
                yield a.decode("latin-1"), b.decode("latin-1"), counts[b]
                if len(a) != len(b):  # the longer word lacks a letter here; a replaced one both words find
                    yield b.decode("latin-1"), a.decode("latin-1"), counts[a]

    yield from in_batches(pairs(), _PAIR)
    give_back()


def _cut_again(keyed: DataFrame) -> DataFrame:
    """Rows by two finer keys each: the free middle of the shorter word is halved, and one part of it is equal."""
    part = F.expr("(least - head - tail) div 2")
    first = F.struct(F.expr("head + (least - head - tail) div 2").alias("head"), F.col("tail").alias("tail"), F.lit(RIGHT).alias("side"))
    second = F.struct(F.col("head").alias("head"), (F.col("least") - F.col("head") - part).alias("tail"), F.lit(LEFT).alias("side"))
    cut = keyed.withColumn("to", F.explode(F.array(first, second)))
    return cut.select("word", "n", "least", F.col("to.head").alias("head"), F.col("to.tail").alias("tail"),
                      F.coalesce("side", F.col("to.side")).alias("side"))


def _key() -> Column:
    """What a row shares with its near words: a head and a tail of the shorter word's length."""
    return F.xxhash64("least", "head", "tail", "side", F.expr("substring(word, 1, head)"),
                      F.expr("substring(word, length(word) - tail + 1, tail)")).alias("key")


def near_words(words: DataFrame, least_length: int = 1, most_shared: int = 20_000, task_rows: int = 100_000) -> DataFrame:
    """word, near, near_n of all pairs of near words, both ways (runs jobs). ``words`` has word and n, distinct; no
    word is shorter than ``least_length``.

    A word is sent to the tasks of its halves, once as the shorter word of a pair (or one of two equally long ones)
    and once as the longer. Halves that more than ``most_shared`` rows have are cut again, until
    no such half can be cut; about ``task_rows`` rows go to a task.
    """
    rows = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("least"),
                        F.lit(0).alias("head"), F.lit(0).alias("tail"), F.lit(None).cast("int").alias("side"))
    dealt = _cut_again(rows.where(F.col("least") >= least_length)).select("*", _key())
    done: list[DataFrame] = []
    total = 0
    while True:
        seen = Observation()
        dealt = settle(dealt.observe(seen, F.count(F.lit(1)).alias("rows")))
        total += seen.get["rows"]
        counts = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.max(F.expr("least - head - tail")).alias("free"))
        hot, size = settle_sized(counts.where((F.col("rows") > most_shared) & (F.col("free") > 1)).select("key"))
        if hot.isEmpty():
            done.append(dealt)
            break
        listed = F.broadcast(hot) if size <= BROADCAST_BYTES else hot
        done.append(dealt.join(listed, "key", "left_anti").select(*dealt.columns))
        dealt = _cut_again(dealt.join(listed, "key", "left_semi")).select("*", _key())
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // task_rows))
    found = reduce(DataFrame.unionByName, done).repartition(tasks, "key").select("word", "n", "side").mapInArrow(
        _search, "word string, near string, near_n long")
    return found.groupBy("word", "near").agg(F.max("near_n").alias("near_n"))


def rooted(forms: DataFrame) -> DataFrame:
    """word, root: the last word that following ``forms`` (word, form; the form may be NULL) leads to (runs jobs).

    Each round doubles the steps that are known, so their number is the logarithm of the longest way. There
    must be no cycles."""
    at = settle(forms.select("word", F.coalesce("form", "word").alias("root")))
    while True:
        steps = at.where("word != root").select(F.col("word").alias("root"), F.col("root").alias("next"))
        seen = Observation()
        moved = at.join(steps, "root", "left").observe(seen, F.count("next").alias("moved"))
        at = settle(moved.select("word", F.coalesce("next", "root").alias("root")))
        if not seen.get["moved"]:
            return at


def spelling_variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_length: int = LEAST_LENGTH,
                      least_count: int = LEAST_COUNT, most_shared: int = 20_000) -> DataFrame:
    """Per word of ``docs`` (see ``vocabulary``): word, form, root, n, n_near, form_n (runs jobs).

    ``form`` is the word's near word of the largest n (of equal ones the smallest in code-point order) if that is
    at least twice its own, else NULL. ``root`` is what the forms lead to. ``n_near`` counts the near words. NULL texts
    have no words, a NULL identifier is written as nothing; whole texts of all rows count, repeated rows
    too; only the two named columns are read; a table without words gives no rows.
    """
    words = settle(vocabulary(docs, text, doc_id, least_length, least_count))
    # of equal counts the smallest word: strings compare by their bytes, which is code-point order in UTF-8
    best = near_words(words, least_length, most_shared).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.max("near_n").alias("near_n"),
        F.min_by("near", F.struct(-F.col("near_n"), F.col("near"))).alias("near"))
    made = words.join(best, "word", "left")
    taken = F.col("near_n") >= 2 * F.col("n")
    made = settle(made.select("word", F.when(taken, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                              F.when(taken, F.col("near_n")).alias("form_n")))
    return made.join(rooted(made), "word").select("word", "form", "root", "n", "n_near", "form_n")
