"""Conversation structure repair by a persistent audit DP.

The cheapest edits that give a conversation the form system?, then user and assistant in turn, are found row
by row over the automaton of that form. An audit is the string of the edits' letters: D(elete), I(nsert),
K(eep), R(erole). Given the rows it fixes the repaired conversation, since the automaton's state decides
which role an inserted or reroled message has. Audits share their prefixes as linked nodes; a node knows its
ancestors 1, 2, 4, ... letters back and a rolling hash of its whole string. Of equally cheap audits the least is
found by a search for the longest common prefix along these ancestors; that the prefixes are equal
is then verified letter by letter, down to the first node that is shared or verified already.

Two audits that reach one state behind one row at one cost are never prefixes of each other (the longer would
hold further insertions, which cost), so the least prefix also gives the least whole audit. For the
same reason stretches of a conversation can be solved on their own, from each state to each state, and put
together: a conversation beyond ``long_rows`` rows is cut into such stretches and fills many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import Batches, give_back, in_batches
from tidemark.operators.joins import lookup_join
from tidemark.operators.positions import with_position
from tidemark.session import settle_sized

BROADCAST_BYTES = 16 << 20
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs; keeping is free
FINE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3  # faults

# states: at the start, behind the system message, behind a user's, behind an assistant's
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}  # by a reroled or inserted message
FINAL = (START, ASSISTANT)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}

_BLANKS = " \t\n\x0b\x0c\r"

Row = tuple[str, int]  # initial of the role, fault


class Audits:
    """Strings that share prefixes: a node is a string, linked to the string without its last letter."""

    MODULUS = (1 << 61) - 1
    BASE = 1_000_003

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[]]  # ancestors 1, 2, 4, ... letters back
        self.known = [0]  # a node of an equal string, verified

    def add(self, node: int, letter: str) -> int:
        up = [node]
        while len(self.up[up[-1]]) >= len(up):
            up.append(self.up[up[-1]][len(up) - 1])
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * self.BASE + ord(letter)) % self.modulus)
        self.up.append(up)
        self.known.append(len(self.known))
        return len(self.letter) - 1

    def lifted(self, node: int, depth: int) -> int:
        """The string's prefix of the given length."""
        while (steps := self.depth[node] - depth) > 0:
            node = self.up[node][steps.bit_length() - 1]
        return node

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def _known(self, node: int) -> int:
        while self.known[node] != node:
            self.known[node] = node = self.known[self.known[node]]
        return node

    def same(self, one: int, two: int) -> bool:
        """Whether two strings of one length are equal, letter by letter as far as that is not known."""
        passed = []
        while (a := self._known(one)) != (b := self._known(two)):
            if self.letter[one] != self.letter[two]:
                return False
            passed.append((a, b))
            one, two = self.up[one][0], self.up[two][0]
        for a, b in passed:
            a, b = self._known(a), self._known(b)
            self.known[max(a, b)] = min(a, b)
        return True

    def before(self, one: int, two: int) -> bool:
        """Whether a string comes before another in ASCII order."""
        if one == two:
            return False
        least = min(self.depth[one], self.depth[two])
        a, b = self.lifted(one, least), self.lifted(two, least)
        if self.hash[a] == self.hash[b]:
            if self.same(a, b):
                return self.depth[one] < self.depth[two]
        else:
            # the shortest prefixes whose hashes differ; both nodes have ancestors at the same distances
            for k in reversed(range(len(self.up[a]))):
                if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                    a, b = self.up[a][k], self.up[b][k]
            if self.same(self.up[a][0], self.up[b][0]):
                return self.letter[a] < self.letter[b]
        return self.text(one) < self.text(two)  # two strings share a hash


Best = dict[int, tuple[int, int]]  # state: cost and audit of the cheapest, then least, way to it


def _offer(audits: Audits, best: Best, state: int, cost: int, node: int, letter: str) -> bool:
    held = best.get(state)
    if held is not None and held[0] < cost:
        return False
    new = audits.add(node, letter)
    if held is not None and held[0] == cost and not audits.before(new, held[1]):
        return False
    best[state] = (cost, new)
    return True


def _with_insertions(audits: Audits, best: Best) -> Best:
    """Insertions as far as they pay."""
    best = dict(best)
    waiting = sorted(best)
    while waiting:
        state = waiting.pop(0)
        cost, node = best[state]
        if _offer(audits, best, NEXT[state], cost + INSERT, node, "I"):
            waiting.append(NEXT[state])
    return best


def _step(audits: Audits, best: Best, initial: str, fault: int) -> Best:
    """One row further."""
    after: Best = {}
    for state, (cost, node) in sorted(_with_insertions(audits, best).items()):
        _offer(audits, after, state, cost + DELETE, node, "D")
        if fault in (BLANK, DUPLICATE):
            continue
        cost += TRUNCATED if fault == CUT else 0
        if (state, initial) in KEEP:
            _offer(audits, after, KEEP[state, initial], cost, node, "K")
        _offer(audits, after, NEXT[state], cost + REROLE, node, "R")
    return after


Way = tuple[int, str]  # cost and letters


def ways(rows: Iterable[Row], start: int, last: bool) -> dict[int, Way]:
    """From one state to each, the cheapest and then least audit of a stretch of rows, with insertions before
    each row and, if it is the ``last`` stretch, behind it."""
    audits = Audits()
    best: Best = {start: (0, 0)}
    for initial, fault in rows:
        best = _step(audits, best, initial, fault)
    if last:
        best = _with_insertions(audits, best)
    return {state: (cost, audits.text(node)) for state, (cost, node) in best.items()}


def cheapest(rows: Iterable[Row]) -> Way:
    """The cheapest audit of a whole conversation, of equally cheap ones the least."""
    found = ways(rows, START, True)
    return min(found[s] for s in FINAL if s in found)


def put_together(stretches: Iterable[dict[tuple[int, int], Way]]) -> tuple[int, list[str], list[int]]:
    """The cheapest, then least audit over stretches solved on their own: its cost, each stretch's letters and the state
    before it."""
    best: dict[int, tuple[int, str, tuple | None]] = {START: (0, "", None)}
    for solved in stretches:
        after: dict[int, tuple[int, str, tuple | None]] = {}
        for (begin, end), (cost, letters) in sorted(solved.items()):
            if begin in best:
                before = best[begin]
                way = (before[0] + cost, before[1] + letters)
                if end not in after or way < after[end][:2]:
                    after[end] = (*way, (letters, begin, before[2]))
        best = after
    cost, _, link = min((best[s] for s in FINAL if s in best), key=itemgetter(0, 1))
    parts, starts = [], []
    while link is not None:
        letters, begin, link = link
        parts.append(letters)
        starts.append(begin)
    return cost, parts[::-1], starts[::-1]


def repaired(rows: Iterable[tuple[str, str]], audit: str, state: int = START) -> Iterator[tuple[str, str]]:
    """Role and text of what an audit makes of the rows."""
    left = iter(rows)
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            yield _ROLE[state], ""
            continue
        role, text = next(left)
        if letter == "K":
            state = KEEP[state, role[:1]]
            yield role, text
        elif letter == "R":
            state = NEXT[state]
            yield _ROLE[state], text


def own_fault(text: str) -> int:
    """A row's fault as far as it alone tells."""
    last = text.rstrip(_BLANKS)[-1:]
    return BLANK if not last else FINE if last in ".!?" else CUT


class Tally:
    """What is counted over a conversation's rows in order."""

    def __init__(self):
        self.turns: tuple[int, int, int] | None = None  # least, greatest, distinct
        self.latest, self.initial = None, None
        self.faults = [0, 0, 0, 0]
        self.illegal = 0

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        self.faults[fault] += 1
        if self.initial is not None:
            self.illegal += self.initial + initial not in _LEGAL
        self.initial = initial
        if turn is not None and (self.turns is None or turn != self.turns[1]):
            low, _, n = self.turns or (turn, turn, 0)
            self.turns = (low, turn, n + 1)

    def counts(self) -> tuple[int, int, int, int, int]:
        """gaps, blank, duplicate, truncated, illegal."""
        gaps = min(self.turns[1] - self.turns[0] + 1 - self.turns[2], (1 << 63) - 1) if self.turns else 0
        return gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT], self.illegal


# fields of the rows in tasks
_CONV, _TURN, _ROLE_AT, _TEXT, _GONE = range(5)
_DONE = [("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
         ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
         ("repaired_sha256", pa.string())]
_MESSAGE = pa.struct([("role", pa.string()), ("text", pa.string())])
_SHORT = pa.schema([*_DONE, ("messages", pa.list_(_MESSAGE))])
_LONG = pa.schema(_DONE)
_DONE_DDL = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
             "repaired_sha256 string")
_SHORT_DDL = f"{_DONE_DDL}, messages array<struct<role:string,text:string>>"


def _rows(batches: Batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def mended(conv_id: int | None, rows: Sequence[tuple]) -> tuple:
    """The result of one conversation whose rows (see ``_CONV`` and on) come in order."""
    rows = [r for r in rows if not r[_GONE]]
    seen: set[tuple[str, str]] = set()
    told: list[Row] = []
    tally = Tally()
    for row in rows:
        fault = own_fault(row[_TEXT])
        key = (row[_ROLE_AT], row[_TEXT])
        if fault != BLANK and key in seen:
            fault = DUPLICATE
        seen.add(key)
        told.append((row[_ROLE_AT][:1], fault))
        tally.add(row[_TURN], *told[-1])
    cost, audit = cheapest(told)
    messages = list(repaired(((r[_ROLE_AT], r[_TEXT]) for r in rows), audit))
    digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in messages).encode()).hexdigest()
    return (conv_id, *tally.counts(), cost, audit, digest, [{"role": r, "text": t} for r, t in messages])


def _mend(batches: Batches) -> Batches:
    done = (mended(conv_id, list(rows)) for conv_id, rows in groupby(_rows(batches), itemgetter(_CONV)))
    yield from in_batches(done, _SHORT, lambda row: sum(len(m["text"]) for m in row[9]))
    give_back()


# long conversations ------------------------------------------------------------------------------

_SOLVED = pa.schema([("conv_id", pa.int64()), ("stretch", pa.int64()), ("begin", pa.int32()), ("end", pa.int32()),
                     ("cost", pa.int64()), ("letters", pa.string())])


def _solve(batches: Batches) -> Batches:
    """Per stretch, from each state to each; rows are conv_id, stretch, initial, fault, last."""

    def rows() -> Iterator[tuple]:
        for (conv_id, stretch), held in groupby(_rows(batches), itemgetter(0, 1)):
            told = [(initial, fault, last) for _, _, initial, fault, last in held]
            for begin in range(4):
                for end, way in ways(((i, f) for i, f, _ in told), begin, told[-1][2]).items():
                    yield (conv_id, stretch, begin, end, *way)

    yield from in_batches(rows(), _SOLVED, lambda row: len(row[5]))
    give_back()


_PART = pa.schema([("conv_id", pa.int64()), ("stretch", pa.int64()), ("begin", pa.int32()), ("cost", pa.int64()), ("letters", pa.string())])


def _join_up(batches: Batches) -> Batches:
    """Per conversation the letters of each stretch; the rows come by conversation and stretch."""

    def rows() -> Iterator[tuple]:
        for conv_id, held in groupby(_rows(batches), itemgetter(0)):
            solved = ({(r[2], r[3]): (r[4], r[5]) for r in part} for _, part in groupby(held, itemgetter(1)))
            cost, parts, starts = put_together(solved)
            for stretch, (letters, begin) in enumerate(zip(parts, starts)):
                yield conv_id, stretch, begin, cost, letters

    yield from in_batches(rows(), _PART, lambda row: len(row[4]))


def _finish(batches: Batches) -> Batches:
    """The result of a long conversation, hashed as its repaired rows pass by. Of each stretch its letters come
    first (``letters`` is not NULL), then its rows: conv_id, stretch, turn, role, text, fault, begin, cost, letters."""

    def rows() -> Iterator[tuple]:
        for conv_id, held in groupby(_rows(batches), itemgetter(0)):
            tally, digest, audit, cost, first = Tally(), hashlib.sha256(), [], 0, True
            for _, part in groupby(held, itemgetter(1)):
                _, _, _, _, _, _, begin, cost, letters = next(part)
                audit.append(letters)

                def passing(part=part) -> Iterator[tuple[str, str]]:
                    for row in part:
                        tally.add(row[2], row[3][:1], row[5])
                        yield row[3], row[4]

                for role, text in repaired(passing(), letters, begin):
                    digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            yield (conv_id, *tally.counts(), cost, "".join(audit), digest.hexdigest())

    yield from in_batches(rows(), _LONG, lambda row: len(row[7]))
    give_back()


def _mend_long(rows: DataFrame, stretch_rows: int) -> DataFrame:
    """``_DONE`` of conversations that are cut into stretches (runs jobs)."""
    placed = with_position(rows.where("NOT gone"), ["conv_id"], ["turn", "role", "text"], "place", length="rows")
    # faults: what a row alone tells, and whether its role and text came before
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    placed = placed.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    firsts = placed.groupBy("conv_id", "role", "digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    told = lookup_join(placed, firsts.where("n > 1").drop("n"), ["conv_id", "role", "digest"])
    told = told.select(
        "conv_id", F.expr(f"place div {stretch_rows}").alias("stretch"), "place", "turn", "role", "text",
        F.when(blank, BLANK).when(F.col("place") > F.col("first"), DUPLICATE).when(ended, FINE).otherwise(CUT).alias("fault"),
        (F.col("place") == F.col("rows") - 1).alias("last"))
    solved = told.select("conv_id", "stretch", "place", F.substring("role", 1, 1).alias("initial"), "fault", "last").repartition(
        "conv_id", "stretch").sortWithinPartitions("conv_id", "stretch", "place").select(
        "conv_id", "stretch", "initial", "fault", "last").mapInArrow(
        _solve, "conv_id long, stretch long, begin int, end int, cost long, letters string")
    parts, _ = settle_sized(solved.repartition("conv_id").sortWithinPartitions("conv_id", "stretch").mapInArrow(
        _join_up, "conv_id long, stretch long, begin int, cost long, letters string"))
    none = F.lit(None)
    heads = parts.select("conv_id", "stretch", F.lit(-1).cast("long").alias("place"), none.cast("long").alias("turn"),
                         none.cast("string").alias("role"), none.cast("string").alias("text"), none.cast("int").alias("fault"),
                         "begin", "cost", "letters")
    bodies = told.select("conv_id", "stretch", "place", "turn", "role", "text", "fault", none.cast("int").alias("begin"),
                         none.cast("long").alias("cost"), none.cast("string").alias("letters"))
    streamed = heads.unionByName(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "stretch", "place").drop("place")
    return streamed.mapInArrow(_finish, _DONE_DDL)


def _mend_short(marked: DataFrame) -> DataFrame:
    """Whole conversations, one after another in their task."""
    ordered = marked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_mend, _SHORT_DDL)


def repair_conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         gone: Column | None = None, long_rows: int = 4096, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 and the
    repaired ``messages`` (runs jobs).

    Rows count in the order of their turn (NULL first), then role and text. A row's first fault counts: blank,
    duplicate (role and text seen earlier in the conversation), truncated (its last character is none of
    ``.!?``). Keeping a row is free, giving it the role user or assistant costs 1, deleting it 2, inserting an empty
    message of a user or assistant 5, a truncated row that stays 5; blank and duplicate rows must go. The
    cheapest edits that leave the form system?, (user, assistant)+ or nothing are the ``audit``. Roles are told by their first
    letter; a role without one fits nowhere.

    ``gone`` marks rows that do not count; a conversation with no other rows has zeros, an empty audit
    and the hash of an empty string. NULL roles and texts count as one blank; rows with a NULL conv_id are
    one conversation; only the four named columns are read; an empty table gives no rows. ``gaps`` ends at the
    greatest long. Conversations of more than ``long_rows`` rows are solved in stretches of as many rows; only their
    hash, and with it their counts, passes through one task, a row at a time. Their ``messages`` are NULL.
    """
    marked = rows.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))],
        F.coalesce(gone if gone is not None else F.lit(False), F.lit(False)).alias("gone"))
    counts = marked.groupBy("conv_id").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > long_rows)
    listed, size = settle_sized(counts.select(F.col("conv_id").alias("listed")))
    if listed.isEmpty():
        return _mend_short(marked)
    listed = F.broadcast(listed) if size <= broadcast_bytes else listed
    met = F.col("conv_id").eqNullSafe(F.col("listed"))
    long = marked.join(listed, met, "left_semi")
    whole = _mend_long(long, long_rows)
    # a long conversation may have lost all its rows
    lost = long.groupBy("conv_id").agg(F.min("gone").alias("gone")).where("gone").select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), "gone")
    short = _mend_short(marked.join(listed, met, "left_anti").unionByName(lost))
    return short.unionByName(whole.withColumn("messages", F.lit(None).cast(short.schema["messages"].dataType)))
