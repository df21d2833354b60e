"""Conversation repair against every sequence of edits, and against plain strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import written
from tidemark.llm.audits import BLANK, CUT, DUPLICATE, FINE, Audits, cheapest, put_together, repair_conversations, repaired, ways
from tidemark.llm.queries import QUERIES, damaged, table

DDL = "conv_id long, turn long, role string, text string, n long, stretch int, place int, `odd name.x` string"


def every_audit(rows):
    """All edit strings up to the cost of deleting everything, whatever roles reroled and inserted messages get."""
    limit, found = 2 * len(rows), []
    gaps = [k for k in range(limit // 5 + 1)]
    for inserts in itertools.product(gaps, repeat=len(rows) + 1):
        if 5 * sum(inserts) > limit:
            continue
        for edits in itertools.product("DKR", repeat=len(rows)):
            cost, audit, choices = 5 * sum(inserts), "", []
            for k, letter in enumerate([*edits, ""]):
                audit += "I" * inserts[k] + letter
                choices += ["ua"] * inserts[k]
                if letter and letter != "D":
                    initial, fault = rows[k]
                    cost += (letter == "R") + 5 * (fault == CUT) + (1000 if fault in (BLANK, DUPLICATE) else 0)
                    choices.append("ua" if letter == "R" else [initial or "-"])
                cost += 2 * (letter == "D")
            if cost <= limit and any(re.fullmatch("(s?(ua)+)?", "".join(c)) for c in itertools.product(*choices)):
                found.append((cost, audit))
    return min(found)


def plain(rows):
    """The same by whole strings, for longer conversations."""
    best = {0: (0, "")}

    def grown(best):
        best = dict(best)
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                new = 3 if state == 2 else 2
                best[new] = min(best.get(new, (10**9, "")), (cost + 5, audit + "I"))
        return best

    for initial, fault in rows:
        after = {}
        for state, (cost, audit) in grown(best).items():
            offers = [(state, cost + 2, "D")]
            if fault not in (BLANK, DUPLICATE):
                extra = 5 * (fault == CUT)
                offers.append((3 if state == 2 else 2, cost + extra + 1, "R"))
                kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((state, initial))
                offers += [(kept, cost + extra, "K")] if kept else []
            for new, total, letter in offers:
                after[new] = min(after.get(new, (10**9, "")), (total, audit + letter))
        best = after
    best = grown(best)
    return min(best[s] for s in (0, 3) if s in best)


def some_rows(rng, n):
    return [(rng.choice("suauax") if rng.random() < 0.95 else "", rng.choice([FINE, FINE, FINE, CUT, BLANK, DUPLICATE]))
            for _ in range(n)]


@pytest.mark.parametrize("seed", range(12))
def test_against_every_audit(seed):
    rng = random.Random(seed)
    for _ in range(12):
        rows = some_rows(rng, rng.randrange(6))
        assert cheapest(rows) == every_audit(rows), rows


def test_against_strings():
    rng = random.Random(7)
    for n in [10, 30, 100, 300]:
        rows = some_rows(rng, n)
        assert cheapest(rows) == plain(rows)
        for size in (1, 7, 64):
            cuts = range(0, n, size)
            solved = [{(s, e): w for s in range(4) for e, w in ways(rows[c:c + size], s, c + size >= n).items()} for c in cuts]
            cost, parts, starts = put_together(solved)
            assert (cost, "".join(parts)) == plain(rows) and len(starts) == len(parts)


@pytest.mark.parametrize("modulus", [Audits.MODULUS, 1, 2, 7])
def test_order_of_audits(modulus):
    """With few hash values nearly all comparisons meet collisions."""
    rng = random.Random(modulus)
    audits, texts = Audits(modulus), [""]
    for _ in range(400):
        node = rng.choice([len(texts) - 1, rng.randrange(len(texts))])
        letter = rng.choice("DIKR" if rng.random() < 0.3 else "K")
        assert audits.add(node, letter) == len(texts)
        texts.append(texts[node] + letter)
    assert [audits.text(k) for k in range(len(texts))] == texts
    for _ in range(4000):
        one, two = rng.randrange(len(texts)), rng.randrange(len(texts))
        assert audits.before(one, two) == (texts[one] < texts[two])


def brute(rows):
    """Results by conv_id of rows (conv_id, turn, role, text, gone)."""
    found = {}
    for conv_id in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv_id and not r[4]),
                     key=lambda r: (r[1] is not None, r[1] or 0, (" " if r[2] is None else r[2]).encode(), (" " if r[3] is None else r[3]).encode()))
        own = [(t, " " if r is None else r, " " if x is None else x) for _, t, r, x, _ in own]
        told, seen = [], set()
        for _, role, text in own:
            body = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = BLANK if not body else DUPLICATE if (role, text) in seen else FINE if body[-1] in ".!?" else CUT
            seen.add((role, text))
            told.append((role[:1], fault))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        faults = [f for _, f in told]
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(told, told[1:]))
        cost, audit = plain(told)
        lines = "\n".join(f"{r}:{t}" for r, t in repaired([(r, t) for _, r, t in own], audit))
        found[conv_id] = (gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, cost, audit,
                          hashlib.sha256(lines.encode()).hexdigest())
    return found


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def results(frame):
    rows = frame.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}


def messages():
    rng = random.Random(3)
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes."), (2, None, None, None), (3, 5, "", ""),
            (None, 1, "user", "a."), (None, None, "assistant", "b."), (4, 1, "user", "same."), (4, 1, "user", "same."),
            (4, 9, "assistant", "x" * 50_000), (5, 3, "tool", "call."), (5, -7, "User", "!"), (6, 1, "user", "é…"), (6, 2, "assistant", "中。")]
    rows += [(10, t, rng.choice(["user", "assistant", "system"]), rng.choice(["one.", "two", "three?", " ", f"{t}."])) for t in range(300)]
    return rows + [(k, rng.choice([t, t, None, 3]), rng.choice(["user", "assistant"]), rng.choice([f"t{t}.", "again.", "cut", None]))
                   for k in range(20, 60) for t in range(rng.randrange(9))]


@pytest.mark.parametrize("long_rows", [4096, 4, 64])
def test_rows(spark, folder, long_rows):
    """Short and long conversations alike, in any layout of the files."""
    rows = messages()
    frame = written(spark, folder, [(*r, 1, 2, 3, "odd") for r in rows], DDL)
    gone = F.col("conv_id").isin(3, 33) | (F.col("turn") == 5)
    told = [(*r, r[0] in (3, 33) or r[1] == 5) for r in rows]
    assert results(repair_conversations(frame, gone=gone, long_rows=long_rows)) == brute(told)


def test_no_rows(spark, folder):
    empty = written(spark, folder, [], DDL)
    assert repair_conversations(empty).count() == 0
    lost = repair_conversations(written(spark, folder, [(1, 2, "user", "a.", 1, 2, 3, "x")] * 3, DDL), gone=F.lit(True), long_rows=2)
    assert results(lost) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = []
    for r in table(spark, sf_dir, "conversations").collect():
        fault = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", r.text) if fault == 2 else r.text
        rows += [(r.conv_id, r.turn, "user" if fault == 4 else r.role, text, fault == 0)] * (2 if fault == 3 else 1)
    frame = QUERIES["op13_audited_conversations"](spark, sf_dir)
    assert dict(frame.dtypes) == {"conv_id": "bigint", **{c: "bigint" for c in COLUMNS[:6]}, "audit": "string", "repaired_sha256": "string"}
    assert results(frame) == brute(rows)


def test_damage_of_nulls(spark, folder):
    rows = [(k, t, None, None, 1, 2, 3, "x") for k in [None, *range(40)] for t in (None, 1)]
    found = damaged(written(spark, folder, rows, DDL)).collect()
    faults = {(k, t): zlib.crc32(f"{' ' if k is None else k}:{' ' if t is None else t}".encode()) % 20 for k, t, *_ in rows}
    expected = [(k, t, "user" if f == 4 else " ", "" if f == 1 else " ", f == 0) for (k, t), f in faults.items() for _ in range(1 + (f == 3))]
    assert sorted(map(str, [tuple(r)[:5] for r in found])) == sorted(map(str, expected))
