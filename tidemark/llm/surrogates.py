"""Personal data replaced by surrogates.

Detected entities get keyed replacements of the same type and format: digits stay digits, letters keep
case, class and script, given names stay in their gender and script, card numbers keep their check
digit. A surrogate depends on the key, the type and the entity's normal form alone, so an entity is
replaced alike everywhere. It is drawn by a keyed permutation of all values of its format; a check over
the distinct entities of all documents finds surrogates that two entities share or that are some real
entity, and draws those again until none is left. After ``SAME_FORMAT`` draws the format counts as full and
surrogates get longer with each further draw, so that there is always one left.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import Batches, give_back, identified, in_batches, in_slices, text_of
from tidemark.session import settle, settle_sized

BROADCAST_BYTES = 16 << 20
SAME_FORMAT = 8  # draws that keep an entity's format

# Given names by script and gender
GIVEN = {
    ("latin", "f"): "Alice Anna Barbara Clara Elena Emily Emma Eva Hannah Helen Ines Isabel Julia Laura Linda Lucia Maria Marie Mary Nina Olivia Patricia Paula Rosa Sarah Sofia Susan Teresa".split(),
    ("latin", "m"): "Adam Albert Andrew Anthony Carlos Charles Daniel David Edward Felix Frank George Hans Henry Jack James John Joseph Juan Karl Louis Martin Michael Paul Peter Pierre Robert Thomas William".split(),
    ("cyrillic", "f"): "Анна Вера Елена Ирина Мария Наталья Ольга Татьяна".split(),
    ("cyrillic", "m"): "Алексей Андрей Дмитрий Иван Михаил Николай Сергей Юрий".split(),
    ("greek", "f"): "Αθηνά Ελένη Ιωάννα Μαρία Σοφία".split(),
    ("greek", "m"): "Ανδρέας Γιώργος Δημήτρης Κώστας Νίκος".split(),
}
# Titles that announce a surname
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Señor Señora".split()
_SEX_OF = {name: (script, sex) for (script, sex), names in GIVEN.items() for name in names}

_EMAIL = re.compile(r"(?<![\w.+%-])[\w%+-]+(?:\.[\w%+-]+)*@[^\W_](?:[^\W_]|-)*(?:\.(?:[^\W_]|-)+)*\.[^\W\d_]{2,}")
_IP = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)")
_IP6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:|::)[0-9A-Fa-f:]*:[0-9A-Fa-f]{0,4}(?![\w:])")
_PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}"
                    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?![\w-])")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_CARD = re.compile(r"(?<![\w+-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{4,5})(?![\w-])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_ACCESS = re.compile(r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)")
_SECRET = re.compile(r"""(?i:(?<![^\W_])(?:password|passwd|pwd|secret|token|(?:api|access|secret|private)[_-]?key)["']?\s*[:=]\s*["']?)(?=[_+/=.-]*[A-Za-z0-9])([A-Za-z0-9_+/=.-]{8,})""")
_SECRET_HINTS = ("pass", "pwd", "secret", "token", "key")
_TITLED = re.compile(r"\b(?:" + "|".join(TITLES) + r")\.? ((?:[^\W\d_a-z]\w+ )?[^\W\d_a-z][^\W\d_]+)")
_NAMED = re.compile(r"\b(" + "|".join(sorted(_SEX_OF, key=len, reverse=True)) + r")((?: [^\W\d_a-zа-яά-ώß-ÿ][^\W\d_]+)+)")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _card_like(digits: str) -> bool:
    return luhn(digits) or len(digits) in (15, 16) and digits[0] in "3456"


def _ip6_like(text: str) -> str | None:
    """The address in full, if it has all groups, or three and a digit: a::b may be anything."""
    groups = [g for g in text.split(":") if g]
    if "::" in text and (len(groups) < 3 or not re.search(r"\d", text)):
        return None
    try:
        return ipaddress.IPv6Address(text).exploded
    except ValueError:
        return None


def _iban_like(text: str) -> bool:
    moved = text[4:] + text[:4]
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def found_entities(text: str) -> list[tuple[int, int, str, str]]:
    """Start, end, kind and normal form of the entities, in order and apart; of overlapping ones the kind
    tried first stays. A name that was found is found wherever else the text has it as a word."""
    found: list[tuple[int, int, str, str]] = []
    starts: list[int] = []  # of the entities so far, in order, and their ends
    ends: list[int] = []

    def keep(start: int, end: int, kind: str, value: str) -> None:
        at = bisect_right(starts, start)
        if (at == 0 or ends[at - 1] <= start) and (at == len(starts) or starts[at] >= end):
            starts.insert(at, start)
            ends.insert(at, end)
            found.append((start, end, kind, value))

    folded = text.casefold()  # lower() would keep the long s, which the regex takes as an s
    if any(h in folded for h in _SECRET_HINTS):
        for m in _SECRET.finditer(text):
            keep(*m.span(1), "secret", m[1])
    if "AKIA" in text or "ASIA" in text:
        for m in _ACCESS.finditer(text):
            keep(*m.span(), "access_key", m[0])
    if "@" in text:
        for m in _EMAIL.finditer(text):
            keep(*m.span(), "email", m[0].lower())
    if re.search(r"\d[\d. )(-]{4}", text):
        for m in _IBAN.finditer(text):
            if _iban_like(value := m[0].replace(" ", "")):
                keep(*m.span(), "iban", value)
        for m in _IP.finditer(text):
            if all(int(p) < 256 for p in m[0].split(".")):
                keep(*m.span(), "ip", ".".join(str(int(p)) for p in m[0].split(".")))
        for m in _SSN.finditer(text):
            keep(*m.span(), "ssn", m[0].replace("-", ""))
        for m in _CARD.finditer(text):
            if _card_like(value := re.sub(r"\D", "", m[0])):
                keep(*m.span(), "card", value)
        for m in _PHONE.finditer(text):
            value = re.sub(r"\D", "", m[0])
            if 10 <= len(value) <= 15:
                keep(*m.span(), "phone", value)
    if text.count(":") > 1:
        for m in _IP6.finditer(text):
            if value := _ip6_like(m[0]):
                keep(*m.span(), "ip6", value)
    others = len(found)
    if any(name in text for name in _SEX_OF):
        for m in _NAMED.finditer(text):
            script, sex = _SEX_OF[m[1]]
            keep(*m.span(1), f"given_{script}_{sex}", m[1])
            _keep_words(m.start(2), m[2], keep)
    if any(title in text for title in TITLES):
        for m in _TITLED.finditer(text):
            _keep_words(m.start(1), m[1], keep)
    if len(found) > others:
        # the same person, by the first or last name alone
        names = {text[start:end] for start, end, _, _ in found[others:]}
        for m in re.finditer(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + r")(?!\w)", text):
            _keep_words(m.start(), m[0], keep)
    return sorted(found)


def _keep_words(start: int, words: str, keep) -> None:
    for word in re.finditer(r"\S+", words):
        if word[0] in _SEX_OF:
            script, sex = _SEX_OF[word[0]]
            keep(start + word.start(), start + word.end(), f"given_{script}_{sex}", word[0])
        else:
            keep(start + word.start(), start + word.end(), "surname", word[0].lower())


def permuted(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of range(size): a Feistel network, walked until the value is in range."""
    if size < 2:
        return value
    half = ((size - 1).bit_length() + 1) // 2
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for step in range(8):
            seed = f"{tweak}|{step}|{right}".encode()
            round_bytes = hashlib.blake2b(seed, key=key, digest_size=min(64, half // 8 + 1)).digest()
            while len(round_bytes) * 8 < half:
                round_bytes += hashlib.blake2b(round_bytes, key=key).digest()
            left, right = right, left ^ (int.from_bytes(round_bytes, "big") & mask)
        value = left << half | right
        if value < size:
            return value


# Alphabets whose letters stand for each other
_ALPHABETS = ["0123456789", "aeiouy", "bcdfghjklmnpqrstvwxz", "AEIOUY", "BCDFGHJKLMNPQRSTVWXZ", "аеиоуыэюя",
              "бвгджзйклмнпрстфхцчшщ", "АЕИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ", "αεηιουω", "βγδζθκλμνξπρστφχψ",
              "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ", "àáâäãåèéêëìíîïòóôöõùúûüý", "çñß"]
_HEX = "0123456789abcdef"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ALPHABET_OF = {c: a for a in _ALPHABETS for c in a}


@cache
def alphabet_of(c: str) -> str:
    """The characters that may stand for one: its class of letters, or for a letter or digit of no class here those of its
    kind among the 256 code points around it. Signs stay."""
    if c in _ALPHABET_OF or not c.isalnum():
        return _ALPHABET_OF.get(c, c)
    start, kind = ord(c) & ~0xFF, unicodedata.category(c)
    return "".join(chr(k) for k in range(start, start + 256) if unicodedata.category(chr(k)) == kind)


def reshaped(text: str, key: bytes, tweak: str, alphabets: list[str] | None = None, longer: int = 0) -> str:
    """Another text of the same shape: every character stays in its alphabet, others stay as they are. Texts
    of one shape are permuted, so different ones stay different. ``longer`` repeats the last alphabet that has a choice
    so many times, or small letters where none has."""
    alphabets = list(alphabets or map(alphabet_of, text))
    if longer:
        last = next((a for a in reversed(alphabets) if len(a) > 1), _ALPHABETS[2])
        text, alphabets = text + last[0] * longer, alphabets + [last] * longer
    value, size = 0, 1
    for c, alphabet in zip(text, alphabets):
        value, size = value * len(alphabet) + alphabet.index(c), size * len(alphabet)
    value = permuted(value, size, key, f"{tweak}|{len(text)}|{hashlib.blake2b(repr(alphabets).encode(), digest_size=8).hexdigest()}")
    out = []
    for alphabet in reversed(alphabets):
        value, digit = divmod(value, len(alphabet))
        out.append(alphabet[digit])
    return "".join(reversed(out))


@cache
def _renamed(script: str, sex: str, key: bytes) -> dict[str, str]:
    """The listed names of a script and sex, dealt anew so that none keeps its own."""
    names = GIVEN[script, sex]
    deal = 0
    while True:
        new = [names[permuted(k, len(names), key, f"given_{script}_{sex}|{deal}")] for k in range(len(names))]
        if all(a != b for a, b in zip(names, new)):
            return dict(zip(names, new))
        deal += 1


def surrogate(kind: str, value: str, key: bytes, attempt: int = 0) -> str:
    """The replacement of an entity's normal form."""
    if kind.startswith("given_"):
        return _renamed(*kind.split("_")[1:], key)[value]
    tweak, longer = f"{kind}|{attempt}", max(0, attempt + 1 - SAME_FORMAT)
    if kind == "email":
        name, _, domain = value.partition("@")
        host, _, top = domain.rpartition(".")
        # the host's letters move, and a reserved name below it keeps mail from reaching anyone
        return (f"{reshaped(name, key, tweak, longer=longer)}@{reshaped(host, key, 'host')}"
                f".example.{top if top in ('com', 'net', 'org') else 'com'}")
    if kind == "ip" and not longer:
        number = int.from_bytes(bytes(map(int, value.split("."))), "big")
        return ".".join(map(str, permuted(number, 1 << 32, key, tweak).to_bytes(4, "big")))
    if kind in ("ip", "ip6"):
        number = int(ipaddress.ip_address(value))
        return ipaddress.IPv6Address(permuted(number, 1 << 128, key, tweak)).exploded
    if kind == "card":
        body = value[0] + reshaped(value[1:-1], key, tweak, longer=longer)
        if luhn(value):
            return next(body + d for d in _ALPHABETS[0] if luhn(body + d))
        wrong, wrong_new = ([d for d in _ALPHABETS[0] if not luhn(b + d)] for b in (value[:-1], body))
        return body + wrong_new[permuted(wrong.index(value[-1]), 9, key, f"{tweak}|{body}")]
    if kind == "iban":
        body = reshaped(value[4:], key, tweak, [_ALPHABETS[0] if c.isdigit() else _UPPER for c in value[4:]], longer)
        rest = int("".join(str(int(c, 36)) for c in body + value[:2] + "00")) % 97
        return f"{value[:2]}{98 - rest:02d}{body}"
    if kind == "access_key":
        return value[:4] + reshaped(value[4:], key, tweak, [_UPPER + _ALPHABETS[0]] * (len(value) - 4), longer)
    if kind == "secret" and set(value) <= set(_HEX):
        return reshaped(value, key, tweak, [_HEX] * len(value), longer)
    if kind == "phone" and len(value) > 10:
        return value[:-10] + reshaped(value[-10:], key, tweak, longer=longer)
    return reshaped(value, key, tweak, longer=longer)


def rendered(original: str, kind: str, replacement: str) -> str:
    """The replacement in the layout of this mention."""
    if kind in ("phone", "ssn", "card", "iban"):
        places = iter(replacement)
        return "".join(next(places) if c.isalnum() else c for c in original) + "".join(places)
    if kind == "surname":
        return replacement.upper() if original.isupper() else replacement[:1].upper() + replacement[1:]
    if kind == "email" and original.isupper():
        return replacement.upper()
    return replacement


def replace_entities(text: str, key: bytes, attempts: dict | None = None) -> tuple[str, list[dict]]:
    """The text with surrogates, and what was replaced: kind, start and end in the new text, replacement."""
    pieces, spans, at, length = [], [], 0, 0
    for start, end, kind, value in found_entities(text):
        attempt = (attempts or {}).get(f"{kind}|{value}", 0)
        new = rendered(text[start:end], kind, surrogate(kind, value, key, attempt))
        pieces += [text[at:start], new]
        length += start - at
        spans.append({"kind": kind, "start": length, "end": length + len(new), "replacement": new})
        length += len(new)
        at = end
    pieces.append(text[at:])
    return "".join(pieces), spans


_ENTITY = pa.schema([("kind", pa.string()), ("value", pa.string())])


def _detect(batches: Batches) -> Batches:
    """The distinct entities of each stretch of rows."""

    def rows() -> Iterator[tuple]:
        seen: set[tuple[str, str]] = set()
        for batch in in_slices(batches):
            for text in batch.column(0).to_pylist():
                seen.update((kind, value) for _, _, kind, value in found_entities(text))
            if len(seen) > 100_000:
                yield from seen
                seen = set()
        yield from seen

    yield from in_batches(rows(), _ENTITY)
    give_back()


_DRAWN_DDL = "kind string, value string, attempt int, surrogate string"
_DRAWN = pa.schema([("kind", pa.string()), ("value", pa.string()), ("attempt", pa.int32()), ("surrogate", pa.string())])


def _draw(key: bytes):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            kinds, values, attempts = (batch.column(c).to_pylist() for c in ("kind", "value", "attempt"))
            drawn = [surrogate(k, v, key, a) for k, v, a in zip(kinds, values, attempts)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((kinds, values, attempts, drawn), _DRAWN)],
                                             schema=_DRAWN)

    return run


def redrawn(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, value, attempt of the entities whose first surrogate would be taken (runs jobs).

    A surrogate is taken if it is an entity of the documents itself or that of another entity; of
    entities that share one the smallest keeps it. Given names are dealt so that they stay apart and none
    keeps its own, and their list is short, so every name of it may occur. All counting is by key, on the
    executors. The rounds end: a share of each round's draws is free, and from some draw on there are ever more.
    """
    entities = entities.where(~F.col("kind").startswith("given_"))
    drawn = settle(entities.select("kind", "value", F.lit(0).alias("attempt")).mapInArrow(_draw(key), _DRAWN_DDL))
    real = entities.select("kind", F.col("value").alias("surrogate"))
    while True:
        holders = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("first"), F.count(F.lit(1)).alias("n"))
        shared = drawn.join(holders.where("n > 1"), ["kind", "surrogate"]).where("value != first").select("kind", "value")
        taken = drawn.join(real, ["kind", "surrogate"], "left_semi").select("kind", "value")
        again = settle(shared.union(taken).distinct())
        if again.isEmpty():
            return drawn.where("attempt > 0").select("kind", "value", "attempt")
        lost = drawn.join(again, ["kind", "value"], "left_semi").select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        drawn = settle(drawn.join(again, ["kind", "value"], "left_anti").unionByName(lost.mapInArrow(_draw(key), _DRAWN_DDL)))


_LISTED = pa.schema([("uid", pa.int64()), ("kind", pa.string()), ("value", pa.string())])


def _list(batches: Batches) -> Batches:
    for batch in in_slices(batches):
        rows = ((uid, kind, value) for uid, text in zip(*(c.to_pylist() for c in batch.columns))
                for kind, value in {(kind, value) for _, _, kind, value in found_entities(text)})
        yield from in_batches(rows, _LISTED)


_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                    T.StructField("end", T.IntegerType()), T.StructField("replacement", T.StringType())]))


def _replace(key: bytes, place: int, spans: bool, shared):
    def run(batches: Batches) -> Batches:
        for batch in in_slices(batches):
            names = batch.schema.names
            own = batch.column(len(names) - 1).to_pylist() if shared is None else None
            done = [("", []) if t is None else replace_entities(t, key, shared.value if shared else dict(own[k] or ()))
                    for k, t in enumerate(batch.column(place).to_pylist())]
            null = batch.column(place).is_null().to_pylist()
            columns = list(batch.columns)[:len(names) - (shared is None)]
            columns[place] = pa.array([None if n else t for n, (t, _) in zip(null, done)], pa.string())
            fields = names[:len(columns)]
            if spans:
                columns.append(pa.array([s for _, s in done], pa.list_(pa.struct(
                    [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("replacement", pa.string())]))))
                fields = [*fields, "spans"]
            yield pa.RecordBatch.from_arrays(columns, names=fields)
        give_back()

    return run


def with_surrogates(docs: DataFrame, key: str, text: str = "text", spans: str | None = None,
                    broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with the personal data of ``text`` replaced (runs jobs); all rows and columns stay.

    ``spans`` names an extra column that lists kind, start, end (in the new text) and replacement. Kinds:
    email, ip, ip6, phone, ssn, card, iban, access_key, secret, names after a listed given name or title (and the same
    names elsewhere in the text). A
    NULL text stays NULL, an empty one empty; repeated rows are replaced alike; whole texts are read.
    The entities that had to be drawn again reach the rows as a broadcast up to ``broadcast_bytes``;
    beyond, as a lookup of each row's own entities, joined by row number.
    """
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()
    body = docs.select(text_of(text).alias("body"))
    entities = settle(body.mapInArrow(_detect, "kind string, value string").distinct())
    exceptions, size = settle_sized(redrawn(entities, secret))
    place = docs.columns.index(text)
    # plain names on the way: any name, with a dot or given twice, is safe then
    rows = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    names = [*docs.columns, *([spans] if spans is not None else [])]
    out = T.StructType([T.StructField(c, f.dataType) for c, f in zip(rows.columns, docs.schema.fields)])
    if spans is not None:
        out = out.add("spans", _SPANS)
    if size <= broadcast_bytes:
        found = {f"{r['kind']}|{r['value']}": r["attempt"] for r in exceptions.collect()}
        shared = docs.sparkSession.sparkContext.broadcast(found)
        return rows.mapInArrow(_replace(secret, place, spans is not None, shared), out).toDF(*names)
    marked = identified(rows)
    listed = marked.select("uid", F.coalesce(F.col(f"c{place}"), F.lit("")).alias("body")).mapInArrow(
        _list, "uid long, kind string, value string")
    by_row = listed.join(exceptions, ["kind", "value"]).groupBy("uid").agg(F.map_from_entries(F.collect_list(
        F.struct(F.concat_ws("|", "kind", "value"), "attempt"))).alias("own"))
    joined = marked.join(by_row, "uid", "left").select(*rows.columns, "own")
    return joined.mapInArrow(_replace(secret, place, spans is not None, None), out).toDF(*names)
