"""Main text by equivalence-class template deduction.

A page is a sequence of tokens: tags, told apart by the containers they stand in, and blocks of text.
Tokens of one host that have the same occurrence vector, so that every page has each of them equally
often, form an equivalence class. Classes of at least two tokens whose tokens always come in the same
order are valid; nested by the slots they occur in, they are the host's template. What stands in the
slots is the data; the slots of the article are its text.

Vectors are never gathered. A vector's fingerprint is a sum over the pages, count times a hash of the page,
so that it combines before the shuffle and a host of any size is a few rows per task.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Batches, in_batches, numbered, text_of
from tidemark.session import settle, settle_sized

BROADCAST_BYTES = 16 << 20
LEAST_SHARE = 0.1  # of a host's pages that a template token must occur in
LEAST_MAIN = 0.25  # of a page's text that its article must hold, else the page counts as one without
SAME_TEXT_PAGES = 5  # a text outside the article is template only on a host with so many different pages

# What HTML says about its elements
_RAW = ("script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "textarea", "title", "select",
        "annotation", "annotation-xml")
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
              "span strike strong sub sup time tt u var wbr img "
              "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
              "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split())
_LEAVES = set("p h1 h2 h3 h4 h5 h6".split())  # often left open, so they are no containers
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
# Elements and names of elements that are not the article
_ASIDE = set("nav aside form button dialog menu head footer input option fieldset datalist".split())
_ASIDE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side nav navbar "
    "navigation menu breadcrumb breadcrumbs footer cookie cookies consent notice notices gdpr popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended comment comments reply replies respond "
    "disqus widget widgets toolbar pagination pager alert copyright".split())
# What layouts add to such a name
_LAYOUT_NAMES = set("area bar block box button buttons container form inner outer slot unit wrap wrapper".split())
_READER_NAMES = set("comment comments reply replies respond disqus".split())
_WHOLE = {"html", "body", "main"}  # never an aside for their names
_MAIN = {"article", "main"}
_MAIN_NAMES = set("article main content post entry story".split())

# attributes up to the tag's end: a quote opens a value only behind an equals sign
_REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')?+)*+"""
_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<raw>" + "|".join(_RAW) + r")(?=[\s/>])(?!(?<=<svg)" + _REST + r"(?<=/)>)" + _REST + r">.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>" + _REST + r")(?:>|\Z)|<[/!?a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"
_PARTS = re.compile(r"[\s_-]+|(?<=[a-z])(?=[A-Z])")


@dataclass
class Open:
    """A container on the way down to a token. ``aside`` is 2 for what the element is, 1 for how it is named."""

    name: str
    path: str
    up: Open | None = None
    parts: frozenset[str] = frozenset()
    barred: bool = False  # an aside for what it is
    reader: bool = False  # named as a reader's comment
    whole: bool = False  # one of its names is an aside's as a whole
    shut: bool = False  # it or one above it is barred, or has a name that begins as an aside's
    central: bool = False  # may be the article
    holds: bool = False  # is or holds a main element or the page's first article
    aside: int = 0
    main: bool = False
    doubt: bool = False  # in the article, and a part of its name or of one above it is an aside's


@dataclass
class Event:
    """A token, or the text behind one (``text``); ``token`` is the latest tag's name in its path."""

    token: str
    text: str | None
    aside: int
    main: bool
    link: bool
    breaks: bool
    doubt: bool


def _container(name: str, rest: str, up: Open) -> Open:
    attributes = {}
    if rest.strip(" /"):
        attributes = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(rest)}
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".strip()
    parts = {p.lower() for p in _PARTS.split(names)} if names else set()
    role, style = attributes.get("role", "").lower(), attributes.get("style", "").replace(" ", "").lower()
    hidden = "hidden" in attributes or "display:none" in style or attributes.get("aria-hidden", "").lower() == "true"
    barred = (name in _ASIDE or hidden
              or role in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert"))
    reader = not _READER_NAMES.isdisjoint(names.lower().split())
    whole = any(map(_whole, names.split()))
    begins = any(_PARTS.split(n)[0].lower() in _ASIDE_NAMES for n in names.split()) and name != "article" and name not in _WHOLE
    marks = "." + re.sub(r"\d+", "0", ".".join(sorted(parts))) if parts else ""
    # what a page's body is called says nothing of the texts in it
    central = name in _MAIN or role == "main" or name not in _WHOLE and bool(parts & _MAIN_NAMES)
    return Open(name, f"{up.path}/{name}{marks}", up, frozenset(parts), barred, reader, whole,
                up.shut or barred or begins or reader and name == "article", central,
                name == "main" or role == "main")


def _whole(name: str) -> bool:
    """Whether a class or id names an aside as a whole: by all its parts that are not of the layout, or a reader's comment
    by the first or the last."""
    parts = [p.lower() for p in _PARTS.split(name) if p]
    own = [p for p in parts if p not in _LAYOUT_NAMES]
    return bool(own) and (_ASIDE_NAMES.issuperset(own) or not _READER_NAMES.isdisjoint((parts[0], parts[-1])))


def _judge(opened: list[Open]) -> None:
    """Decides what is aside and what the article, once all containers of a page are known (in order)."""
    first = next((box for box in opened if box.name == "article" and not box.shut), None)
    for box in opened:
        if box is first or box.holds:
            up = box
            while up is not None and not (up.holds and up is not box):
                up.holds, up = True, up.up
    for box in opened:
        kept = box.holds or box.name in _WHOLE or box.name == "article" and not box.reader
        # in an article a part of a name says little: what it holds must look like an aside too
        part = not kept and not box.parts.isdisjoint(_ASIDE_NAMES)
        named = part and (box.whole or not box.up.main) or not kept and not box.up.main and not box.parts.isdisjoint(("header", "masthead"))
        barred = box.barred or box.name == "header" and not box.up.main
        box.aside = max(box.up.aside, 2 if barred else int(named))
        box.main = box.up.main or box.central and not box.aside
        box.doubt = box.up.doubt or part and box.up.main and not named


def events(page: str) -> Iterator[Event]:
    """The tokens and texts of a page in order. Comments, scripts, styles and other raw elements are one
    token without text; tags that end with the page are cut off like the page."""
    found, opened = _walked(page)
    _judge(opened)
    for token, text, box, link, breaks in found:
        yield Event(token, text, box.aside, box.main, link, breaks, box.doubt)


def _walked(page: str) -> tuple[list[tuple], list[Open]]:
    """Token, text, container, link and break of each event, and the containers in order."""
    stack, opened, found = [Open("", "")], [], []
    token, link, at = "", 0, 0
    for tag in [*_TAG.finditer(page), None]:
        text = page[at:tag.start() if tag else len(page)]
        if text and not text.isspace():
            found.append((token, text, stack[-1], link > 0, False))
        elif text:
            found.append((token, " ", stack[-1], link > 0, False))
        if tag is None:
            return found, opened
        at = tag.end()
        name = (tag["raw"] or tag["name"] or "").lower()
        if not name:
            continue
        top = stack[-1]
        if tag["raw"]:
            token = f"{top.path}/{name}!"
        elif tag["close"]:
            if name in _INLINE or name in _LEAVES or name in _VOID:
                link -= name == "a" and link > 0
                token = f"{top.path}/{name}>" if name not in _INLINE else token
            else:
                depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].name == name), 0)
                if not depth:
                    continue
                token = f"{stack[depth].path}>"
                del stack[depth:]
                link = 0
        elif name in _INLINE:
            link += name == "a"
        elif name in _LEAVES or name in _VOID:
            token = f"{top.path}/{name}"
        else:
            ends = _CLOSES.get(name, ())
            while len(stack) > 1 and stack[-1].name in ends:
                stack.pop()
            if not tag["rest"].endswith("/") or name in ("div", "p"):
                stack.append(_container(name, tag["rest"], stack[-1]))
                opened.append(stack[-1])
                token = stack[-1].path
                link = 0
            else:
                token = f"{stack[-1].path}/{name}"
        found.append((token, None, stack[-1], link > 0, name not in _INLINE))


def tidy(text: str) -> str:
    return " ".join(html.unescape(text).split())


def _hash(text: str, salt: int) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8, salt=bytes([salt])).digest(), "big") >> 2


def page_tokens(page: str) -> dict[str, int]:
    """How often each token occurs: tags in their path, and blocks of text that stand outside an article or in doubt."""
    counts: dict[str, int] = defaultdict(int)
    for event in events(page):
        if event.text is None:
            if event.breaks:
                counts[event.token] += 1
        elif (event.doubt or not event.main) and (text := tidy(event.text)):
            counts[f"{event.token}#{_hash(text, 0):x}"] += 1
    return counts


_VECTOR = pa.schema([("host", pa.string()), ("token", pa.string()), ("one", pa.decimal128(38)), ("two", pa.decimal128(38)),
                     ("pages", pa.int64()), ("total", pa.int64())])
_VECTOR_DDL = "host string, token string, one decimal(38,0), two decimal(38,0), pages long, total long"


def _vectors(batches: Batches) -> Batches:
    """Partial sums of the tokens' occurrence vectors, and per host (empty token) the pages."""

    def rows() -> Iterator[tuple]:
        sums: dict[tuple[str, str], list[int]] = {}
        for batch in batches:
            for uid, host, page in zip(*(c.to_pylist() for c in batch.columns)):
                one, two = _hash(str(uid), 1), _hash(str(uid), 2)
                counts = page_tokens(page)
                counts[""] = 1
                for token, n in counts.items():
                    seen = sums.setdefault((host, token), [0, 0, 0, 0])
                    seen[0] += n * one
                    seen[1] += n * two
                    seen[2] += 1
                    seen[3] += n
            if len(sums) > 200_000:
                yield from (key + tuple(value) for key, value in sums.items())
                sums = {}
        yield from (key + tuple(value) for key, value in sums.items())

    yield from in_batches(((h, t, Decimal(a), Decimal(b), n, m) for h, t, a, b, n, m in rows()), _VECTOR)


@dataclass
class Template:
    """A host's classes: of each token its class, which classes are valid, and the slots of the text: of pages
    without an article, and of the article in pages that have one."""

    classes: dict[str, int]
    slots: set[str] = field(default_factory=set)
    main: set[str] = field(default_factory=set)


@dataclass
class Block:
    """A run of text that no tag breaks."""

    slot: str
    aside: int
    main: bool
    same: bool  # it stands on all pages of the host
    fresh: bool  # a tag breaks the text before it
    doubt: bool
    text: str = ""
    chars: int = 0
    links: int = 0

    @property
    def linked(self) -> bool:
        """More than three quarters of it are link text."""
        return 4 * self.links > 3 * self.chars


def slots_of(page: str, template: Template) -> Iterator[tuple[str, Event, bool, bool]]:
    """The texts of a page with the template token that opens their slot, whether a block starts, and whether it
    is a text of the template (a blank is what the text before it is)."""
    slot, fresh_block, same = "", True, False
    for event in events(page):
        if event.text is None:
            fresh_block |= event.breaks
            if event.token in template.classes:
                slot = event.token
            continue
        if not event.text.isspace() or fresh_block:
            same = (event.doubt or not event.main) and f"{event.token}#{_hash(tidy(event.text), 0):x}" in template.classes
        yield slot, event, fresh_block, same
        fresh_block = False


def blocks_of(page: str, template: Template) -> list[Block]:
    blocks: list[Block] = []
    for slot, event, fresh_block, same in slots_of(page, template):
        if fresh_block or not blocks or same != blocks[-1].same or event.doubt != blocks[-1].doubt:
            blocks.append(Block(slot, event.aside, event.main, same, fresh_block, event.doubt))
        block, n = blocks[-1], len(event.text.strip())
        block.text += html.unescape(event.text)
        block.chars += n
        block.links += n if event.link else 0
    return blocks


def body_of(blocks: list[Block]) -> tuple[list[Block], bool]:
    """The blocks of a page that may be its text, and whether the main ones are its article; without any text outside the
    asides, also those that are asides for their names alone. Text of the template counts only on a page that has
    no other."""
    for level, same in ((1, False), (1, True), (2, False), (2, True)):
        body = [b for b in blocks if b.chars and b.aside < level and (same or not b.same) and not (b.doubt and (b.linked or b.same))]
        main = sum(b.chars for b in body if b.main)
        other = sum(b.chars - b.links for b in body if not b.main and not b.linked)
        if main and main >= LEAST_MAIN * (main + other):
            return body, True
        if any(not b.linked for b in body):
            break
    return body, False


_SIGHT = pa.schema([("host", pa.string()), ("what", pa.string()), ("name", pa.string()), ("chars", pa.int64()),
                    ("links", pa.int64())])
_SIGHT_DDL = "host string, what string, name string, chars long, links long"


def class_orders(page: str, template: Template) -> dict[int, int]:
    """Of each class that the page has, a number that stands for the order of its tokens."""
    order: dict[int, list[str]] = defaultdict(list)
    seen = set()
    for event in events(page):
        if event.text is None and event.token not in seen and event.token in template.classes:
            seen.add(event.token)
            order[template.classes[event.token]].append(event.token)
    return {c: _hash("|".join(tokens), 3) for c, tokens in order.items()}


_ORDER = pa.schema([("host", pa.string()), ("class", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
_ORDER_DDL = "host string, class long, low long, high long"


def _orders(shared):
    """Per task: the least and greatest order of each class."""

    def rows(batches: Batches) -> Iterator[tuple]:
        orders: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                host, page = row[1], row[2]
                template = Template(shared.value.get(host, {}) if shared else dict(row[3] or ()))
                for c, order in class_orders(page, template).items():
                    seen = orders.setdefault((host, c), [order, order])
                    seen[:] = [min(seen[0], order), max(seen[1], order)]
        yield from ((host, c, low, high) for (host, c), (low, high) in orders.items())

    def run(batches: Batches) -> Batches:
        yield from in_batches(rows(batches), _ORDER)

    return run


def _sight(shared):
    """Per task: the text of each slot, told by the classes that extraction uses."""

    def rows(batches: Batches) -> Iterator[tuple]:
        texts: dict[tuple[str, str, str], list[int]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                host, page = row[1], row[2]
                template = Template(shared.value.get(host, {}) if shared else dict(row[3] or ()))
                body, article = body_of(blocks_of(page, template))
                for block in body:
                    if article and not block.main:
                        continue
                    seen = texts.setdefault((host, "main" if article else "other", block.slot), [0, 0])
                    seen[0] += block.chars
                    seen[1] += block.links
        yield from ((host, kind, slot, chars, links) for (host, kind, slot), (chars, links) in texts.items())

    def run(batches: Batches) -> Batches:
        yield from in_batches(rows(batches), _SIGHT)

    return run


def extract(page: str, template: Template) -> str:
    """The text in the article's slots; of a page without an article that in the slots of such pages, and if there
    is none, all that is neither in an aside nor in a block of links."""
    body, article = body_of(blocks_of(page, template))
    found = [b for b in body if b.main and b.slot in template.main] if article else []
    found = found or [b for b in body if b.slot in template.slots] or [b for b in body if b.main or not b.linked]
    return " ".join("".join(" " * b.fresh + b.text for b in found).split())


_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def _extract(shared):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            def rows(batch=batch):
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    _, host, page, page_id, url = row[:5]
                    classes, slots, main = shared.value.get(host, ({}, set(), set())) if shared else (
                        dict(row[5] or ()), set(row[6] or ()), set(row[7] or ()))
                    yield page_id, url, extract(page, Template(classes, slots, main))

            yield from in_batches(rows(), _TEXT, lambda row: len(row[2]))

    return run


def _by_host(pages: DataFrame, table: DataFrame, size: int, limit: int, pack) -> tuple[DataFrame, object]:
    """The pages and, up to ``limit`` bytes, the table as a broadcast by host; beyond, joined to them."""
    if size <= limit:
        found = {row["host"]: pack(row) for row in table.collect()}
        return pages, pages.sparkSession.sparkContext.broadcast(found)
    joined = pages.join(table, "host", "left")
    return joined.select(*pages.columns, *[c for c in table.columns if c != "host"]), None


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html",
              broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per row of ``pages``: page_id, url, text (runs jobs).

    The article's text without menus, headers, footers, sidebars, notices, adverts, forms, scripts,
    styles, markup and reader comments: character references decoded, white space folded, blocks
    joined by a blank. A page that has at least a quarter of its text in an article or main element
    gives that; of any other page all slots count that are not asides and hold, over such pages of the
    host, no more than half link text. NULL or empty html
    gives an empty text; pages without a host form a host of their own; repeated rows give repeated
    rows; only the three named columns are read. Templates are broadcast up to ``broadcast_bytes``
    and joined by host beyond. Rows are numbered as read, so ``pages`` should come from files.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")), _HOST, 1))
    rows = numbered(pages, {"host": host, "page": text_of(page), "page_id": F.col(f"`{page_id}`").cast("long"),
                            "url": F.col(f"`{url}`").cast("string")})
    parts = rows.select("uid", "host", "page").mapInArrow(_vectors, _VECTOR_DDL)
    vectors = settle(parts.groupBy("host", "token").agg(
        F.sum("one").alias("one"), F.sum("two").alias("two"), F.sum("pages").alias("pages"), F.sum("total").alias("total")
    ).where("pages > 1 OR token = '' OR token NOT LIKE '%#%'"))
    # copies of one page show nothing of what its host repeats
    contents = rows.groupBy("host", F.xxhash64("page").alias("content")).agg(F.lit(1).alias("one")).groupBy("host").agg(
        F.count(F.lit(1)).alias("contents"))
    hosts = settle(vectors.where("token = ''").select("host", F.col("pages").alias("all_pages")).join(contents, "host"))
    frequent = vectors.where("token != ''").join(hosts, "host").where(
        (F.col("pages") >= LEAST_SHARE * F.col("all_pages"))
        & (~F.col("token").contains("#") | (F.col("pages") == F.col("all_pages")) & (F.col("contents") >= SAME_TEXT_PAGES)))
    number = F.xxhash64("one", "two", "pages", "total").alias("class")
    tokens = frequent.select("host", "token", number)
    large = tokens.groupBy("host", "class").agg(F.count(F.lit(1)).alias("tokens")).where("tokens > 1").select("host", "class")
    entry = F.struct("token", "class")
    candidates, size = settle_sized(tokens.join(large, ["host", "class"]).groupBy("host").agg(
        F.map_from_entries(F.collect_list(entry)).alias("classes")))

    bare = rows.select("uid", "host", "page")
    seen, shared = _by_host(bare, candidates, size, broadcast_bytes, lambda row: dict(row["classes"]))
    orders = seen.mapInArrow(_orders(shared), _ORDER_DDL).groupBy("host", "class").agg(
        F.min("low").alias("low"), F.max("high").alias("high"))
    valid = orders.where("low = high").groupBy("host").agg(F.collect_set("class").alias("valid"))
    # slots are sighted with exactly the classes that extraction uses
    known, size = settle_sized(candidates.join(valid, "host", "left").select("host", F.map_filter(
        "classes", lambda t, c: t.contains("#") | F.coalesce(F.array_contains("valid", c), F.lit(False))).alias("classes")))
    seen, shared = _by_host(bare, known, size, broadcast_bytes, lambda row: dict(row["classes"]))
    sights = settle(seen.mapInArrow(_sight(shared), _SIGHT_DDL).groupBy("host", "what", "name").agg(
        F.sum("chars").alias("chars"), F.sum("links").alias("links")))
    # the slots of pages without an article, and of the articles
    slots = sights.groupBy("host").agg(
        F.collect_set(F.when((F.col("what") == "other") & (2 * F.col("links") <= F.col("chars")), F.col("name"))).alias("slots"),
        F.collect_set(F.when(F.col("what") == "main", F.col("name"))).alias("main"))
    templates = hosts.select("host").join(known, "host", "left").join(slots, "host", "left").select(
        "host", F.coalesce("classes", F.create_map().cast("map<string,bigint>")).alias("classes"),
        *[F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in ("slots", "main")])
    templates, size = settle_sized(templates)
    final, shared = _by_host(rows, templates, size, broadcast_bytes, lambda row: (dict(row["classes"]), set(row["slots"]), set(row["main"])))
    return final.mapInArrow(_extract(shared), "page_id long, url string, text string")
